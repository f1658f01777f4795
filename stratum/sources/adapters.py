"""Test-data adapters: the driver's star-schema tables seen as dirty raw feeds.

This is a test-data specification, not engine code.  Each view is one SQL
text that runs unchanged in Spark SQL and in DuckDB.  Spark fills the
``{table}`` placeholders with DataFrames (``spark.sql(text, **frames)``, no
global views); the oracle side inlines the same text as a CTE over the tables
DuckDB has registered.

Fixed values: the view texts below are the fixture definitions; defects are
injected at known, deterministic rows so every rule has rows to fire on.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

CUSTOMERS_RAW = """
select concat('CUST', lpad(cast(c_custkey as string), 8, '0')) as customer_id,
 case when c_custkey % 97 = 1 then null else concat('F', cast(c_custkey % 50 as string)) end as first_name,
 case when c_custkey % 89 = 1 then null else concat('L', cast(c_custkey % 70 as string)) end as last_name,
 case when c_custkey % 53 = 2 then '' when c_custkey % 59 = 2 then 'bor@gmail..com' when c_custkey % 61 = 2 then 'bor@com' when c_custkey % 67 = 2 then 'bor@@gmail.com' when c_custkey % 71 = 2 then null else concat('u', cast(c_custkey as string), '@example.com') end as email,
 case when c_custkey % 47 = 3 then concat('+519', lpad(cast(c_custkey as string), 8, '0')) else concat('+51 9', lpad(cast(c_custkey as string), 8, '0')) end as phone,
 case when c_custkey % 43 = 3 then lpad(cast(c_custkey as string), 7, '0') else lpad(cast(c_custkey as string), 8, '0') end as dni,
 case when c_custkey % 41 = 4 then cast('2999-01-01' as date) else cast(concat(cast(1960 + c_custkey % 40 as string), '-06-15') as date) end as date_of_birth,
 case when c_custkey % 31 = 5 then 'Limasse' else concat(' ', n_name, ' ') end as city, 'Peru' as country,
 case when c_custkey % 37 = 5 then 'Basicos' when c_mktsegment = 'BUILDING' then 'VIP' when c_mktsegment = 'AUTOMOBILE' then 'Premium' when c_mktsegment = 'MACHINERY' then 'Standard' else 'Basic' end as customer_segment,
 case when c_custkey % 29 = 6 then cast(1.23 as double) else cast(c_custkey % 1000 as double) / 1000 end as risk_score,
 c_acctbal as account_balance, c_acctbal * 2 + 2000 as credit_limit, c_custkey % 20 <> 0 as is_active
 from {customer} join {nation} on c_nationkey = n_nationkey
"""

MERCHANTS_RAW = """
select concat('MERCH', lpad(cast(s_suppkey as string), 6, '0')) as merchant_id, concat(s_name, ' ') as merchant_name,
 case when s_suppkey % 25 = 7 then '' when s_suppkey % 25 = 11 then null when s_suppkey % 3 = 0 then 'Retail' when s_suppkey % 3 = 1 then 'Restaurants' else 'Education' end as category,
 case when s_suppkey % 17 = 3 then 99999 else 5411 end as mcc_code, n_name as city,
 case when s_suppkey % 10 = 3 then 'Peruss' else 'Peru ' end as country, s_suppkey % 10 <> 0 as is_verified
 from {supplier} join {nation} on s_nationkey = n_nationkey
"""

TRANSACTIONS_RAW = """
select concat('TXN', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string)) as transaction_id,
 concat('CUST', lpad(cast(o_custkey as string), 8, '0')) as customer_id,
 case when (l_orderkey + l_partkey) % 211 = 0 then null else concat('MERCH', lpad(cast(l_suppkey as string), 6, '0')) end as merchant_id,
 concat(cast(cast(l_shipdate as date) as string), ' ', lpad(cast((l_orderkey * 7 + l_partkey) % 24 as string), 2, '0'), ':', lpad(cast((l_orderkey * 13 + l_linenumber) % 60 as string), 2, '0'), ':00') as transaction_date,
 case when (l_orderkey + l_partkey) % 199 = 0 then -l_extendedprice else l_extendedprice end as amount,
 case when l_partkey % 101 = 0 then 'SOL' when l_partkey % 7 = 0 then 'USD' else 'PEN' end as currency,
 case when l_partkey % 103 = 0 then 'app' when l_linenumber % 3 = 0 then 'online' when l_linenumber % 3 = 1 then 'mobile' else 'pos' end as channel,
 case when l_orderkey % 13 = 0 then null when l_orderkey % 17 = 0 then 123 else cast(1000 + l_orderkey % 9000 as int) end as card_last_4,
 case when l_partkey % 107 = 0 then 'failing' when l_returnflag = 'R' then 'failed' when l_returnflag = 'A' then 'pending' else 'completed' end as status,
 l_partkey % 50 = 0 as is_fraud, l_tax as processing_fee
 from {lineitem} join {orders} on l_orderkey = o_orderkey
"""

# The events table seen as scored transactions (ours; a plain renaming).
EVENTS_AS_TRANSACTIONS = """
select event_id as transaction_id, user_id as customer_id, ts as transaction_date,
 value as amount, event_type = 'error' as is_fraud, event_type
 from {events}
"""

# Transactions with a place (ours): a deterministic (lat, lon) grid from the
# supplier and part keys; line 7 of an order has no location.
TRANSACTIONS_LOCATED = TRANSACTIONS_RAW.replace(
    " l_tax as processing_fee\n from",
    " l_tax as processing_fee,\n"
    " case when l_linenumber = 7 then null else -12.2 + cast(l_suppkey % 7 as double) * 0.05 end as location_lat,\n"
    " case when l_linenumber = 7 then null else -77.2 + cast(l_partkey % 9 as double) * 0.05 end as location_lon\n"
    " from")

VIEWS = {
    "customers_raw": CUSTOMERS_RAW,
    "transactions_located": TRANSACTIONS_LOCATED,
    "merchants_raw": MERCHANTS_RAW,
    "transactions_raw": TRANSACTIONS_RAW,
    "events_tx": EVENTS_AS_TRANSACTIONS,
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(partitions) if partitions else df


def view(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """One adapter view as a Spark DataFrame over the parquet tables.

    ``partitions`` deals the tables out to so many tasks first: the test tables are
    files of one row group, which one task would read.
    """
    text = VIEWS[name]
    tables = set(_PLACEHOLDER.findall(text))
    frames = {t: table(spark, sf_dir, t, partitions) for t in tables}
    return spark.sql(text, **frames)


def sql_text(name: str) -> str:
    """The view body for a SQL engine that already has the tables as views."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), VIEWS[name])


def with_views(query: str, *names: str, ctes: list[tuple[str, str]] = ()) -> str:
    """Prefix ``query`` with the named adapter views, then ``ctes``, as CTEs."""
    parts = [f"{n} as ({sql_text(n)})" for n in names]
    parts += [f"{n} as ({body})" for n, body in ctes]
    return "with " + ",\n".join(parts) + "\n" + query
