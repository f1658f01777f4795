"""Independent SQL formulations of the checked queries (DuckDB dialect).

Written by hand from the specification, not generated from the Spark rule
objects, so a mistake on one side shows up as a mismatch.  Conventions that
make both engines produce identical values:

* issues are ``concat_ws(',', case when <fires> then '<name>' end, ...)``
  (NULL branches are skipped; no issue gives ``''``);
* sums are of decimals, which hold the test values exactly; averages are that
  sum divided by the count of values;
* DuckDB's HUGEINT sums and BIGINT hours are cast back to BIGINT / INTEGER.
"""

from __future__ import annotations

from stratum.sources.adapters import with_views

# fixed values below: rule names, patterns and value lists of the output contract
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

BRONZE_CUSTOMERS = rf"""
select customer_id, first_name, last_name, email, phone, dni, date_of_birth,
 cast(null as date) as registration_date, city, cast(null as varchar) as district, country,
 customer_segment, risk_score, account_balance, credit_limit, is_active, cast(null as date) as created_at,
 'azure_json' as data_source,
 concat_ws(',',
  case when email is not null and not regexp_matches(email, '{EMAIL}') then 'invalid_email_format' end,
  case when phone is not null and not regexp_matches(phone, '^\+51 9\d{{8}}$') then 'invalid_phone_format' end,
  case when dni is not null and not regexp_matches(dni, '^\d{{8}}$') then 'invalid_dni_format' end,
  case when date_of_birth is not null and date_of_birth > current_date then 'invalid_date_of_birth' end
 ) as quality_issues
from customers_raw
"""

BRONZE_MERCHANTS = """
select merchant_id, merchant_name, category, mcc_code, city, country, is_verified,
 cast(null as date) as registration_date, 'azure_json' as data_source, '' as quality_issues
from merchants_raw
"""

BRONZE_TRANSACTIONS = r"""
select transaction_id, customer_id, merchant_id, transaction_date, amount, currency,
 cast(null as varchar) as transaction_type, channel, cast(null as varchar) as device_id,
 cast(null as varchar) as ip_address, cast(null as double) as location_lat, cast(null as double) as location_lon,
 cast(null as varchar) as card_type, card_last_4, status, is_fraud, cast(null as varchar) as fraud_reason,
 processing_fee, cast(null as date) as created_at, 'azure_csv' as data_source,
 concat_ws(',',
  case when card_last_4 is not null and not regexp_matches(cast(card_last_4 as varchar), '^\d{4}$')
       then 'invalid_card_last_4_format' end
 ) as quality_issues
from transactions_raw
"""

SILVER_CUSTOMERS = """
select *, concat_ws(',',
  case when customer_id is null then 'null_customer_id' end,
  case when first_name is null then 'null_first_name' end,
  case when last_name is null then 'null_last_name' end,
  case when customer_segment is not null and customer_segment not in ('VIP', 'Premium', 'Standard', 'Basic')
       then 'invalid_customer_segment' end,
  case when risk_score is not null and (risk_score < 0.0 or risk_score > 1.0) then 'invalid_risk_score' end
 ) as quality_issues
from (
 select customer_id, first_name, last_name, trim(email) as email, phone, dni, date_of_birth, registration_date,
  case when city = 'Limasse' then 'Lima' else trim(city) end as city, district, country,
  trim(customer_segment) as customer_segment,
  case when risk_score > 1.0 or risk_score < 0.0 then null else risk_score end as risk_score,
  account_balance, credit_limit, is_active, created_at
 from bronze_customers
 where quality_issues = '' and customer_id is not null and dni is not null and is_active
) s
"""

SILVER_MERCHANTS = """
select *, concat_ws(',',
  case when merchant_id is null then 'null_merchant_id' end,
  case when category is not null and category not in ('Retail', 'Restaurants', 'Online Services',
       'Transportation', 'Utilities', 'Health & Pharmacies', 'Education', 'Entertainment',
       'Financial Services') then 'invalid_category' end
 ) as quality_issues
from (
 select merchant_id, trim(merchant_name) as merchant_name, trim(category) as category, mcc_code,
  trim(city) as city, case when country = 'Peruss' then 'Peru' else upper(trim(country)) end as country,
  is_verified, registration_date
 from bronze_merchants
 where quality_issues = '' and merchant_id is not null and category is not null
) s
"""

SILVER_TX_FLAGS = """concat_ws(',',
  case when transaction_id is null then 'null_transaction_id' end,
  case when customer_id is null then 'null_customer_id' end,
  case when merchant_id is null then 'null_merchant_id' end,
  case when amount is not null and amount <= 0 then 'invalid_amount' end,
  case when status is not null and status not in ('pending', 'completed', 'failed', 'cancelled')
       then 'invalid_status' end,
  case when currency is not null and currency not in ('PEN', 'USD') then 'invalid_currency' end,
  case when channel is not null and channel not in ('online', 'mobile', 'atm', 'branch', 'pos', 'agent')
       then 'invalid_channel' end
 )"""

SILVER_TRANSACTIONS = f"""
select *, {SILVER_TX_FLAGS} as quality_issues
from (
 select transaction_id, customer_id, merchant_id, try_cast(transaction_date as timestamp) as transaction_date,
  amount, currency, transaction_type, channel, device_id, ip_address, location_lat, location_lon, card_type,
  card_last_4, status, is_fraud, fraud_reason, processing_fee, created_at
 from bronze_transactions
 where quality_issues = '' and transaction_id is not null and customer_id is not null
  and merchant_id is not null and amount > 0
  and status in ('pending', 'completed', 'failed', 'cancelled') and currency in ('PEN', 'USD')
  and channel in ('online', 'mobile', 'atm', 'branch', 'pos', 'agent')
) s
"""


def _valid(cte: str) -> str:
    return f"select *, quality_issues = '' as is_valid from {cte}"


def _metric_flags(metrics: list[str]) -> str:
    parts = []
    for m in metrics:
        parts.append(f"case when {m} is null then 'null_{m}' end")
        parts.append(f"case when {m} is not null and {m} < 0 then 'negative_{m}' end")
    return "concat_ws(',', " + ", ".join(parts) + ")"


def _dec_sum(col: str, scale: int = 2, over: str = "") -> str:
    """The exact sum of values that have ``scale`` decimals; the cast fails on a value it cannot hold."""
    if scale > 6:  # through text, whose digits both engines read alike
        return f"cast(cast(sum(cast(cast({col} as varchar) as decimal(38, {scale}))){over} as varchar) as double)"
    return f"cast(sum(cast({col} as decimal(38, {scale}))){over} as double)"


def _dec_avg(col: str, scale: int = 2, over: str = "") -> str:
    return f"({_dec_sum(col, scale, over)} / nullif(count({col}){over}, 0))"


GOLD_CUSTOMER = f"""
select customer_segment, city, count(customer_id) as customer_count,
 {_dec_avg('risk_score', 6)} as avg_risk_score,
 {_dec_avg('account_balance')} as avg_balance,
 {_dec_avg('credit_limit', 16)} as avg_credit_limit,
 {_dec_sum('account_balance')} as total_balance
from silver_customers group by customer_segment, city
"""

GOLD_TRANSACTION = f"""
select *, cast(fraud_count as double) / nullif(transaction_count, 0) as fraud_rate from (
 select date_trunc('day', transaction_date) as transaction_day, status, channel,
  count(transaction_id) as transaction_count,
  count(distinct customer_id) as unique_customers,
  {_dec_sum('amount')} as total_amount,
  {_dec_avg('amount')} as avg_amount,
  max(amount) as max_amount,
  cast(sum(cast(is_fraud as integer)) as bigint) as fraud_count
 from silver_transactions group by 1, 2, 3
) g
"""

GOLD_MERCHANT = f"""
select *, cast(successful_transactions as double) / nullif(transaction_count, 0) as success_rate from (
 select t.merchant_id, m.merchant_name, m.category, m.country,
  count(t.transaction_id) as transaction_count,
  count(distinct t.customer_id) as unique_customers,
  {_dec_sum('t.amount')} as total_revenue,
  {_dec_avg('t.amount')} as avg_transaction_value,
  cast(sum(case when t.status = 'completed' then 1 else 0 end) as bigint) as successful_transactions,
  cast(sum(case when t.status = 'failed' then 1 else 0 end) as bigint) as failed_transactions
 from silver_transactions t join silver_merchants m on t.merchant_id = m.merchant_id
 group by t.merchant_id, m.merchant_name, m.category, m.country
) g
"""

CUSTOMER_METRICS = ["customer_count", "avg_risk_score", "avg_balance", "avg_credit_limit", "total_balance"]
TRANSACTION_METRICS = ["transaction_count", "unique_customers", "total_amount", "avg_amount",
                       "max_amount", "fraud_count", "fraud_rate"]
MERCHANT_METRICS = ["transaction_count", "unique_customers", "total_revenue", "avg_transaction_value",
                    "successful_transactions", "failed_transactions", "success_rate"]


def _flagged(body_cte: str, metrics: list[str]) -> str:
    return (f"select *, {_metric_flags(metrics)} = '' as is_valid, "
            f"{_metric_flags(metrics)} as quality_issues from {body_cte}")


# amounts that whole cents do not hold: 1e17, thousandths, and infinite ones for failed transactions at a till
WIDE_AMOUNT = """case when status = 'failed' and channel = 'pos' then cast('infinity' as double)
  when right(transaction_id, 1) in ('0', '1') then 1e17 when right(transaction_id, 1) in ('2', '3') then 0.004
  else amount end"""
WIDE_TX = ("silver_transactions", f"select * replace ({WIDE_AMOUNT} as amount) from plain_transactions")
_WIDE_SUM = ("case when bool_or(isinf({0})) then cast('infinity' as double) else "
             "cast(sum(cast(case when isinf({0}) then 0 else {0} end as decimal(38, 4))) as double) end")


def _wide(sql: str, col: str) -> str:
    total = _WIDE_SUM.format(col)
    return sql.replace(_dec_avg(col), f"({total} / count({col}))").replace(_dec_sum(col), total)


BRONZE_C = [("bronze_customers", BRONZE_CUSTOMERS)]
BRONZE_M = [("bronze_merchants", BRONZE_MERCHANTS)]
BRONZE_T = [("bronze_transactions", BRONZE_TRANSACTIONS)]
SILVER_C = BRONZE_C + [("silver_customers", SILVER_CUSTOMERS)]
SILVER_M = BRONZE_M + [("silver_merchants", SILVER_MERCHANTS)]
SILVER_T = BRONZE_T + [("silver_transactions", SILVER_TRANSACTIONS)]


def fraud_sql(window_seconds: int, velocity_min: int, amount_factor: float,
              hours: tuple[int, int] = (0, 5), weights: tuple[int, int, int] = (40, 30, 30)) -> str:
    wv, wh, wa = weights
    avg = _dec_avg("amount", over=" over (partition by customer_id)")
    features = f"""
select *, cast(hour(transaction_date) as integer) as transaction_hour,
 count(transaction_id) over (partition by customer_id
   order by cast(floor(epoch(transaction_date)) as bigint)
   range between {int(window_seconds)} preceding and current row) as txn_count_1h,
 {avg} as customer_avg_amount
from events_tx
"""
    indicators = f"""
select *, case when txn_count_1h >= {velocity_min} then 1 else 0 end as is_high_velocity,
 case when transaction_hour between {hours[0]} and {hours[1]} then 1 else 0 end as is_unusual_hour,
 case when amount > customer_avg_amount * {float(amount_factor)} then 1 else 0 end as is_high_amount
from features
"""
    scored = f"""
select *, case when fraud_score >= 70 then 'HIGH' when fraud_score >= 40 then 'MEDIUM' else 'LOW' end as risk_level
from (select *, is_high_velocity * {wv} + is_unusual_hour * {wh} + is_high_amount * {wa} as fraud_score
      from indicators) s
"""
    return with_views("select * from scored", "events_tx",
                      ctes=[("features", features), ("indicators", indicators), ("scored", scored)])


def fraud_high_risk_sql(window_seconds: int, velocity_min: int, amount_factor: float, min_score: int = 70) -> str:
    inner = fraud_sql(window_seconds, velocity_min, amount_factor)
    return (f"select transaction_id, customer_id, transaction_date, amount, fraud_score, risk_level, is_fraud "
            f"from ({inner}) f where fraud_score >= {min_score}")


def _issue_count_rows(entity: str, layer: str, source: str, checks: list[tuple[str, str]]) -> list[str]:
    rows = []
    for name, cond in checks:
        rows.append(f"select '{entity}' as entity, '{layer}' as layer, '{name}' as check_name, "
                    f"count(*) as n_rows from {source} where {cond} having count(*) > 0")
    anyc = " or ".join(f"({c})" for _, c in checks)
    rows.append(f"select '{entity}' as entity, '{layer}' as layer, '*' as check_name, "
                f"count(*) as n_rows from {source} where {anyc} having count(*) > 0")
    return rows


def invalid_counts_sql() -> str:
    bc = [
        ("invalid_email_format", f"email is not null and not regexp_matches(email, '{EMAIL}')"),
        ("invalid_phone_format", r"phone is not null and not regexp_matches(phone, '^\+51 9\d{8}$')"),
        ("invalid_dni_format", r"dni is not null and not regexp_matches(dni, '^\d{8}$')"),
        ("invalid_date_of_birth", "date_of_birth is not null and date_of_birth > current_date"),
    ]
    bt = [("invalid_card_last_4_format",
           r"card_last_4 is not null and not regexp_matches(cast(card_last_4 as varchar), '^\d{4}$')")]
    sc = [
        ("null_customer_id", "customer_id is null"),
        ("null_first_name", "first_name is null"),
        ("null_last_name", "last_name is null"),
        ("invalid_customer_segment",
         "customer_segment is not null and customer_segment not in ('VIP', 'Premium', 'Standard', 'Basic')"),
        ("invalid_risk_score", "risk_score is not null and (risk_score < 0.0 or risk_score > 1.0)"),
    ]
    sm = [
        ("null_merchant_id", "merchant_id is null"),
        ("invalid_category", "category is not null and category not in ('Retail', 'Restaurants', "
                             "'Online Services', 'Transportation', 'Utilities', 'Health & Pharmacies', "
                             "'Education', 'Entertainment', 'Financial Services')"),
    ]
    st = [
        ("null_transaction_id", "transaction_id is null"),
        ("null_customer_id", "customer_id is null"),
        ("null_merchant_id", "merchant_id is null"),
        ("invalid_amount", "amount is not null and amount <= 0"),
        ("invalid_status", "status is not null and status not in ('pending', 'completed', 'failed', 'cancelled')"),
        ("invalid_currency", "currency is not null and currency not in ('PEN', 'USD')"),
        ("invalid_channel",
         "channel is not null and channel not in ('online', 'mobile', 'atm', 'branch', 'pos', 'agent')"),
    ]
    rows = (_issue_count_rows("customers", "bronze", "customers_raw", bc)
            + _issue_count_rows("transactions", "bronze", "transactions_raw", bt)
            + _issue_count_rows("customers", "silver_rules", "customers_raw", sc)
            + _issue_count_rows("merchants", "silver_rules", "merchants_raw", sm)
            + _issue_count_rows("transactions", "silver_rules", "transactions_raw", st))
    return with_views("\nunion all\n".join(rows), "customers_raw", "merchants_raw", "transactions_raw")


def silver_flags_gaps_sql() -> str:
    """Rules on keys: every key NULL in some rows, all rules of the entity evaluated."""
    parts = []
    for entity, view, key, others in (
            ("customers", "customers_raw", "customer_id", ["first_name", "last_name"]),
            ("merchants", "merchants_raw", "merchant_id", []),
            ("transactions", "transactions_raw", "transaction_id", ["customer_id", "merchant_id"])):
        gone = f"right({key}, 1) = '7'"
        hits = [f"case when {gone} or {key} is null then 'null_{key}' end",
                *[f"case when {c} is null then 'null_{c}' end" for c in others]]
        parts.append(f"select '{entity}' as entity, {key} as row_key, concat_ws(',', {', '.join(hits)}) as key_issues "
                     f"from {view}")
    return with_views("\nunion all\n".join(parts), "customers_raw", "merchants_raw", "transactions_raw")


def malformed_sql() -> str:
    """Every transaction is one line of a feed; lines whose id ends in 3 lack their last field, those in 5 have one too many."""
    return with_views(
        "select transaction_id, case right(transaction_id, 1) when '3' then line when '5' then line || ',x,LOST' end "
        "as malformed_text from (select transaction_id, concat_ws(',', transaction_id, coalesce(customer_id, ''), "
        "coalesce(cast(card_last_4 as varchar), '')) as line from transactions_raw) l", "transactions_raw")


def cast_issues_sql() -> str:
    """Rows whose id ends in 1, 2 or 3 hold a bad text in one field; those in 4 are malformed lines."""
    parts = []
    for entity, key, bad, line in (
            ("customers", "customer_id", [("1", "date_of_birth", "31/12/1999"), ("2", "is_active", "maybe"), ("3", "risk_score", "n/a")],
             """'{"customer_id":"' || customer_id || '","city":'"""),
            ("transactions", "transaction_id", [("1", "card_last_4", "12x4"), ("2", "is_fraud", "perhaps"),
                                                ("3", "processing_fee", "1.5 PEN")], "transaction_id || ',1234,true,0.5,MORE'")):
        parts += [f"select '{entity}' as entity, {key} as row_key, '{field}' as field, '{text}' as text from {entity}_raw "
                  f"where right({key}, 1) = '{digit}'" for digit, field, text in bad]
        parts.append(f"select '{entity}' as entity, cast(null as varchar) as row_key, 'malformed' as field, {line} as text "
                     f"from {entity}_raw where right({key}, 1) = '4'")
    return with_views("\nunion all\n".join(parts), "customers_raw", "transactions_raw")


def stamps_sql() -> str:
    tables = [("bronze", "customers", "bronze_customers"), ("bronze", "merchants", "bronze_merchants"),
              ("bronze", "transactions", "bronze_transactions"), ("silver", "customers", "silver_customers"),
              ("silver", "merchants", "silver_merchants"), ("silver", "transactions", "silver_transactions"),
              ("gold", "customer_metrics", "gc"), ("gold", "transaction_metrics", "gt"), ("gold", "merchant_performance", "gm")]
    columns = {"bronze": ["ingestion_timestamp"], "silver": ["processed_timestamp", "quality_check_timestamp"],
               "gold": ["calculated_at", "quality_check_timestamp"]}
    parts = [f"select '{layer}' as layer, '{name}' as table_name, '{c}' as audit_column, count(*) as n_rows, true as one_stamp from {cte}"
             for layer, name, cte in tables for c in columns[layer]]
    return with_views("\nunion all\n".join(parts), "customers_raw", "merchants_raw", "transactions_raw",
                      ctes=SILVER_C + SILVER_M + SILVER_T + [("gc", GOLD_CUSTOMER), ("gt", GOLD_TRANSACTION), ("gm", GOLD_MERCHANT)])


def ranked(sql: str, order: str) -> str:
    return f"select *, row_number() over (order by {order}) as rank from ({sql}) unranked"


MONTHLY_CUSTOMERS = """
select date_trunc('month', transaction_date) as period, status, channel, count(transaction_id) as transaction_count,
 count(distinct customer_id) as exact_customers, true as within_error
from silver_transactions group by 1, 2, 3
"""


def build() -> dict[str, str]:
    """Oracle SQL per checked query name."""
    out = {
        "bronze_customers_flags": with_views(_valid("bronze_customers"), "customers_raw", ctes=BRONZE_C),
        "bronze_merchants_default": with_views("select *, true as is_valid from bronze_merchants",
                                               "merchants_raw", ctes=BRONZE_M),
        "bronze_transactions_flags": with_views(_valid("bronze_transactions"), "transactions_raw", ctes=BRONZE_T),
        "silver_customers": with_views(_valid("silver_customers"), "customers_raw", ctes=SILVER_C),
        "silver_merchants": with_views(_valid("silver_merchants"), "merchants_raw", ctes=SILVER_M),
        "silver_transactions": with_views(_valid("silver_transactions"), "transactions_raw", ctes=SILVER_T),
        "silver_transactions_flags_unfiltered": with_views(
            f"select *, {SILVER_TX_FLAGS} as quality_issues, {SILVER_TX_FLAGS} = '' as is_valid from ("
            "select transaction_id, customer_id, merchant_id, transaction_date, amount, currency, "
            "cast(null as varchar) as transaction_type, channel, cast(null as varchar) as device_id, "
            "cast(null as varchar) as ip_address, cast(null as double) as location_lat, "
            "cast(null as double) as location_lon, cast(null as varchar) as card_type, card_last_4, status, "
            "is_fraud, cast(null as varchar) as fraud_reason, processing_fee, cast(null as date) as created_at "
            "from transactions_raw) r", "transactions_raw"),
        "invalid_counts": invalid_counts_sql(),
        "gold_customer_metrics": with_views(_flagged("g", CUSTOMER_METRICS), "customers_raw",
                                            ctes=SILVER_C + [("g", GOLD_CUSTOMER)]),
        "gold_transaction_metrics": with_views(_flagged("g", TRANSACTION_METRICS), "transactions_raw",
                                               ctes=SILVER_T + [("g", GOLD_TRANSACTION)]),
        "gold_merchant_performance": with_views(_flagged("g", MERCHANT_METRICS), "merchants_raw",
                                                "transactions_raw",
                                                ctes=SILVER_M + SILVER_T + [("g", GOLD_MERCHANT)]),
        "gold_transaction_metrics_wide_values": with_views(
            _flagged("g", TRANSACTION_METRICS), "transactions_raw", ctes=BRONZE_T + [
                ("plain_transactions", SILVER_TRANSACTIONS), WIDE_TX, ("g", _wide(GOLD_TRANSACTION, "amount"))]),
        "gold_merchant_performance_wide_values": with_views(
            _flagged("g", MERCHANT_METRICS), "merchants_raw", "transactions_raw", ctes=SILVER_M + BRONZE_T + [
                ("plain_transactions", SILVER_TRANSACTIONS), WIDE_TX, ("g", _wide(GOLD_MERCHANT, "t.amount"))]),
        "fraud_scores_wide_values": fraud_sql(86400, 5, 3.0).replace("from events_tx\n", (
            "from (select * replace (case right(cast(transaction_id as varchar), 1) when '0' then 1e17 when '1' then 0.004 "
            "else amount end as amount) from events_tx) w\n")).replace(_dec_avg(
                "amount", over=" over (partition by customer_id)"), _dec_avg(
                "amount", 4, over=" over (partition by customer_id)")),
        "silver_flags_gaps": silver_flags_gaps_sql(),
        "gold_customer_metrics_negative": with_views(
            _flagged("g", CUSTOMER_METRICS), "customers_raw", ctes=BRONZE_C + [
                ("plain_customers", SILVER_CUSTOMERS),
                ("silver_customers", "select * replace (-abs(account_balance) - 1 as account_balance) from plain_customers"),
                ("g", GOLD_CUSTOMER)]),
        "silver_customers_user_rule": with_views(
            "select customer_id, credit_limit, concat_ws(',', nullif(quality_issues, ''), "
            "case when credit_limit > 500 then 'credit_limit_over_500' end) as quality_issues from silver_customers",
            "customers_raw", ctes=SILVER_C),
        "bronze_transactions_malformed": malformed_sql(),
        "fraud_scores": fraud_sql(86400, 5, 3.0),
        "fraud_scores_default": fraud_sql(3600, 5, 5.0),
        "fraud_high_risk": fraud_high_risk_sql(86400, 5, 3.0),
    }
    out["invalid_counts_at_write"] = out["invalid_counts"]
    out["stream_trailing_counts"] = with_views(
        "select cast(customer_id as varchar) as customer_id, cast(transaction_id as varchar) as transaction_id, "
        "cast(floor(epoch(transaction_date)) as bigint) as second, count(transaction_id) over (partition by customer_id "
        "order by cast(floor(epoch(transaction_date)) as bigint) range between 86400 preceding and current row) as txn_count "
        "from events_tx where transaction_date is not null", "events_tx")
    out["bronze_cast_issues"] = cast_issues_sql()
    out["full_run_stamps"] = stamps_sql()
    out["gold_monthly_customers"] = with_views(MONTHLY_CUSTOMERS, "transactions_raw", ctes=SILVER_T)
    out["refreshed_transaction_metrics"] = out["gold_transaction_metrics"]
    for name, order in (("gold_customer_metrics", "customer_segment nulls first, city nulls first"),
                        ("gold_transaction_metrics", "transaction_day nulls first, status nulls first, channel nulls first"),
                        ("gold_merchant_performance", "total_revenue desc nulls last, merchant_id nulls first"),
                        ("fraud_high_risk", "fraud_score desc nulls last, transaction_id nulls first")):
        out[f"{name}_ranked"] = ranked(out[name], order)
    # ingestion round trips and the full run must reproduce the direct results
    out["bronze_customers_json_roundtrip"] = out["bronze_customers_flags"]
    out["bronze_merchants_json_roundtrip"] = out["bronze_merchants_default"]
    out["bronze_transactions_csv_roundtrip"] = out["bronze_transactions_flags"]
    out["full_run_customer_metrics"] = out["gold_customer_metrics"]
    out["full_run_transaction_metrics"] = out["gold_transaction_metrics"]
    out["full_run_merchant_performance"] = out["gold_merchant_performance"]
    out["bronze_customers_stream"] = out["bronze_customers_flags"]
    out["bronze_transactions_stream"] = out["bronze_transactions_flags"]
    from stratum.plans.catalog import SEVEN_CHECK
    out["fraud_seven_indicators"] = seven_indicator_query("select * from scored", **SEVEN_CHECK)
    out["fraud_seven_indicators_default"] = seven_indicator_query("select * from scored")
    out["fraud_seven_alerts"] = seven_indicator_query(SEVEN_ALERTS, **SEVEN_CHECK)
    out["fraud_seven_summary"] = seven_indicator_query(SEVEN_SUMMARY, **SEVEN_CHECK)
    out["full_run_fraud_alerts"], out["full_run_fraud_summary"] = out["fraud_seven_alerts"], out["fraud_seven_summary"]
    return out


# ---- seven-indicator scoring over located transactions -----------------------
BRONZE_TX_LOCATED = BRONZE_TRANSACTIONS.replace(
    "cast(null as double) as location_lat, cast(null as double) as location_lon",
    "location_lat, location_lon").replace("from transactions_raw", "from transactions_located")


def seven_indicator_sql(large_amount=10000.0, spend_factor=3.0, night=(2, 5), velocity_seconds=3600,
                        velocity_over=5, merchant_seconds=86400, merchants_over=10, location_seconds=86400,
                        locations_over=5, risk_over=0.7, points=2) -> str:
    avg = _dec_avg("t.amount", over=" over (partition by t.customer_id)")
    rng = "over (partition by t.customer_id order by t.epoch_sec range between {} preceding and current row)"
    features = f"""
select t.*, cast(hour(transaction_date) as integer) as transaction_hour,
 count(transaction_id) {rng.format(int(velocity_seconds))} as txn_count_1h,
 count(distinct merchant_id) {rng.format(int(merchant_seconds))} as merchants_24h,
 count(distinct loc) {rng.format(int(location_seconds))} as locations_24h,
 {avg} as customer_avg_amount,
 r.customer_risk_score
from (select *, quality_issues = '' as is_valid, cast(floor(epoch(transaction_date)) as bigint) as epoch_sec,
       case when location_lat is not null and location_lon is not null
            then concat(cast(location_lat as varchar), ',', cast(location_lon as varchar)) end as loc
      from silver_transactions) t
left join (select customer_id, max(risk_score) as customer_risk_score from silver_customers group by customer_id) r
 on t.customer_id = r.customer_id
"""
    flags = f"""
select * exclude (epoch_sec, loc),
 case when amount > {float(large_amount)} then 1 else 0 end as is_large_amount,
 case when amount > customer_avg_amount * {float(spend_factor)} then 1 else 0 end as is_unusual_spend,
 case when transaction_hour between {night[0]} and {night[1]} then 1 else 0 end as is_night,
 case when txn_count_1h > {velocity_over} then 1 else 0 end as is_high_velocity,
 case when merchants_24h > {merchants_over} then 1 else 0 end as is_merchant_hopping,
 case when locations_24h > {locations_over} then 1 else 0 end as is_location_hopping,
 case when customer_risk_score > {float(risk_over)} then 1 else 0 end as is_risky_customer
from features f
"""
    scored = f"""
select *, case when fraud_score >= 8 then 'CRITICAL' when fraud_score >= 6 then 'HIGH'
               when fraud_score >= 4 then 'MEDIUM' else 'LOW' end as risk_level,
 fraud_score >= 4 and fraud_score < 8 as requires_review, fraud_score >= 8 as should_block
from (select *, (is_large_amount + is_unusual_spend + is_night + is_high_velocity + is_merchant_hopping
                 + is_location_hopping + is_risky_customer) * {points} as fraud_score from flags) s
"""
    ctes = ([("bronze_transactions", BRONZE_TX_LOCATED), ("silver_transactions", SILVER_TRANSACTIONS)]
            + SILVER_C + [("features", features), ("flags", flags), ("scored", scored)])
    return ctes


def seven_indicator_query(final: str, **params) -> str:
    return with_views(final, "transactions_located", "customers_raw", ctes=seven_indicator_sql(**params))


SEVEN_ALERTS = ("select transaction_id, customer_id, transaction_date, amount, fraud_score, risk_level, "
                "requires_review, should_block, is_fraud from scored where risk_level in ('CRITICAL', 'HIGH')")
SEVEN_SUMMARY = f"""
select *, cast(confirmed_fraud as double) / nullif(transactions, 0) as confirmed_fraud_rate from (
 select risk_level, count(transaction_id) as transactions, count(distinct customer_id) as customers,
  {_dec_sum('amount')} as total_amount,
  cast(sum(fraud_score) as double) / nullif(count(fraud_score), 0) as avg_fraud_score,
  cast(sum(cast(is_fraud as integer)) as bigint) as confirmed_fraud
 from scored group by risk_level) g
"""
