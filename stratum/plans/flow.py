"""A full run in dependency order: feeds -> bronze -> silver -> gold.

Each layer is written as a table and the next layer reads the stored table,
so lineage is cut at every hand-off: a lost executor re-runs at most the
current layer's stages, never the ones before.  Gold tables wait for *all*
their inputs (merchant performance needs silver transactions and silver
merchants).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import schemas
from stratum.functions import rules
from stratum.functions.stamps import run_stamp
from stratum.operators import bronze, fraud, fraud_extended, gold, reports, silver
from stratum.plans.slices import slices_for, write_in_slices
from stratum.session import scratch_path
from stratum.sources import feeds
from stratum.sources.tables import DEFAULT_FORMAT, read_table, replace_partitions, write_table


@dataclass(frozen=True)
class Feeds:
    customers: str        # JSON lines
    merchants: str        # JSON lines
    transactions: str     # CSV files with header (any layout drift)
    # all transaction files have one layout: their headers are compared while they are parsed, not looked for before
    one_layout: bool = False


@dataclass(frozen=True)
class Layout:
    root: str
    fmt: str = DEFAULT_FORMAT
    # store silver transactions partitioned by the calendar day of the event
    # (column ``event_day``): date-bounded reads then skip whole folders
    partition_transactions_by_day: bool = False

    def path(self, layer: str, entity: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{entity}"


#: Each entity's key: a feed's rows are named by it, and a CSV feed must have it.
KEYS = {"customers": "customer_id", "merchants": "merchant_id", "transactions": "transaction_id"}

BRONZE = {
    "customers": (schemas.CUSTOMERS, bronze.bronze_customers, rules.BRONZE_CUSTOMER_RULES),
    "merchants": (schemas.MERCHANTS, bronze.bronze_merchants, []),
    "transactions": (schemas.TRANSACTIONS, bronze.bronze_transactions, rules.BRONZE_TRANSACTION_RULES),
}


def read_feed(spark: SparkSession, entity: str, path: str | list[str], one_layout: bool = False) -> DataFrame:
    schema = BRONZE[entity][0]
    if entity == "transactions":
        header = feeds.first_header(spark, path) if one_layout else None
        return feeds.read_csv_feed(spark, path, schema, required=(KEYS[entity],), header=header)
    return feeds.read_json_feed(spark, path, schema)


def run_bronze(spark: SparkSession, src: Feeds, out: Layout) -> None:
    """Per entity: the bronze table, the issue counts of its rows (taken as they were written), and what could not be
    read: malformed records and bad fields."""
    for entity, key in KEYS.items():
        _, to_bronze, checks = BRONZE[entity]
        # one pass over the raw feed: bronze keeps the malformed-record text and the bad fields, and
        # the quarantine is cut from the stored table
        counts = reports.write_with_issue_counts(to_bronze(read_feed(spark, entity, getattr(src, entity), src.one_layout)),
                                                 out.path("bronze", entity), entity, {"bronze": (checks, True)}, out.fmt)
        write_table(counts, out.path("issues", entity), out.fmt)
        stored = read_table(spark, out.path("bronze", entity), out.fmt)
        write_table(feeds.quarantine(stored), out.path("quarantine", entity), out.fmt)
        write_table(feeds.bad_fields(stored, key), out.path("quarantine", f"{entity}_fields"), out.fmt)


def _by_day(tx: DataFrame) -> DataFrame:
    """Silver transactions with their day; one day's rows come together first (a hot day is split again by Spark),
    so that a day has few files however many tasks wrote the table."""
    return tx.withColumn("event_day", F.to_date("transaction_date")).hint("rebalance", "event_day")


def run_silver(spark: SparkSession, out: Layout) -> None:
    write_table(silver.silver_customers(read_table(spark, out.path("bronze", "customers"), out.fmt)),
                out.path("silver", "customers"), out.fmt)
    write_table(silver.silver_merchants(read_table(spark, out.path("bronze", "merchants"), out.fmt)),
                out.path("silver", "merchants"), out.fmt)
    tx = silver.silver_transactions(read_table(spark, out.path("bronze", "transactions"), out.fmt))
    if out.partition_transactions_by_day:
        write_table(_by_day(tx), out.path("silver", "transactions"), out.fmt, partition_by=("event_day",))
    else:
        write_table(tx, out.path("silver", "transactions"), out.fmt)


def _daily_metrics(transactions: DataFrame) -> DataFrame:
    return gold.transaction_metrics(transactions).withColumn("metric_day", F.to_date("transaction_day"))


def refresh_transactions(spark: SparkSession, feed: str | list[str], out: Layout) -> None:
    """Take new transaction files into a layout stored by day, and recompute only the days that they touch.

    The new rows are appended to bronze and to their days of silver; the daily metrics are made anew for those days
    alone, from silver's folders of these days, and replace them.  All other files stay as they are.  A
    transaction whose id is already there is not looked for: feeds bring each one once.  After a failure between the
    steps, :func:`run_silver` and :func:`run_gold` from bronze give the same tables again.
    """
    if not out.partition_transactions_by_day:
        raise ValueError("only a layout stored by day can be refreshed by day")
    fresh = scratch_path(spark, "refresh")
    write_table(bronze.bronze_transactions(read_feed(spark, "transactions", feed)), fresh, out.fmt)
    rows = read_table(spark, fresh, out.fmt)
    write_table(rows, out.path("bronze", "transactions"), out.fmt, mode="append", merge_schema=False)
    silver_path, gold_path = out.path("silver", "transactions"), out.path("gold", "transaction_metrics")
    new = _by_day(silver.silver_transactions(rows))
    write_table(new, silver_path, out.fmt, mode="append", merge_schema=False, partition_by=("event_day",))
    days = read_table(spark, fresh, out.fmt).transform(silver.silver_transactions).select(
        F.to_date("transaction_date").alias("_day")).distinct()
    table = read_table(spark, silver_path, out.fmt)
    # the days are a row a folder at most: sent to all tasks, so that silver's rows stay where they are
    touched = table.join(F.broadcast(days), table["event_day"].eqNullSafe(days["_day"]), "left_semi").drop("event_day")
    replace_partitions(_daily_metrics(touched), gold_path, ["metric_day"], out.fmt)


def run_gold(spark: SparkSession, out: Layout) -> None:
    customers = read_table(spark, out.path("silver", "customers"), out.fmt)
    merchants = read_table(spark, out.path("silver", "merchants"), out.fmt)
    transactions = read_table(spark, out.path("silver", "transactions"), out.fmt)
    write_table(gold.customer_metrics(customers), out.path("gold", "customer_metrics"), out.fmt)
    if out.partition_transactions_by_day:
        write_table(_daily_metrics(transactions.drop("event_day")), out.path("gold", "transaction_metrics"), out.fmt,
                    partition_by=("metric_day",))
    else:
        write_table(gold.transaction_metrics(transactions), out.path("gold", "transaction_metrics"), out.fmt)
    write_table(gold.daily_customer_sketches(transactions), out.path("gold", "customer_sketches"), out.fmt)
    write_table(gold.merchant_performance(transactions, merchants),
                out.path("gold", "merchant_performance"), out.fmt)


def score_seven(transactions: DataFrame, customers: DataFrame, path: str, fmt: str = DEFAULT_FORMAT,
                slices: int | None = None, **params) -> None:
    """Store the seven-indicator scores of stored tables, in slices of the customers."""
    write_in_slices(lambda cut: fraud_extended.seven_indicator_scores(cut(transactions), cut(customers), **params),
                    KEYS["customers"], slices or slices_for(transactions.count()), path, fmt)


def run_fraud(spark: SparkSession, out: Layout, **params) -> None:
    """Fraud outputs from silver: scored transactions, alerts and a summary.

    The three-indicator scorer's scores and alerts, and the seven-indicator scorer's
    three tables (``fraud_detection``, ``_alerts``, ``_summary``).  Each scored
    table is written once, in slices of the customers, and what follows reads it back, so the
    windows are computed once (a sort samples its input before it deals it out).
    """
    transactions = read_table(spark, out.path("silver", "transactions"), out.fmt)
    customers = read_table(spark, out.path("silver", "customers"), out.fmt)
    slices = slices_for(transactions.count())
    write_in_slices(lambda cut: fraud.fraud_scores(cut(transactions)), KEYS["customers"], slices,
                    out.path("gold", "fraud_scores"), out.fmt)
    write_table(fraud.high_risk(read_table(spark, out.path("gold", "fraud_scores"), out.fmt)),
                out.path("gold", "fraud_alerts"), out.fmt)
    scored_path = out.path("gold", "fraud_detection")
    score_seven(transactions, customers, scored_path, out.fmt, slices, **params)
    scored = read_table(spark, scored_path, out.fmt)
    write_table(fraud_extended.alerts(scored), out.path("gold", "fraud_detection_alerts"), out.fmt)
    write_table(fraud_extended.summary(scored), out.path("gold", "fraud_detection_summary"), out.fmt)


def run_all_layers(spark: SparkSession, src: Feeds, out: Layout, with_fraud: bool = False,
                   at: dt.datetime | None = None) -> Layout:
    """All layers; every audit column of every table holds one time, ``at`` (now, by default)."""
    with run_stamp(at):
        run_bronze(spark, src, out)
        run_silver(spark, out)
        run_gold(spark, out)
        if with_fraud:
            run_fraud(spark, out)
    return out


def main(argv: list[str] | None = None) -> None:
    """Job entry point::

        spark-submit --py-files stratum.zip stratum/plans/flow.py --customers URI --merchants URI \\
            --transactions URI --root URI [--format parquet] [--fraud] \\
            [--partition-by-day] [--one-layout] [--input-bytes N --cores N]

    The platform supplies the master and resources; ``--input-bytes`` and
    ``--cores`` size shuffle partitions and splits with
    :func:`stratum.session.scale_settings`.
    """
    import argparse

    from stratum.session import scale_settings

    ap = argparse.ArgumentParser(prog="stratum.plans.flow")
    ap.add_argument("--customers", required=True)
    ap.add_argument("--merchants", required=True)
    ap.add_argument("--transactions", required=True)
    ap.add_argument("--root", required=True)
    ap.add_argument("--format", default=DEFAULT_FORMAT)
    ap.add_argument("--fraud", action="store_true")
    ap.add_argument("--partition-by-day", action="store_true")
    ap.add_argument("--one-layout", action="store_true", help="all transaction files have the same header")
    ap.add_argument("--input-bytes", type=int, default=0)
    ap.add_argument("--cores", type=int, default=0)
    args = ap.parse_args(argv)
    builder = SparkSession.builder.appName("stratum-layers")
    if args.input_bytes and args.cores:
        for k, v in scale_settings(args.input_bytes, args.cores).items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    run_all_layers(spark, Feeds(args.customers, args.merchants, args.transactions, args.one_layout),
                   Layout(args.root, args.format, args.partition_by_day), with_fraud=args.fraud)


if __name__ == "__main__":
    main()
