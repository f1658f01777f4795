"""Gold: metric tables with their own quality flags.

A metric table is declared once: its group keys, its aggregates by name, the
ratios that follow from them, and its order.  The declaration builds the query
and names the metrics to check.  Gold reads silver whole (silver flags are
advisory, not a gate).  Sums lose nothing (see :mod:`stratum.functions.metrics`).
Sorts carry a tie-breaker so range partitioning of the final sort never piles
equal keys into one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions import rules, stamps
from stratum.functions.metrics import mean, part_sums, ratio, split_values, total, with_totals


@dataclass(frozen=True)
class Total:
    """A metric: the exact sum of a column."""

    column: str

    def value(self) -> Column:
        return total(self.column)


@dataclass(frozen=True)
class Mean(Total):
    """A metric: the exact average of a column."""

    def value(self) -> Column:
        return mean(self.column)


@dataclass(frozen=True)
class MetricTable:
    """What a metric table holds; aliases are fixed values of the output."""

    keys: list[str]
    aggregates: dict[str, Column | Total]
    ratios: dict[str, tuple[str, str]] = field(default_factory=dict)
    order: list[Column] | None = None

    def metrics(self) -> list[str]:
        return [*self.aggregates, *self.ratios]

    def finish(self, grouped: DataFrame, stamp: bool) -> DataFrame:
        """Ratios, time stamp, order and flags of a frame that has keys and aggregates."""
        named = grouped.withColumns({r: ratio(a, b) for r, (a, b) in self.ratios.items()} | {
            "calculated_at": stamps.stamp()})
        sorted_ = named.orderBy(*(self.order or self.keys))
        return rules.gold_metric_flags(sorted_, self.metrics(), stamp=stamp)

    def build(self, rows: DataFrame, stamp: bool) -> DataFrame:
        """Each summed column is added up once, however many metrics come of it."""
        summed = {m.column: m.column for m in self.aggregates.values() if isinstance(m, Total)}
        plain = {n: m for n, m in self.aggregates.items() if not isinstance(m, Total)}
        grouped = split_values(rows, summed).groupBy(*self.keys).agg(
            *[c.alias(n) for n, c in plain.items()], *[p for c in summed for p in part_sums(c)])
        return self.finish(with_totals(grouped, summed).select(*self.keys, *[
            F.col(n) if n in plain else m.value().alias(n) for n, m in self.aggregates.items()]), stamp)


def _distinct(col: str, approx: bool) -> Column:
    return F.approx_count_distinct(col) if approx else F.count_distinct(col)


def customer_table() -> MetricTable:
    return MetricTable(["customer_segment", "city"], {
        "customer_count": F.count("customer_id"),
        "avg_risk_score": Mean("risk_score"),
        "avg_balance": Mean("account_balance"),
        "avg_credit_limit": Mean("credit_limit"),
        "total_balance": Total("account_balance")})


def transaction_table(approx_distinct: bool = False) -> MetricTable:
    return MetricTable(["transaction_day", "status", "channel"], {
        "transaction_count": F.count("transaction_id"),
        "unique_customers": _distinct("customer_id", approx_distinct),
        "total_amount": Total("amount"), "avg_amount": Mean("amount"), "max_amount": F.max("amount"),
        # all-NULL flags give NULL (then flagged null_fraud_count), not 0
        "fraud_count": F.sum(F.col("is_fraud").cast("int"))}, {"fraud_rate": ("fraud_count", "transaction_count")})


def merchant_table(times: Column) -> MetricTable:
    """Aggregates as they follow from one row per merchant, which stands for ``times`` joined rows each."""
    return MetricTable(["merchant_id", "merchant_name", "category", "country"], {
        "transaction_count": F.col("_rows") * times, "unique_customers": F.col("_customers"),
        "total_revenue": total("_amount", many=True), "avg_transaction_value": mean("_amount"),
        "successful_transactions": F.col("_completed") * times, "failed_transactions": F.col("_failed") * times},
        {"success_rate": ("successful_transactions", "transaction_count")},
        [F.col("total_revenue").desc(), F.col("merchant_id")])


def customer_metrics(silver_customers: DataFrame, stamp: bool = True) -> DataFrame:
    """Per (customer_segment, city): count, average risk / balance / limit, total balance."""
    return customer_table().build(silver_customers, stamp)


def transaction_metrics(silver_transactions: DataFrame, stamp: bool = True,
                        approx_distinct: bool = False) -> DataFrame:
    """Per (day, status, channel): counts, distinct customers, amount stats, fraud count / rate."""
    day = F.date_trunc("day", F.col("transaction_date"))
    return transaction_table(approx_distinct).build(silver_transactions.withColumn("transaction_day", day), stamp)


def merchant_performance(silver_transactions: DataFrame, silver_merchants: DataFrame,
                         stamp: bool = True, approx_distinct: bool = False) -> DataFrame:
    """Transactions joined to merchants, per (merchant_id, name, category, country).

    Equivalent to joining first and grouping after, but the transactions are
    aggregated per merchant *before* the join: a merchant holding a large
    share of all rows is combined map-side, and the join is between two
    tables of merchant size.  A merchant key present ``k`` times on the
    merchant side multiplies its counts and sums by ``k``, exactly as the
    row-level join would.
    """
    per_merchant = split_values(silver_transactions, {"_amount": "amount"}).groupBy("merchant_id").agg(
        F.count("transaction_id").alias("_rows"),
        _distinct("customer_id", approx_distinct).alias("_customers"),
        *part_sums("_amount"),
        *[F.count_if(F.col("status") == s).alias(f"_{s}") for s in ("completed", "failed")])
    spec = merchant_table(F.col("_times"))
    merchants = silver_merchants.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("_times"))
    joined = with_totals(per_merchant.join(merchants, "merchant_id", "inner"), ["_amount"], F.col("_times"))
    return spec.finish(joined.select(*spec.keys, *[c.alias(n) for n, c in spec.aggregates.items()]), stamp)


#: log2 of a sketch's registers: 4,096 of them, a standard error of about 1.6 % of a count.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def daily_customer_sketches(silver_transactions: DataFrame) -> DataFrame:
    """Per (day, status, channel): transactions, and a sketch of the distinct customers (some kB at most).

    Stored once a day, sketches add up to any longer period without reading the transactions again, which
    counts of distinct customers do not.
    """
    day = F.date_trunc("day", F.col("transaction_date"))
    return silver_transactions.groupBy(day.alias("transaction_day"), "status", "channel").agg(
        F.count("transaction_id").alias("transaction_count"),
        F.hll_sketch_agg("customer_id", F.lit(SKETCH_BITS)).alias("customers_sketch"))


def unique_customers_over(sketches: DataFrame, period: str = "month") -> DataFrame:
    """Per (period, status, channel): transactions, and the estimated distinct customers, from daily sketches.

    The estimate is within three standard errors (``3 * SKETCH_ERROR``) of the exact count in 99.7 % of cases.
    """
    return sketches.groupBy(F.date_trunc(period, F.col("transaction_day")).alias("period"), "status", "channel").agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.hll_sketch_estimate(F.hll_union_agg("customers_sketch")).alias("unique_customers"))
