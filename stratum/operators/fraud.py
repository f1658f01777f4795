"""Fraud scoring of transactions.

Indicators (defaults are the specified ones):

* high velocity: ``>= velocity_min`` transactions of the customer in the
  trailing ``window_seconds`` (inclusive, same-second peers counted)
* unusual hour: hour of day in ``unusual_hours`` (inclusive)
* high amount: ``amount > amount_factor x`` the customer's average amount
  over *all* their transactions (past and future)

``fraud_score`` is the weighted sum, ``risk_level`` HIGH / MEDIUM / LOW by
the two cut-offs.  Both window quantities are computed skew-safe (see
:mod:`stratum.operators.windows`): no task ever holds all rows of a customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.metrics import add_parts, epoch_seconds, mean, part_sums, split_values, with_totals
from stratum.operators.windows import join_on_nullsafe, metric_bucket, trailing_metrics

# fixed values: output columns
SCORED_COLUMNS = ["transaction_hour", "txn_count_1h", "customer_avg_amount", "is_high_velocity",
                  "is_unusual_hour", "is_high_amount", "fraud_score", "risk_level"]
HIGH_RISK_COLUMNS = ["transaction_id", "customer_id", "transaction_date", "amount",
                     "fraud_score", "risk_level", "is_fraud"]


def averages_by_bucket(base: DataFrame, key: str, amount: str, avg_out: str, windows: list[int]) -> DataFrame:
    """(key, _bucket, average over all the key's rows) for every bucket of time in which a key has rows (``_sec``).

    Sums are taken per (key, bucket) in the map tasks, then added over the buckets of each key: no task gets all
    rows of a hot key, only a row for each of its buckets.
    """
    by_bucket = split_values(base.select(key, "_sec", amount), {"_amount": amount}).groupBy(
        key, metric_bucket(F.col("_sec"), windows).alias("_bucket"))
    summed = by_bucket.agg(*part_sums("_amount")).withColumns(add_parts("_amount", Window.partitionBy(key)))
    return with_totals(summed, ["_amount"]).select(key, "_bucket", mean("_amount").alias(avg_out))


def with_window_features(df: DataFrame, *, key: str = "customer_id", ts: str = "transaction_date",
                         id_col: str = "transaction_id", amount: str = "amount",
                         window_seconds: int = 3600, count_out: str = "txn_count_1h",
                         avg_out: str = "customer_avg_amount") -> DataFrame:
    """Add the trailing count and the whole-history average per key.

    Plan: rows -> per (key, second) counts (partial aggregate) -> bucketed
    range window, into whose partitions the key's average comes as one row a bucket; the result is
    joined back to the rows on (key, second) -- the only shuffle of whole rows.
    """
    sec = epoch_seconds(F.col(ts), df.schema[ts].dataType)
    base = df.withColumn("_sec", sec)
    average = averages_by_bucket(base, key, amount, avg_out, [window_seconds])
    stats = trailing_metrics(base, key, "_sec", counts=[(id_col, count_out, window_seconds)], spread=average)
    out = join_on_nullsafe(base, stats, [key, "_sec"], "left")
    return out.drop("_sec")


def fraud_scores(df: DataFrame, *, key: str = "customer_id", ts: str = "transaction_date",
                 id_col: str = "transaction_id", amount: str = "amount",
                 window_seconds: int = 3600, velocity_min: int = 5, amount_factor: float = 5.0,
                 unusual_hours: tuple[int, int] = (0, 5), weights: tuple[int, int, int] = (40, 30, 30),
                 high_cutoff: int = 70, medium_cutoff: int = 40) -> DataFrame:
    """Add hour, trailing count, customer average, three indicators, score and level."""
    cols = df.columns
    feats = with_window_features(df, key=key, ts=ts, id_col=id_col, amount=amount,
                                 window_seconds=window_seconds)
    hour = F.hour(F.col(ts))
    velocity = F.when(F.col("txn_count_1h") >= velocity_min, 1).otherwise(0)
    unusual = F.when(hour.between(unusual_hours[0], unusual_hours[1]), 1).otherwise(0)
    high_amount = F.when(F.col(amount) > F.col("customer_avg_amount") * F.lit(amount_factor), 1).otherwise(0)
    wv, wh, wa = weights
    score = velocity * wv + unusual * wh + high_amount * wa
    level = (F.when(score >= high_cutoff, "HIGH").when(score >= medium_cutoff, "MEDIUM").otherwise("LOW"))
    return feats.select(
        *cols,
        hour.alias("transaction_hour"),
        "txn_count_1h", "customer_avg_amount",
        velocity.alias("is_high_velocity"),
        unusual.alias("is_unusual_hour"),
        high_amount.alias("is_high_amount"),
        score.alias("fraud_score"),
        level.alias("risk_level"),
    )


def high_risk(scored: DataFrame, min_score: int = 70) -> DataFrame:
    """Alerts: ``fraud_score >= min_score``, 7 columns, highest score first.

    Ties are ordered by transaction id so the range-partitioned sort is
    balanced (the score has only a handful of distinct values).
    """
    return (
        scored.filter(F.col("fraud_score") >= min_score)
        .select(*HIGH_RISK_COLUMNS)
        .orderBy(F.col("fraud_score").desc(), F.col("transaction_id"))
    )
