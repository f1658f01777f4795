"""Numbers for rows in the order that a frame has, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import scratch_path

_PART_BITS = 33  # of monotonically_increasing_id: the partition stands above, the row within it below


def with_rank(df: DataFrame, out: str = "rank") -> DataFrame:
    """``df`` with each row's place, from 1, in the frame's own order (say, after ``orderBy``).

    A sort leaves range partitions in order; the rows are stored as they lie, with partition and place, and the
    sizes of the partitions before each one are added.  The only window is over one row per partition.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    df.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumns({
        "_part": F.shiftright("_at", _PART_BITS), "_row": F.col("_at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))})
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = rows.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(offsets, "_part").select(*df.columns, (F.col("_before") + F.col("_row") + 1).alias(out))
