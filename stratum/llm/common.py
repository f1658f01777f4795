"""Helpers shared by the operators: bounded slices of Arrow batches, 64-bit hashing, stored tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import scratch_path

#: Text bytes that a Python worker takes in hand at once; a longer single text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Narrow tables of at most so many rows are broadcast, after being counted.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and gives Spark its true size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table as one side of a join: broadcast if it has at most ``most_rows`` rows, else left to
    Spark's shuffle joins.  For rows of a few dozen bytes (keys, ids, counts: 100 MB at most by default), so that the
    larger side stays where it is; callers with longer rows pass a smaller bound."""
    return F.broadcast(df) if df.count() <= most_rows else df


def text_slices(batches: Iterable[pa.RecordBatch], text_at: int = 1,
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into runs of at most ``limit`` text bytes; a NULL text reads as ''."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            part = batch.slice(start, stop - start)
            yield part, [t or "" for t in part.column(text_at).to_pylist()]
            start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def uniform(h: np.ndarray) -> np.ndarray:
    """Uniform doubles in (0, 1) from scrambled 64-bit integers."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))
