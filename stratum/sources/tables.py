"""Stored tables and feed exports.

* :func:`read_table` / :func:`write_table`: the layer hand-off.  Full refresh
  (``overwrite``); the format is a setting (``parquet`` by default, ``delta`` where its jars are on the
  classpath).  ``delta`` merges schemas when it writes, Parquet when it reads (``merge_schema``).  Parquet is
  compressed with zstd, about two thirds of snappy's size; a write leaves no shuffle files behind.
* :func:`replace_partitions`: only the partitions that the new rows lie in are written anew.
* :func:`write_counted`: a write that counts conditions on its rows as they pass, without another pass.
* :func:`export_monthly_csv` / :func:`export_json_lines`: write entity frames
  as raw feeds (one CSV folder per ``yyyy-MM`` of the event time; JSON
  lines).  ``legacy_types`` encodes values the way pandas-made feeds do:
  flags as 1/0, dates as epoch milliseconds, ints as floats (``1234.0``),
  so ingestion can be tested against them.  ``compression`` (say ``gzip``) compresses the CSV files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import shuffles_dropped

DEFAULT_FORMAT = "parquet"


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, merge_schema: bool = False) -> DataFrame:
    """``merge_schema``: columns of all of a Parquet table's files, at the price of reading every file's footer."""
    reader = spark.read.format(fmt)
    return (reader.option("mergeSchema", True) if merge_schema else reader).load(path)


def _writer(df: DataFrame, fmt: str, mode: str) -> DataFrameWriter:
    w = df.write.format(fmt).mode(mode)
    return w.option("compression", "zstd") if fmt == "parquet" else w


def write_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "overwrite",
                merge_schema: bool = True, partition_by: Sequence[str] = ()) -> None:
    w = _writer(df, fmt, mode)
    if merge_schema and fmt == "delta":
        w = w.option("mergeSchema", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        w.save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = DEFAULT_FORMAT) -> None:
    """Write ``df`` over the partitions that its rows lie in; all others stay as they are, file by file.

    ``df`` must not read from ``path``: store what was read of it first.
    """
    with shuffles_dropped(df.sparkSession):
        _writer(df, fmt, "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)


def write_counted(df: DataFrame, path: str, counts: Mapping[str, Column], fmt: str = DEFAULT_FORMAT, **how) -> dict[str, int]:
    """:func:`write_table`, and for each of ``counts`` how many rows its condition held for, counted by the tasks that
    write (a retried or repeated task counts once)."""
    if not counts:
        write_table(df, path, fmt, **how)
        return {}
    seen = Observation()
    write_table(df.observe(seen, *[F.count_if(c).alias(n) for n, c in counts.items()]), path, fmt, **how)
    return {n: int(v) for n, v in seen.get.items()}


def _legacy(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(f.dataType, T.DateType):
            # epoch milliseconds of the date's UTC midnight, whatever the session zone
            c = F.datediff(c, F.lit("1970-01-01").cast("date")).cast("bigint") * F.lit(86_400_000)
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("double")            # an int column with gaps, as pandas writes it
        cols.append(c.alias(f.name))
    return df.select(*cols)


def export_json_lines(df: DataFrame, path: str, legacy_types: bool = False) -> None:
    out = _legacy(df) if legacy_types else df
    out.write.mode("overwrite").json(path)


def export_monthly_csv(df: DataFrame, path: str, time_col: str, legacy_types: bool = False,
                       time_format: str = "yyyy-MM-dd HH:mm:ss", mode: str = "overwrite",
                       compression: str = "none") -> None:
    """One folder per month of ``time_col`` (``year_month=yyyy-MM``), header on.

    Range-partitioned by (month, time, row) before writing, so a month has as
    many files as tasks its rows span, and one busy second spreads over tasks too.
    """
    dtype = df.schema[time_col].dataType
    ts = F.col(time_col) if not isinstance(dtype, T.StringType) else F.try_to_timestamp(F.col(time_col))
    out = df.withColumn("year_month", F.date_format(ts, "yyyy-MM"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        out = out.withColumn(time_col, F.date_format(F.col(time_col), time_format))
    if legacy_types:
        out = _legacy(out)
    # contiguous time ranges per task: each task writes one or two months'
    # files (not one per month per task), and a large month still spreads
    # over several tasks
    out = out.repartitionByRange(F.col("year_month"), F.col(time_col), F.xxhash64(*[F.col(f"`{c}`") for c in out.columns]))
    with shuffles_dropped(df.sparkSession):
        (out.write.mode(mode).partitionBy("year_month").option("header", True).option("compression", compression)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("dateFormat", "yyyy-MM-dd").csv(path))
