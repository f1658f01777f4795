"""Raw feed readers: JSON lines and CSV, bound by *name*, typed leniently.

Both readers read every declared field as text and type it afterwards with
:mod:`stratum.functions.casts`, so a feed that writes flags as ``1``/``0``,
dates as epoch milliseconds or ints as ``1234.0`` still loads.  The reader
keeps ``source_file`` (``_metadata.file_path``) and the malformed-record text
(``_corrupt_record``), which :func:`quarantine` routes to its own table, and
``_bad_fields``, the text of each field that has no value of its type in an otherwise good
row, which :func:`bad_fields` lists.

CSV is bound by header *name*, file by file: a glob of files whose headers
differ (columns added, dropped or reordered over time) is read per distinct
header and the parts are combined with ``unionByName``.  Binding by position
would shift values into the wrong columns.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.casts import string_schema, type_strings
from stratum.operators.reports import union_all

CORRUPT = "_corrupt_record"
SOURCE = "source_file"
BAD = "_bad_fields"


def read_json_feed(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON lines -> ``schema`` columns + ``_bad_fields``, ``source_file`` and ``_corrupt_record``."""
    text_schema = string_schema(schema.fieldNames(), CORRUPT)
    raw = (
        spark.read.schema(text_schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias(SOURCE))
    )
    return type_strings(raw, schema, keep=(SOURCE, CORRUPT), failed=BAD)


def _split_header(line: str, sep: str) -> list[str]:
    row = next(csv.reader(io.StringIO(line.lstrip("﻿")), delimiter=sep), [])
    return [c.strip() for c in row]


def _first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header) of every file under ``path``: its first line that is not blank.

    Within a scan task rows come in file order, so that line is the row with the
    smallest id in the file's first split; the minimum is a partial aggregate
    (one row per file and task).
    """
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block_start"),
            "value",
            F.monotonically_increasing_id().alias("rid"),
        )
        .filter((F.col("block_start") == 0) & (F.ltrim("value", F.lit("\ufeff ")) != ""))
        .groupBy("file")
        .agg(F.min_by("value", "rid").alias("header"))
    )


def feed_headers(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Distinct header lines of the files under ``path`` -> the paths to read for each.

    The driver gets the distinct headers.  While there is one, its files are ``path``
    itself; only a feed whose layout has drifted needs the files of each layout by name.
    """
    first = _first_lines(spark, path).persist()  # a row a file; the text is read once for headers and names
    try:
        found = [r["header"] for r in first.select("header").distinct().collect()]
        if len(found) <= 1:
            return {h: [path] if isinstance(path, str) else list(path) for h in found}
        groups: dict[str, list[str]] = {}
        for r in first.toLocalIterator():
            groups.setdefault(r["header"], []).append(literal_path(r["file"]))
        return {h: sorted(files) for h, files in groups.items()}
    finally:
        first.unpersist()


def first_header(spark: SparkSession, path: str | list[str], lines: int = 1000) -> str:
    """The header of one file of a feed, from its first lines alone: for a feed whose files all have one layout."""
    # a limit stops its scan where it has enough; blank lines before a header count among ``lines``
    for r in spark.read.text(path).limit(lines).toLocalIterator():
        if r["value"].replace("\ufeff", "").strip():
            return r["value"].replace("\ufeff", "")
    raise ValueError(f"no header within {lines} lines of {path}")


_GLOB_CHARS = re.compile(r"([\\\[\]{}*?])")


def literal_path(uri: str) -> str:
    """A file URI as Spark reports it (``_metadata.file_path``, ``binaryFile``'s
    ``path``: percent-encoded) -> a path the readers take literally (decoded,
    glob characters escaped)."""
    return _GLOB_CHARS.sub(r"\\\1", unquote(uri))


def _unique(names: list[str]) -> list[str]:
    """Header names as column names: blank ones named, repeated ones (without case) numbered."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        n = n or "_blank"
        k = seen[n.lower()] = seen.get(n.lower(), -1) + 1
        out.append(f"{n}__{k}" if k else n)
    return out


def read_csv_feed(spark: SparkSession, path: str | list[str], schema: T.StructType,
                  sep: str = ",", multi_line: bool = False, required: Sequence[str] = (),
                  header: str | None = None) -> DataFrame:
    """CSV files with a header line -> ``schema`` columns, bound by header name, without case.

    Declared fields a file lacks are NULL; columns a file has but the schema
    does not are dropped.  A row with too many or too few fields keeps its
    text in ``_corrupt_record``.  A header that lacks a ``required`` column fails
    the read: all its rows would lack their key.  Passing the known ``header`` line
    of a feed of one layout (see :func:`first_header`) saves the pass that looks for headers; every file's header is
    then compared with it while the file is parsed, and one that differs fails the job instead of being misread.
    """
    if header is not None:
        groups = {header: [path] if isinstance(path, str) else list(path)}
    else:
        groups = feed_headers(spark, path)
    parts = []
    for line, files in sorted(groups.items()):
        names = _unique(_split_header(line, sep))
        lacking = {r.lower() for r in required} - {n.lower() for n in names}
        if lacking:
            raise ValueError(f"a feed file lacks {', '.join(sorted(lacking))}: header {line!r}, files {files[:3]}")
        df = (
            spark.read.schema(string_schema(names, CORRUPT))
            .option("header", True)
            .option("enforceSchema", header is None)  # else Spark compares each file's header
            .option("sep", sep)
            .option("multiLine", multi_line)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            # all fields are parsed, so that a row is judged on all of them, wanted or not
            .option("columnPruning", False)
            .csv(files)
            .select("*", F.col("_metadata.file_path").alias(SOURCE))
        )
        parts.append(type_strings(df, schema, keep=(SOURCE, CORRUPT), failed=BAD))
    if not parts:
        empty = spark.createDataFrame([], string_schema(schema.fieldNames(), CORRUPT))
        return type_strings(empty.withColumn(SOURCE, F.lit(None).cast("string")), schema, keep=(SOURCE, CORRUPT), failed=BAD)
    return union_all(parts)


def quarantine(feed: DataFrame) -> DataFrame:
    """Malformed records with every parsed field, their file and their text."""
    return feed.filter(F.col(CORRUPT).isNotNull())


def bad_fields(feed: DataFrame, key: str) -> DataFrame:
    """(row_key, field, text, source_file): one row per field whose text has no value of its type."""
    return feed.filter(F.col(BAD).isNotNull()).select(
        F.col(f"`{key}`").alias("row_key"), F.explode(BAD).alias("field", "text"), SOURCE)


def without_corrupt(feed: DataFrame) -> DataFrame:
    return feed.drop(CORRUPT, BAD)
