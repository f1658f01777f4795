"""Presentation of results for comparison with an SQL oracle.

Audit stamps and file paths are not reproducible and are dropped; issue
arrays become comma-joined strings; session-zone timestamps become wall-clock
``timestamp_ntz`` so the result does not depend on the reader's zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NON_REPRODUCIBLE = ("ingestion_timestamp", "processed_timestamp", "quality_check_timestamp",
                    "calculated_at", "source_file")


def present(df: DataFrame, drop: tuple[str, ...] = NON_REPRODUCIBLE) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)
