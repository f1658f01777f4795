"""Bronze: typed raw rows + lineage columns + bronze quality flags (row-wise, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum import schemas
from stratum.functions import rules, stamps
from stratum.functions.casts import conform

LINEAGE = ("ingestion_timestamp", "source_file", "data_source")


def with_lineage(df: DataFrame, schema: T.StructType, source_tag: str) -> DataFrame:
    """Declared fields in order, then ``ingestion_timestamp, source_file, data_source``.

    ``source_file`` comes from a ``source_file`` column the reader carried
    (``_metadata.file_path``); frames built in memory get NULL.  A
    ``_corrupt_record`` and a ``_bad_fields`` column, if present, are kept after ``data_source``.
    """
    typed = conform(df, schema, keep=("source_file", "_corrupt_record", "_bad_fields"))
    src = F.col("source_file") if "source_file" in typed.columns else F.lit(None).cast("string")
    # a reader's malformed-record text and bad fields ride along (NULL for good rows), so the
    # quarantine can be cut from the stored bronze table without re-reading the feed
    kept = [F.col(c) for c in ("_corrupt_record", "_bad_fields") if c in typed.columns]
    return typed.select(
        *[F.col(f"`{f.name}`") for f in schema.fields],
        stamps.stamp().alias("ingestion_timestamp"),
        src.alias("source_file"),
        F.lit(source_tag).alias("data_source"),
        *kept,
    )


def bronze_customers(raw: DataFrame, source_tag: str = schemas.JSON_SOURCE_TAG) -> DataFrame:
    return rules.bronze_customer_flags(with_lineage(raw, schemas.CUSTOMERS, source_tag))


def bronze_merchants(raw: DataFrame, source_tag: str = schemas.JSON_SOURCE_TAG) -> DataFrame:
    # merchants have no bronze rule: every row starts valid
    return rules.default_valid(with_lineage(raw, schemas.MERCHANTS, source_tag))


def bronze_transactions(raw: DataFrame, source_tag: str = schemas.CSV_SOURCE_TAG,
                        card_as_text: bool = False) -> DataFrame:
    """``card_as_text`` keeps ``card_last_4`` as text (leading zeros kept, a
    float suffix such as ``1234.0`` dropped) instead of the declared int."""
    if not card_as_text:
        return rules.bronze_transaction_flags(with_lineage(raw, schemas.TRANSACTIONS, source_tag))
    typed = with_lineage(raw, schemas.TRANSACTIONS_CARD_TEXT, source_tag)
    card = F.regexp_replace(F.trim(F.col("card_last_4")), r"\.0+$", "")
    return rules.bronze_transaction_flags(typed.withColumn("card_last_4", card))
