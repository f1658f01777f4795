"""Exact deduplication by 128-bit content hash, with bytes compared inside the groups.

Spark groups rows by their hash alone: 16 bytes and an id a row, combined inside each
map task, so a text that holds a third of all rows costs one row per task.  Only the texts
of hashes with two rows or more are then grouped by (hash, text): copies collapse in the
map tasks again, and texts that share a hash without being equal stay apart, byte by byte.
Most texts of a corpus are alone, and never move.
Rows then learn their group by a join of hashes against the groups of two and
more, which are stored first, so that Spark knows their size (broadcast only
after their rows are counted, else a shuffle join that AQE splits at a hot hash).

Defined results: a NULL text equals the empty text; rows with equal text and
equal id are one document repeated, all marked alike; a NULL id never wins against
another id, and in a group without any id ``keep_id`` is NULL; an empty table gives
an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import small_side, stored


def content_hash(text: Column) -> Column:
    """128 bits of the UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 hash_of: Callable[[Column], Column] = content_hash, keep: str = "max") -> DataFrame:
    """One row per input row: (doc_id, keep_id, group_size, kept, text_sha256).

    ``keep`` says which id of a group stays: ``max`` or ``min``.  ``hash_of`` is a
    parameter so that tests can make every text collide.
    """
    pick = {"max": F.max, "min": F.min}[keep]
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    hashed = rows.withColumn("h", hash_of(F.col("text")))
    # a hash of one row needs no join
    several = stored(hashed.groupBy("h").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                     .where("group_size > 1"), "exact-several")
    texts = (hashed.join(small_side(several.select("h")), "h", "left_semi").groupBy("h", "text").agg(F.lit(1))
             .groupBy("h").agg(F.count("*").alias("texts")))
    groups = stored(several.join(texts, "h"), "exact-groups")
    light = hashed.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"))
    out = light.join(small_side(groups.where("texts = 1").drop("texts")), "h", "left")
    collided = groups.where("texts > 1").select("h")
    if not collided.isEmpty():  # different texts under one hash: those rows are told apart by their text
        inside = hashed.join(collided, "h", "left_semi")
        split = inside.groupBy("h", "text").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        told = stored(split, "exact-collisions")
        out = out.join(collided, "h", "left_anti").unionByName(
            inside.join(told, ["h", "text"]).select("h", "doc_id", F.sha2("text", 256).alias("text_sha256"),
                                                    "keep_id", "group_size"))
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256")


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` (all columns) that stay; a repeated row (same id, same text) stays once."""
    told = stored(exact_groups(df, id_col, text_col).select(
        F.col("doc_id").alias("__id"), F.substring(F.unhex("text_sha256"), 1, 16).alias("__sha"), "kept"), "exact-decided")
    gone = stored(told.where("not kept").select("__id", "__sha").distinct(), "exact-dropped")
    repeated = told.where("kept").groupBy("__id", "__sha").count().where("count > 1").select("__id", "__sha")

    def same(other: DataFrame) -> Column:
        sha = F.substring(F.unhex(F.sha2(F.coalesce(df[text_col], F.lit("")), 256)), 1, 16)
        return df[id_col].eqNullSafe(other["__id"]) & (sha == other["__sha"])

    left = df.join(small_side(gone), same(gone), "left_anti")
    if repeated.isEmpty():
        return left
    twice = stored(repeated, "exact-repeated")
    once = df.join(twice, same(twice), "left_semi").dropDuplicates([id_col, text_col])
    return left.join(twice, same(twice), "left_anti").unionByName(once)
