"""The corpus pipeline: five filtering and encoding stages over ``documents``.

Each stage takes the rows that its predecessor left, with all their columns, and is defined as its operator is:
a NULL text counts as empty in every stage; rows are told apart by id and text, so rows of one id with
different texts are judged each for itself, and rows equal in both are one document, of which the exact stage keeps one;
a NULL id never wins over another id; ties go to the largest id in the exact stage and to the least in the near one; of
columns beyond those of ``documents`` all are kept by the filtering stages, whatever their names; an empty table goes
through all stages and gives an empty result.  Without a usable label every document has the same score of one half and stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import decontaminate, exact_dedup, near_dedup, quality, sentencepiece_sampling
from stratum.llm.common import stored, table
from stratum.llm.queries import quality_model, vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below one half go."""
    return quality.keep(docs, quality_model(spark, docs, sf_dir), at_least=0.5)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_dedup.one_of_each(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four sampled segmentations of every document that is left, and the texts they decode to."""
    return sentencepiece_sampling.encode_samples(docs, vocabulary("piece_bpe_32k.model"), k=4, decoded=True)


STAGES = [("quality", quality_stage), ("exact_dedup", exact_dedup_stage),
          ("near_dedup", near_dedup_stage), ("decontaminate", decontaminate_stage),
          ("sentencepiece", encode_stage)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
