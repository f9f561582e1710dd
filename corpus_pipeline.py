"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

quality classifier, n-gram Jaccard join (one document of each group stays), benchmark decontamination, mixing of
sources, sharding. Every stage reads all rows that its predecessor kept, and all but the last return the columns of the
documents. A document repeated by the mixing is a row for each time it is drawn.

Nulls and edges: null and empty texts are scored like others, are in no group, hold no passage, weigh nothing in the
mixture (one copy) and count as one byte; rows equal in id and text are merged by the second stage, different texts of one
id are not; a null source is a source; an empty table passes through all stages. Other columns stay, but ``__vertex``,
``__tokens``, ``__size`` and ``__k0`` to ``__k2`` are names of the stages' own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.llm import decontamination, histogram_sort, ngram_join, quality_knn, queries, temperature_mixing
from medallion.llm.common import local_scratch, saved, table

#: The mixing of the pipeline, as in op9_mixing: the most plentiful source once, no other more than four times, so no document
#: is lost.
MIX = temperature_mixing.MixSpec(repeats=4.0)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    local_scratch(spark)
    return quality_knn.accepted(docs, queries.quality_model(spark, docs, sf_dir), queries.LEAST_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    local_scratch(spark)
    return ngram_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    local_scratch(spark)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them."""
    local_scratch(spark)
    return temperature_mixing.drawn(temperature_mixing.mix(docs, MIX), docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their size, shard and slot."""
    local_scratch(spark)
    return histogram_sort.shard(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: The classifier and the hash orders have no SQL counterpart; the pipeline is tested against a version by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    local_scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.split()[0])
    return docs
