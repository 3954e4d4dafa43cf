"""From raw documents to packed training sequences: five stages, each written and read again.

All stages but the last return the columns of documents. Every decision takes effect: rejected and
duplicate documents go, repeated lines and passages are taken out of the texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from helio.llm import line_dedup, ngram_join, packing, quality, substring_dedup
from helio.llm.common import small_batches
from helio.session import WRITTEN, discard, materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words of a shingle, and per cent of all shingles that near-duplicates share.
SHINGLE, PERCENT = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained classifier does not reject."""
    small_batches(spark)
    return quality.keep_good(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents hold stay in one of them."""
    small_batches(spark)
    return line_dedup.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    small_batches(spark)
    return ngram_join.clean(docs, size=SHINGLE, percent=PERCENT)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages stay where they occur first."""
    small_batches(spark)
    return substring_dedup.clean(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, by sequence."""
    small_batches(spark)
    return packing.pack(docs, packing.vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", drop_passages),
    ("packing", pack_sequences),
]

#: SQL expresses neither the learnt stage nor the hashed ones; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = len(WRITTEN.paths)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        # the stage's own tables and the stage before it are read no more: only its result stays on disk
        discard(spark, WRITTEN.paths[first:-1])
    return docs
