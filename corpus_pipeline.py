"""From raw documents to a mixed, encoded corpus: five stages, each a function of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isodose.llm import cube_mix, fm_dedup, line_rules, ngram_join, piece_codec
from isodose.llm.common import materialise
from isodose.llm.queries import PIECE_MODEL, vocabulary


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their hosts' boilerplate lines."""
    return _sized(line_rules.clean(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard 0.8."""
    return ngram_join.keep_one(docs, width=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words and more that occur elsewhere too."""
    return _sized(fm_dedup.cut_repeats(docs, length=35))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources repeats them."""
    return cube_mix.mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's pieces, and whether they decode to its text."""
    return piece_codec.summarise(docs, vocabulary(PIECE_MODEL))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_passages),
    ("source mixing", source_mix),
    ("SentencePiece encoding", pieces),
]

#: SQL cannot express the stages; tests/llm holds them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{place + 1}")
    return docs
