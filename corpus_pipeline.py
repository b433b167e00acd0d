"""A corpus pipeline over ``documents``: its stages are operators of ``lodestar.llm``, each written as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import exact, mixing, near, pieces, quality
from lodestar.session import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labels beside the documents, drop what the network scores below 0.3."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality.fit(docs, labels, modulus=5, remainder=0)
    wrapped = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), "text")
    good = quality.score(wrapped, net, threshold=0.3).filter("predicted = 1")
    return good.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by links of 0.8 on shingles of five words the smallest id stays."""
    return near.keep_one(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, half way from the sources' own entropy to equal shares, no source more than four times."""
    return mixing.mixture(docs, flatten=0.5, max_epochs=4.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece numbers of every text that is taken."""
    return pieces.encode(docs, pieces.Vocabulary.load(pieces.MODEL_FILE))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifier and the tokenizer cannot be said in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, starting from ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
