"""Labelled rows for training: the part that may be learned from, and a bounded sample of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(modulus: int, remainder: int) -> Column:
    """Rows whose id's checksum leaves this remainder are never learned from. A null id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(True))


def training_labels(labels: DataFrame, label: str, modulus: int, remainder: int) -> DataFrame:
    """``doc_id`` and ``y`` (0 or 1) of the labels that may be learned from; rows without a label are left out."""
    usable = labels.filter(~held_out(modulus, remainder) & F.col(label).isin(0, 1))
    return usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))


def sampled(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labels, the same at every run, classes in their proportion."""
    return labels.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id", "y").limit(rows)
