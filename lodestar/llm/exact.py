"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_groups(docs: DataFrame, keep: str = "min") -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are; a null text counts as empty. Of equal texts the row
    with the smallest (``keep="max"``: the largest) id stays; null ids count as smallest. Rows that repeat
    an id and its text are one document written twice: the first of them stays. Groups are formed
    on the hash **and** the text, so the grouping itself compares the bytes and texts that merely
    collide fall apart; the aggregation combines on the map side, so a text leaves a task
    once however many copies it has. Other columns are ignored, an empty table gives an empty one.
    """
    best = {"min": F.min, "max": F.max}[keep]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    groups = (
        texts.groupBy(F.unhex(F.md5("text")).alias("hash"), "text")
        # A null id comes first in this order, as in Spark's sorting.
        .agg(best(F.struct("doc_id")).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.unhex(F.sha2("text", 256)).alias("sha"), F.col("best.doc_id").alias("keep_id"), "group_size")
    )
    members = texts.select(
        "doc_id", F.unhex(F.md5("text")).alias("hash"), F.unhex(F.sha2("text", 256)).alias("sha")
    ).groupBy("hash", "sha", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    # Beside the hash, a second one tells colliding texts apart; sizes are per text, compared by bytes.
    joined = members.join(groups, ["hash", "sha"])
    numbered = joined.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return numbered.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, keep: str = "min") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per text.

    Of rows that repeat id and text, any one stays. As in ``exact_groups`` the texts themselves
    are grouped; they are shuffled once.
    """
    best = {"min": F.min_by, "max": F.max_by}[keep]
    plain = F.coalesce("text", F.lit(""))
    rest = [F.col(c) for c in docs.columns if c != "text"]
    stay = docs.groupBy(F.unhex(F.md5(plain)).alias("hash"), plain.alias("plain")).agg(
        best(F.struct(*rest, F.col("text").isNull().alias("text")), F.struct("doc_id")).alias("row")
    )
    text = F.when(~F.col("row.text"), F.col("plain")).alias("text")
    return stay.select(*(text if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
