"""Starting queries, and batch sinks that stay correct when a micro-batch is replayed.

Every batch sink writes one directory per micro-batch and overwrites it when that micro-batch
comes again. Its cost is that of the batch, never of the table; readers resolve versions when
they read, and :func:`compact` folds them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lodestar.operators.window import change_alert, latest_per_key

TEN_SECONDS = {"processingTime": "10 seconds"}
EVERYTHING_THEN_STOP = {"availableNow": True}


def start_query(
    df: DataFrame,
    sink: str | Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start a stream into a format (``console``, ``json``, ``parquet``, ``kafka``, …) or a batch function.

    The checkpoint is the reader's position: the same folder resumes, a fresh folder starts
    where the source says (``startingOffsets``).
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or TEN_SECONDS)).options(**(options or {}))
    return (writer.foreachBatch(sink) if callable(sink) else writer.format(sink)).start()


def write_epoch(batch: DataFrame, target: str, epoch: int) -> None:
    """Store one micro-batch under its number; a replay replaces it."""
    batch.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")


def read_epochs(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target)


def last_epoch(spark: SparkSession, target: str) -> DataFrame:
    """The newest micro-batch only: the whole table of a complete-mode query."""
    stored = read_epochs(spark, target)
    return stored.filter(F.col("epoch") == stored.agg(F.max("epoch")).scalar()).drop("epoch")


def archive(messages: DataFrame, target: str, checkpoint: str, fmt: str = "json", trigger: dict | None = None) -> StreamingQuery:
    """Store every message once as a document; the file sink's own log makes it exactly-once."""
    return start_query(messages, fmt, checkpoint, "append", trigger, {"path": target})


def archive_idempotent(batch: DataFrame, target: str, epoch: int) -> None:
    """Archive step for stores without transactions; see :func:`read_archive`."""
    write_epoch(batch, target, epoch)


def read_archive(spark: SparkSession, target: str, keys: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Archived messages, one per (partition, offset) even if batches with other numbers repeat them."""
    return read_epochs(spark, target).drop("epoch").dropDuplicates(list(keys))


def upsert_latest(batch: DataFrame, target: str, epoch: int, keys: Sequence[str], order: Sequence[str]) -> None:
    """Last write wins: the batch's newest row per key joins the table's versions."""
    write_epoch(latest_per_key(batch, list(keys), order), target, epoch)


def read_latest(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current table of :func:`upsert_latest`. Order decides, not arrival, so replays change nothing."""
    return latest_per_key(read_epochs(spark, target).drop("epoch"), list(keys), order)


def read_counters(spark: SparkSession, target: str, key: str, count: str = "n") -> DataFrame:
    """Current counters of an update-mode count: the value of the newest micro-batch per key."""
    return latest_per_key(read_epochs(spark, target), key, ["epoch"]).select(key, count)


def compact(spark: SparkSession, source: str, target: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Fold the versions of an upsert table into a new table with one version."""
    write_epoch(read_latest(spark, source, keys, order), target, 0)


def alert_batch(
    batch: DataFrame,
    target: str,
    epoch: int,
    key: str,
    order: Sequence[str],
    value: str,
    bucket: Column,
    pct: float = 0.05,
) -> None:
    """Change alerts of one micro-batch with the last row per key kept as a table.

    The previous micro-batch's state rows join the batch, and the batch operator, which splits
    hot keys by ``bucket``, does the rest. Micro-batch n reads state n-1 and writes state n,
    so replaying it gives the same alerts and the same state.
    """
    spark = batch.sparkSession
    rows = batch.select(key, *order, value).withColumn("_known", F.lit(False))
    if epoch > 0:
        known = spark.read.parquet(f"{target}/state/epoch={epoch - 1}").withColumn("_known", F.lit(True))
        rows = rows.unionByName(known.select(*rows.columns))
    rows.persist()
    try:
        alerts = change_alert(rows, key, order, value, bucket, pct).filter(~F.col("_known")).drop("_known")
        write_epoch(alerts, f"{target}/alerts", epoch)
        write_epoch(latest_per_key(rows, key, order).drop("_known"), f"{target}/state", epoch)
    finally:
        rows.unpersist()
