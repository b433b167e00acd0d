"""A keyed log as a table: ``key, value, topic, partition, offset, timestamp``.

With the log connector on the class path pass ``fmt="kafka"``; otherwise the same columns are
read from files. Everything downstream sees the same schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the log envelope.
ENVELOPE = "key BINARY, value BINARY, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP"


def read_log(
    spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None, stream: bool = False
) -> DataFrame:
    """Open the log as a batch or a stream.

    A bounded batch read from ``startingOffsets=earliest`` replays the log without touching
    any other reader: a reader's progress lives in its own checkpoint.
    """
    reader = (spark.readStream if stream else spark.read).format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(ENVELOPE)
    return reader.load(path) if path else reader.load()


def encode_log(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Messages to send: text key and JSON value (no escaping of non-ASCII letters)."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def as_envelope(df: DataFrame, topic: str, partition: Column, offset: Column, timestamp: Column) -> DataFrame:
    """Give encoded messages the envelope a broker would add (for logs kept in files)."""
    return df.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def replay_count(log: DataFrame) -> DataFrame:
    """Messages and end offset per partition of a bounded read."""
    return log.groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"), (F.max("offset") + 1).alias("end_offset")
    )
