"""Streaming operators. Each takes messages and gives a DataFrame; source and sink stay outside,
so the stateless and single-aggregate ones serve batch and stream alike."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from lodestar.operators.aggregate import counter, pct_flag

#: Keyed state lives on disk next to the executor and in the checkpoint, not on the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Shelves that keys are hashed onto. They number the pieces of state, so a checkpoint holds for one number only.
SHELVES = 256


def stream_counts(messages: DataFrame, key: str, flag: Column) -> DataFrame:
    """Messages per key and the percentage of true flags, most first.

    On a stream the sort is legal in complete mode only.
    """
    return pct_flag(messages, key, flag).orderBy(F.desc("messages"), key)


def stream_counter(messages: DataFrame, key: str) -> DataFrame:
    """Running counter per key (update mode)."""
    return counter(messages, key)


def _judge(frame: pd.DataFrame, value: str, pct: float, strict: bool) -> tuple[pd.DataFrame, np.ndarray]:
    """A frame with ``previous`` and its changes, and which rows moved by at least ``pct`` percent."""
    base = frame["previous"].where(frame["previous"] != 0)
    frame = frame.assign(change_pct=(frame[value] - base) / base * 100)
    size = frame["change_pct"].abs()
    frame["direction"] = np.where(frame["change_pct"] > 0, "up", "down")
    return frame, ((size > pct) if strict else (size >= pct)).to_numpy()


def stream_change_alert(
    messages: DataFrame, key: str, order: Sequence[str], value: str, pct: float = 0.05, strict: bool = False, bucket: Column | None = None
) -> DataFrame:
    """Alerts of a keyed stream: value moved by at least ``pct`` percent since the key's last one.

    Keys are hashed onto ``SHELVES``. Within a micro-batch the messages of a shelf are put in the order of key and ``order`` (only the listed
    columns travel to Python), one ``bucket`` at a time: an expression that rises with the order, such as the minute of a
    time stamp, so that a key which dominates the stream spreads over tasks and none holds more than one bucket of it. Work per
    call is that of a shelf, so many small keys cost their rows and nothing each. A bucket leaves its alerts and the two ends of
    every key; the ends alone are then read shelf by shelf, and the first row of a key's bucket is compared with the last value before
    it. That value is checkpointed state, all of a shelf in one piece, so a restart loses nothing; the first message of a key emits
    nothing. A rate limit of the source bounds a micro-batch. The session must use the RocksDB provider (:data:`ROCKSDB`)
    when the query starts.
    """
    order = list(order)
    fields = {f.name: f.dataType for f in messages.schema.fields}
    names = [key, *order, value]
    schema = StructType()
    for name in names:
        schema = schema.add(name, fields[name])
    schema = schema.add("previous", "double").add("change_pct", "double").add("direction", "string")
    # Names of a grouped function's columns must not begin with an underscore.
    ends = StructType(list(schema.fields)).add("bucket_end", "double")

    def inside(rows: pa.Table) -> pa.Table:
        rows = rows.select(names).combine_chunks()
        codes = rows.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices
        rows = rows.append_column("key_code", codes).sort_by([(c, "ascending") for c in ("key_code", *order)])
        code = rows.column("key_code").to_numpy()
        rows = rows.select(names)
        values = rows.column(value).to_numpy().astype(float)
        first = np.concatenate([[True], code[1:] != code[:-1]])
        start = np.flatnonzero(first)
        base = np.concatenate([[np.nan], values[:-1]])
        base[start] = np.nan
        end = np.full(len(values), np.nan)
        end[start] = values[np.concatenate([start[1:], [len(values)]]) - 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            change = np.where(base != 0, (values - base) / base * 100, np.nan)
        hit = np.abs(change) > pct if strict else np.abs(change) >= pct
        # The first row stands for the key's bucket and carries its last value; whether it is an alert is not known yet.
        place = np.flatnonzero(hit | first)
        for name, column in (("previous", base), ("change_pct", change), ("direction", np.where(change > 0, "up", "down")), ("bucket_end", end)):
            rows = rows.append_column(name, pa.array(column, from_pandas=True))
        return rows.take(pa.array(place))

    class LastValues(StatefulProcessor):
        def init(self, handle) -> None:
            self.shelf = handle.getValueState("shelf", "last binary")

        def handleInputRows(self, keys, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
            firsts = []
            for chunk in rows:
                first = chunk["bucket_end"].notna().to_numpy()
                yield chunk.loc[~first, schema.names]
                firsts.append(chunk[first])
            edge = pd.concat(firsts).sort_values(order, kind="stable", ignore_index=True)  # one row per key and bucket
            if not len(edge):
                return
            code = pd.factorize(edge[key], use_na_sentinel=False)[0]
            place = np.argsort(code, kind="stable")
            edge, code = edge.iloc[place], code[place]
            start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            end = edge["bucket_end"].to_numpy(float)
            previous = np.concatenate([[np.nan], end[:-1]])
            here = [None if k != k else k for k in edge[key].iloc[start].tolist()]
            last = {}
            if self.shelf.exists():
                known = pa.ipc.open_stream(bytes(self.shelf.get()[0])).read_all()
                last = dict(zip(known.column("key").to_pylist(), known.column("last").to_pylist()))
            previous[start] = [last.get(k, np.nan) for k in here]
            last.update(zip(here, end[np.concatenate([start[1:], [len(end)]]) - 1].tolist()))
            table, kept = pa.table({"key": list(last), "last": list(last.values())}), pa.BufferOutputStream()
            with pa.ipc.new_stream(kept, table.schema) as out:
                out.write_table(table)
            self.shelf.update((kept.getvalue().to_pybytes(),))
            edge, hit = _judge(edge.assign(previous=previous), value, pct, strict)
            yield edge.loc[hit, schema.names]

        def close(self) -> None:
            pass

    # A missing key has a shelf of its own, so that it does not turn whole numbers next to it into fractions.
    on_shelf = lambda df: df.withColumn("shelf", F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(SHELVES))).cast("int"))
    buckets = on_shelf(messages.select(*names, (F.lit(0) if bucket is None else bucket).alias("_bucket"))).groupBy("shelf", "_bucket")
    return on_shelf(buckets.applyInArrow(inside, ends)).groupBy("shelf").transformWithStateInPandas(
        statefulProcessor=LastValues(), outputStructType=schema, outputMode="Append", timeMode="None"
    )


def reader_lag(ends: DataFrame, positions: DataFrame) -> DataFrame:
    """Messages a reader still has to read, per partition (a partition never read counts whole)."""
    position = F.coalesce(F.col("position"), F.lit(0))
    return ends.join(positions, "partition", "left").select(
        "partition", "end_offset", position.alias("position"), (F.col("end_offset") - position).alias("lag")
    )
