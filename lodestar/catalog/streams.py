"""Streams over the given tables, run until every available message is read.

``events`` arrives through the file source, or as a keyed log written from it.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lodestar.catalog import Catalog, table
from lodestar.catalog.files import MESSAGE_DDL, event_log
from lodestar.catalog.relational import CHANGE_ALERT_SQL
from lodestar.operators import join
from lodestar.session import scratch
from lodestar.sources import log
from lodestar.streaming import decode, jobs, sinks

catalog = Catalog()


@contextmanager
def _settings(spark, **conf):
    """Session settings for the time one query runs (state provider, state partitions)."""
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: No micro-batch takes more files or bytes than this, however much has piled up.
RATE = {"maxFilesPerTrigger": "64"}


def _events_stream(spark, sf):
    return spark.readStream.schema(table(spark, sf, "events").schema).options(**RATE).parquet(f"{sf}/events*.parquet")


#: Rows of a delivered file.
FILE_ROWS = 1_000_000


def _delivered(spark, rows, times=4, by="ts"):
    """``rows`` as they would arrive: one delivery of files after the other, in the order of a column. A folder, and the files that every delivery has."""
    path = scratch(spark, "delivered")
    stops = rows.agg(F.percentile_approx(by, [i / times for i in range(1, times)])).first()[0] or []
    place = F.lit(0)
    for stop in stops:
        place = place + (F.col(by) > F.lit(stop)).cast("int")
    files = max(1, -(-rows.count() // (times * FILE_ROWS)))
    for number in range(times):
        part = rows.filter(place == number)
        part.repartition(files).write.mode("append").parquet(path)
        # Few rows leave files out: with as many in each, a micro-batch never holds parts of two deliveries.
        for _ in range((number + 1) * files - len(spark.read.schema(rows.schema).parquet(path).inputFiles())):
            rows.limit(0).write.mode("append").parquet(path)
    return path, files


def _arriving(spark, delivered, schema):
    """The deliveries as a stream that takes one per micro-batch."""
    path, files = delivered
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).parquet(path)


def _log_stream(spark, sf):
    return log.read_log(spark, "parquet", {}, event_log(spark, sf), stream=True)


def _finish(df, sink, mode="append", options=None):
    """Run a stream over all that is available and wait for it."""
    spark = df.sparkSession
    query = sinks.start_query(df, sink, scratch(spark, "progress"), mode, sinks.EVERYTHING_THEN_STOP, options)
    query.awaitTermination()


def _into_epochs(df, mode):
    spark = df.sparkSession
    target = scratch(spark, "epochs")
    _finish(df, lambda batch, epoch: sinks.write_epoch(batch, target, epoch), mode)
    return target


@catalog.add("log_source_decode", "SELECT event_id AS \"offset\", user_id, event_type, value FROM events")
def _(spark, sf):
    out = scratch(spark, "decoded")
    messages = _log_stream(spark, sf).select("offset", "value")
    _finish(decode.decode_json(messages, "value", MESSAGE_DDL), "parquet", options={"path": out})
    return spark.read.parquet(out)


@catalog.add(
    "stream_counts",
    """SELECT event_type, count(*) AS messages,
       CAST(round(CAST(sum(CASE WHEN value > 90 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100) AS INTEGER) AS pct
       FROM events GROUP BY event_type""",
)
def _(spark, sf):
    messages = decode.decode_json(_log_stream(spark, sf).select("value"), "value", MESSAGE_DDL, drop_malformed=True)
    counts = jobs.stream_counts(messages, "event_type", F.col("value") > 90)
    return sinks.last_epoch(spark, _into_epochs(counts, "complete"))


@catalog.add(
    "stream_enrich",
    """SELECT event_id, user_id AS c_custkey, c_name, c_mktsegment, value FROM events JOIN customer ON user_id = c_custkey""",
)
def _(spark, sf):
    out = scratch(spark, "enriched")
    messages = _events_stream(spark, sf).select("event_id", F.col("user_id").alias("c_custkey"), "value")
    drivers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    _finish(join.enrich(messages, drivers, "c_custkey"), "parquet", options={"path": out})
    return spark.read.parquet(out)


def _ticks(spark, sf):
    return _events_stream(spark, sf).select("user_id", "ts", "event_id", "value")


def _alert_view(df):
    cols = ["event_id", "user_id", "value", "previous", F.round("change_pct", 4).alias("change_pct"), "direction"]
    return df.select(*cols)


@catalog.add("stream_change_alert", CHANGE_ALERT_SQL)
def _(spark, sf):
    out = scratch(spark, "alerts")
    with _settings(spark, spark__sql__streaming__stateStore__providerClass=jobs.ROCKSDB):
        alerts = jobs.stream_change_alert(_ticks(spark, sf), "user_id", ["ts", "event_id"], "value", bucket=F.date_trunc("week", "ts"))
        _finish(alerts, "parquet", options={"path": out})
    return _alert_view(spark.read.parquet(out))


_HOT_USER = "CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END"


@catalog.add("stream_change_alert_hot", f"WITH hot AS (SELECT * REPLACE ({_HOT_USER} AS user_id) FROM events), {CHANGE_ALERT_SQL[5:].replace('FROM events', 'FROM hot')}")
def _(spark, sf):
    """One key has a third of all events, which arrive over several micro-batches."""
    ticks = table(spark, sf, "events").select(F.expr(_HOT_USER).alias("user_id"), "ts", "event_id", "value")
    path, out = _delivered(spark, ticks), scratch(spark, "alerts")
    with _settings(spark, spark__sql__streaming__stateStore__providerClass=jobs.ROCKSDB):
        stream = _arriving(spark, path, ticks.schema)
        _finish(jobs.stream_change_alert(stream, "user_id", ["ts", "event_id"], "value", bucket=F.date_trunc("week", "ts")), "parquet", options={"path": out})
    return _alert_view(spark.read.parquet(out))


@catalog.add("stream_resume", "SELECT event_id, user_id, event_type, value, CAST(count(*) AS INTEGER) AS times FROM events GROUP BY ALL")
def _(spark, sf):
    """A reader that stops half way and starts again reads on where its checkpoint is: every message once."""
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    path, progress, out = _delivered(spark, rows, by="event_id"), scratch(spark, "progress"), scratch(spark, "resumed")
    read = 0

    def half(batch, epoch):
        nonlocal read
        if read >= 2:
            raise RuntimeError("the reader is stopped here")
        sinks.write_epoch(batch, out, epoch)
        read += 1

    def rest(batch, epoch):
        sinks.write_epoch(batch, out, epoch)

    first = sinks.start_query(_arriving(spark, path, rows.schema), half, progress, trigger=sinks.EVERYTHING_THEN_STOP)
    try:
        first.awaitTermination()
    except StreamingQueryException as stopped:
        if "the reader is stopped here" not in str(stopped):
            raise
    second = sinks.start_query(_arriving(spark, path, rows.schema), rest, progress, trigger=sinks.EVERYTHING_THEN_STOP)
    second.awaitTermination()
    return sinks.read_epochs(spark, out).groupBy("event_id", "user_id", "event_type", "value").agg(F.count(F.lit(1)).cast("int").alias("times"))


_BOTH_SQL = """SELECT {source} AS source, event_type, count(*) AS messages,
       CAST(round(CAST(sum(CASE WHEN value > 90 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100) AS INTEGER) AS pct FROM events GROUP BY event_type"""


@catalog.add("counts_batch_and_stream", _BOTH_SQL.format(source="'batch'") + " UNION ALL " + _BOTH_SQL.format(source="'stream'"))
def _(spark, sf):
    """The same function over the table and over the stream of its rows."""
    counts = lambda events: jobs.stream_counts(events.select("event_type", "value"), "event_type", F.col("value") > 90)
    rows = table(spark, sf, "events").select("event_id", "event_type", "value")
    stream = _arriving(spark, _delivered(spark, rows, by="event_id"), rows.schema)
    streamed = sinks.last_epoch(spark, _into_epochs(counts(stream), "complete"))
    both = {"batch": counts(rows), "stream": streamed}
    parts = [df.select(F.lit(name).alias("source"), "event_type", "messages", "pct") for name, df in both.items()]
    return parts[0].unionByName(parts[1])


@catalog.add("stream_change_alert_table", CHANGE_ALERT_SQL)
def _(spark, sf):
    target = scratch(spark, "alert-table")

    def step(batch, epoch):
        sinks.alert_batch(batch, target, epoch, "user_id", ["ts", "event_id"], "value", F.date_trunc("minute", "ts"))

    _finish(_ticks(spark, sf), step)
    return _alert_view(sinks.read_epochs(spark, f"{target}/alerts"))


@catalog.add("stream_counter", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def _(spark, sf):
    target = _into_epochs(jobs.stream_counter(_events_stream(spark, sf), "user_id"), "update")
    return sinks.read_counters(spark, target, "user_id")


@catalog.add("stream_partition_counter", 'SELECT CAST(user_id % 3 AS INTEGER) AS "partition", count(*) AS n FROM events GROUP BY 1')
def _(spark, sf):
    target = _into_epochs(jobs.stream_counter(_log_stream(spark, sf), "partition"), "update")
    return sinks.read_counters(spark, target, "partition")


@catalog.add("stream_archive", "SELECT user_id, event_type, value FROM events")
def _(spark, sf):
    out = scratch(spark, "archive")
    messages = decode.decode_json(_log_stream(spark, sf).select("value"), "value", MESSAGE_DDL)
    query = sinks.archive(messages, out, scratch(spark, "progress"), trigger=sinks.EVERYTHING_THEN_STOP)
    query.awaitTermination()
    return spark.read.schema(MESSAGE_DDL).json(out)


@catalog.add("archive_idempotent", 'SELECT CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset", user_id, event_type, value FROM events')
def _(spark, sf):
    # Every micro-batch is delivered twice under its own number and once more under another.
    target = scratch(spark, "archive-keyed")

    def deliver(batch, epoch):
        for number in (epoch, epoch, epoch + 1_000_000):
            sinks.archive_idempotent(batch, target, number)

    messages = _log_stream(spark, sf).select("partition", "offset", "value")
    _finish(decode.decode_json(messages, "value", MESSAGE_DDL), deliver)
    return sinks.read_archive(spark, target)


@catalog.add(
    "upsert_latest",
    """SELECT user_id, event_id, event_type, value FROM
       (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def _(spark, sf):
    target = scratch(spark, "latest")

    def deliver(batch, epoch):
        for number in (epoch, epoch, epoch + 1_000_000):
            sinks.upsert_latest(batch, target, number, ["user_id"], ["ts", "event_id"])

    rows = _events_stream(spark, sf).select("user_id", "ts", "event_id", "event_type", "value")
    _finish(rows, deliver)
    return sinks.read_latest(spark, target, ["user_id"], ["ts", "event_id"]).drop("ts")


@catalog.add(
    "reader_lag",
    """WITH e AS (SELECT CAST(user_id % 3 AS INTEGER) AS "partition", max(event_id) + 1 AS end_offset,
         max(CASE WHEN event_type = 'signup' AND user_id % 3 < 2 THEN event_id + 1 END) AS p FROM events GROUP BY 1)
       SELECT "partition", end_offset, coalesce(p, 0) AS "position", end_offset - coalesce(p, 0) AS lag FROM e""",
)
def _(spark, sf):
    # The reader committed up to the last signup of two partitions and never saw the third.
    messages = log.read_log(spark, "parquet", {}, event_log(spark, sf))
    ends = log.replay_count(messages).select("partition", "end_offset")
    seen = decode.decode_json(messages.select("partition", "offset", "value"), "value", MESSAGE_DDL)
    seen = seen.filter("event_type = 'signup' AND partition < 2")
    positions = seen.groupBy("partition").agg((F.max("offset") + 1).alias("position"))
    return jobs.reader_lag(ends, positions)
