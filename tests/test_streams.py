import random

import pytest
from pyspark.sql import functions as F

from lodestar.catalog import streams
from lodestar.operators import window
from lodestar.session import scratch
from lodestar.sources import documents, files, jdbc, log
from lodestar.streaming import decode, jobs, sinks

DDL = "k string, t int, v double"
ONE_FILE = {"maxFilesPerTrigger": "1"}


def _deliver(spark, path, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)


def _run(df, sink, checkpoint, mode="append", options=None):
    query = sinks.start_query(df, sink, checkpoint, mode, sinks.EVERYTHING_THEN_STOP, options)
    query.awaitTermination()


def _open(spark, path):
    return spark.readStream.schema(DDL).options(**ONE_FILE).parquet(path)


FIRST = [("a", 1, 100.0), ("b", 2, 10.0), ("a", 3, 101.0)]
SECOND = [("a", 4, 101.0), ("b", 5, 12.0), ("c", 6, 1.0)]
THIRD = [("b", 7, 11.0), ("c", 8, 1.0), ("a", 9, 90.0)]


def test_resume_reads_only_new_files(spark):
    source, progress, out = (scratch(spark, n) for n in ("source", "progress", "out"))
    _deliver(spark, source, FIRST)
    _run(_open(spark, source), "parquet", progress, options={"path": out})
    assert spark.read.parquet(out).count() == 3
    _deliver(spark, source, SECOND)
    _run(_open(spark, source), "parquet", progress, options={"path": out})
    assert spark.read.parquet(out).count() == 6
    other = scratch(spark, "out")
    _run(_open(spark, source), "parquet", scratch(spark, "progress"), options={"path": other})
    assert spark.read.parquet(other).count() == 6


def _expected_alerts(spark):
    batch = spark.createDataFrame(FIRST + SECOND + THIRD, DDL)
    rows = window.change_alert(batch, "k", ["t"], "v", F.lit(0), 0.5).collect()
    return {(r["k"], r["t"], r["previous"], r["direction"]) for r in rows}


def test_state_survives_a_restart(spark):
    source, progress, out = (scratch(spark, n) for n in ("source", "progress", "out"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKSDB)
    try:
        for rows in (FIRST, SECOND, THIRD):
            _deliver(spark, source, rows)
            alerts = jobs.stream_change_alert(_open(spark, source), "k", ["t"], "v", 0.5)
            _run(alerts, "parquet", progress, options={"path": out})
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = {(r["k"], r["t"], r["previous"], r["direction"]) for r in spark.read.parquet(out).collect()}
    assert got == _expected_alerts(spark)


def test_alerts_of_a_hot_key_over_buckets_and_batches(spark):
    """Buckets of a key are judged apart and joined by their ends, within a micro-batch and across them."""
    rng = random.Random(4)
    rows = [(rng.choice("aaaab"), t, float(rng.choice([0, 1, 2, 100, 101]))) for t in range(300)]
    source, out = scratch(spark, "source"), scratch(spark, "out")
    for start in range(0, 300, 70):
        _deliver(spark, source, rng.sample(rows[start : start + 70], len(rows[start : start + 70])))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKSDB)
    try:
        alerts = jobs.stream_change_alert(_open(spark, source), "k", ["t"], "v", 0.5, bucket=F.floor(F.col("t") / 9))
        _run(alerts, "parquet", scratch(spark, "progress"), options={"path": out})
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    want = window.change_alert(spark.createDataFrame(rows, DDL), "k", ["t"], "v", F.lit(0), 0.5)
    columns = ["k", "t", "v", "previous", "direction"]
    assert sorted(map(tuple, spark.read.parquet(out).select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_table_alerts_survive_replay(spark):
    target = scratch(spark, "alerts")
    for epoch, rows in enumerate((FIRST, SECOND, THIRD)):
        batch = spark.createDataFrame(rows, DDL)
        for _ in range(2):
            sinks.alert_batch(batch, target, epoch, "k", ["t"], "v", F.lit(0), 0.5)
    got = {(r["k"], r["t"], r["previous"], r["direction"]) for r in sinks.read_epochs(spark, f"{target}/alerts").collect()}
    assert got == _expected_alerts(spark)


def test_counters_and_complete_tables_over_batches(spark):
    source = scratch(spark, "source")
    for rows in (FIRST, SECOND, THIRD):
        _deliver(spark, source, rows)
    running, whole = scratch(spark, "running"), scratch(spark, "whole")
    counter = jobs.stream_counter(_open(spark, source), "k")
    _run(counter, lambda b, e: sinks.write_epoch(b, running, e), scratch(spark, "progress"), "update")
    assert {r["k"]: r["n"] for r in sinks.read_counters(spark, running, "k").collect()} == {"a": 4, "b": 3, "c": 2}
    counts = jobs.stream_counts(_open(spark, source), "k", F.col("v") > 50)
    _run(counts, lambda b, e: sinks.write_epoch(b, whole, e), scratch(spark, "progress"), "complete")
    batch = jobs.stream_counts(spark.read.parquet(source), "k", F.col("v") > 50)
    assert sorted(map(tuple, sinks.last_epoch(spark, whole).collect())) == sorted(map(tuple, batch.collect()))


def test_upsert_and_compaction(spark):
    target, folded = scratch(spark, "latest"), scratch(spark, "folded")
    for epoch, rows in enumerate((THIRD, FIRST, SECOND, FIRST)):
        sinks.upsert_latest(spark.createDataFrame(rows, DDL), target, epoch, ["k"], ["t"])
    want = {("a", 9, 90.0), ("b", 7, 11.0), ("c", 8, 1.0)}
    assert {tuple(r) for r in sinks.read_latest(spark, target, ["k"], ["t"]).collect()} == want
    sinks.compact(spark, target, folded, ["k"], ["t"])
    assert {tuple(r) for r in sinks.read_latest(spark, folded, ["k"], ["t"]).collect()} == want
    assert sinks.read_epochs(spark, folded).count() == 3


def test_archive_by_position(spark):
    target = scratch(spark, "archive")
    batch = spark.createDataFrame([(0, 1, "x"), (0, 2, "y"), (1, 1, "z")], "partition int, offset long, m string")
    for epoch in (0, 0, 1, 7):
        sinks.archive_idempotent(batch, target, epoch)
    assert sinks.read_archive(spark, target).count() == 3


def test_decode_policies(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "f": null}'), (2, "{broken"), (3, '{"b": 2}')], "i int, j string")
    kept = decode.decode_json(df, "j", "a INT, f BOOLEAN").orderBy("i").collect()
    assert [(r["i"], r["a"]) for r in kept] == [(1, 1), (2, None), (3, None)]
    dropped = decode.decode_json(df, "j", "a INT, f BOOLEAN", drop_malformed=True)
    assert {r["i"] for r in dropped.collect()} >= {1} and 2 not in {r["i"] for r in dropped.collect()}


def test_event_lines(spark):
    lines = ["event: message", ":ok", 'data: {"wiki": "fr", "title": "é"}', "", 'data: {"title": "no key"}', "data: {broken", "id: 3"]
    df = spark.createDataFrame([(v,) for v in lines], "line string")
    rows = decode.decode_event_lines(df, "line", "wiki STRING, title STRING, bot BOOLEAN", "wiki").collect()
    assert [tuple(r) for r in rows] == [("fr", "é", None)]


def test_log_value_keeps_letters(spark):
    df = spark.createDataFrame([("fr", "été", None)], "wiki string, title string, bot boolean")
    row = log.encode_log(df, "wiki", ["wiki", "title"]).first()
    assert (row["key"], row["value"]) == ("fr", '{"wiki":"fr","title":"été"}')


def _lines(spark, lines):
    path = scratch(spark, "lines")
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    return path


BAD = ["truck,speed", "a,1.5", "", "b", "c,fast", "truck,speed", "d,2.5,extra"]


def test_malformed_policies(spark):
    path = _lines(spark, BAD)
    read = lambda policy: files.read_text_records(spark, path, "truck STRING, speed DOUBLE", header_prefix="truck", malformed=policy)
    assert {tuple(r) for r in read("drop").collect()} == {("a", 1.5), ("d", 2.5)}
    assert {r["_corrupt_record"] for r in read("null").collect()} == {None, "b", "c,fast"}
    with pytest.raises(Exception, match="malformed field"):
        read("fail").collect()
    with pytest.raises(ValueError):
        read("ignore")


def test_csv_policies(spark):
    path = _lines(spark, ["a,1.5", "b,x"])
    read = lambda policy: files.read_csv(spark, path, "t STRING, s DOUBLE", header=False, malformed=policy)
    assert read("drop").collect() == [("a", 1.5)]
    assert {tuple(r) for r in read("null").collect()} == {("a", 1.5), ("b", None)}
    with pytest.raises(Exception):
        read("fail").collect()


def test_inference_is_an_option(spark):
    path = _lines(spark, ["n,v", "1,2.5"])
    assert [t for _, t in files.read_csv(spark, path).dtypes] == ["int", "double"]


def test_text_pairs_refuse_an_existing_directory(spark):
    path = scratch(spark, "pairs")
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    files.write_text_pairs(df, path, "k", "n")
    assert spark.read.text(path).first()["value"] == "a\t1"
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_text_pairs(df, path, "k", "n")


def test_jdbc_options():
    conn = {"url": "jdbc:postgresql://host/db", "driver": "org.postgresql.Driver", "user": "u", "password": "p"}
    options = jdbc.jdbc_options(conn, "sales", jdbc.Slices("id", "1", "1000", 8))
    assert options["dbtable"] == "sales" and options["numPartitions"] == "8" and options["partitionColumn"] == "id"
    assert jdbc.jdbc_options({**conn, "fetchsize": "5"}, "t")["fetchsize"] == "5"
    with pytest.raises(ValueError):
        jdbc.jdbc_options({}, "t")


def test_document_ids(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    twice = [sorted(r["_id"] for r in documents.with_document_id(df, ["i", "s"]).collect()) for _ in range(2)]
    assert twice[0] == twice[1] and len(set(twice[0])) == 2


def test_malformed_documents_only_are_dropped(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{}",), ('{"b":2}',), ('{"a":null}',), ('{"a":',), (None,)], "t string")
    assert sorted(str(r["a"]) for r in decode.decode_json(df, "t", "a int", drop_malformed=True).collect()) == ["1", "None", "None", "None"]
    assert decode.decode_json(df, "t", "a int").count() == 6


def test_lag_of_an_unread_partition(spark):
    ends = spark.createDataFrame([(0, 10), (1, 4)], "partition int, end_offset long")
    done = spark.createDataFrame([(0, 7)], "partition int, position long")
    assert {r["partition"]: r["lag"] for r in jobs.reader_lag(ends, done).collect()} == {0: 3, 1: 4}


def test_many_keys_are_judged_by_the_shelf(spark):
    """3000 keys of few rows, one of them missing: state has a piece per shelf, alerts are those of the table."""
    rng = random.Random(6)
    rows = [(rng.choice([None, *(f"k{i}" for i in range(3000))]), t, rng.choice([0.0, 1.0, 2.0, 100.0])) for t in range(9000)]
    source, out = scratch(spark, "source"), scratch(spark, "out")
    for start in range(0, 9000, 3000):
        _deliver(spark, source, rng.sample(rows[start : start + 3000], 3000))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKSDB)
    try:
        alerts = jobs.stream_change_alert(_open(spark, source), "k", ["t"], "v", 0.5, bucket=F.floor(F.col("t") / 500))
        query = sinks.start_query(alerts, "parquet", scratch(spark, "progress"), trigger=sinks.EVERYTHING_THEN_STOP, options={"path": out})
        query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    state = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    assert 0 < state <= jobs.SHELVES + 1
    want = window.change_alert(spark.createDataFrame(rows, DDL), "k", ["t"], "v", F.lit(0), 0.5)
    columns = ["k", "t", "v", "previous", "direction"]
    assert sorted(map(str, spark.read.parquet(out).select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))


def test_a_delivery_of_several_files_is_one_micro_batch(spark, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 8, raising=False)
    rng = random.Random(2)
    rows = spark.createDataFrame([(rng.choice("ab"), t if t < 150 else 150, rng.random()) for t in range(200)], "k string, t int, v double")
    path = streams._delivered(spark, rows.repartition(6), by="t")
    seen, gone = [], []

    def look(batch, epoch):
        found = batch.select("t").collect()
        if found:
            seen.append((min(r["t"] for r in found), max(r["t"] for r in found)))
            gone.append(len(found))

    query = sinks.start_query(streams._arriving(spark, path, rows.schema), look, scratch(spark, "progress"), trigger=sinks.EVERYTHING_THEN_STOP)
    query.awaitTermination()
    assert sum(gone) == 200 and 1 < len(seen) <= 4
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))  # no delivery lies in two micro-batches
