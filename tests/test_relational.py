import random

import pytest
from pyspark.sql import functions as F

from lodestar.operators import aggregate as agg
from lodestar.operators import join, ordered, project, window


@pytest.fixture(scope="module")
def skewed(spark):
    """Readings where one key holds most rows and many values repeat."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(20)}"
        day, second = rng.randrange(1, 28), rng.randrange(86400)
        rows.append((i, key, f"2026-08-{day:02d} {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}", float(rng.randrange(1, 120))))
    return spark.createDataFrame(rows, "id int, key string, ts string, value double").withColumn("ts", F.to_timestamp("ts")).cache()


def test_excess_sums_to_filtered_count(skewed):
    counts = agg.excess_count(skewed, "key", "value", 90.0)
    assert counts.agg(F.sum("excess")).first()[0] == skewed.filter("value > 90").count()


def test_sql_and_dataframe_have_one_plan(spark, skewed):
    sql = agg.excess_count_sql(spark, skewed, "key", "value", 90.0)
    assert sql.sameSemantics(agg.excess_count(skewed, "key", "value", 90.0))


def test_first_matching_class_wins(spark):
    df = spark.createDataFrame([(95.0,), (90.0,), (75.0,), (70.0,), (None,)], "v double")
    rows = project.categorize(df, "v", [(90.0, "excess"), (70.0, "fast")], "normal", "c").collect()
    assert [r["c"] for r in rows] == ["excess", "fast", "fast", "normal", "normal"]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(59.95,), (59.96,), (89.95,), (90.0,), (None,)], "v double")
    rows = project.cut(df, "v", [59.95, 69.95, 79.95, 89.95], ["F", "D", "C", "B", "A"], "g").collect()
    assert [r["g"] for r in rows] == ["F", "D", "B", "A", None]
    with pytest.raises(ValueError):
        project.cut(df, "v", [2.0, 1.0], ["a", "b", "c"], "g")


def test_crosstab_margins_total(skewed):
    df = skewed.withColumn("big", F.when(F.col("value") > 60, "y").otherwise("n"))
    rows = {r["key"]: r for r in agg.crosstab(df, "key", "big", ["y", "n"], margins=True).collect()}
    assert rows["Sum"]["Sum"] == 3000
    assert rows["Sum"]["y"] == sum(r["y"] for k, r in rows.items() if k != "Sum")
    assert rows["hot"]["Sum"] == rows["hot"]["y"] + rows["hot"]["n"]


def test_numbers_are_contiguous_in_order(skewed):
    rows = ordered.number_records(skewed, ["value", "id"], "n").collect()
    expected = {r["id"]: i + 1 for i, r in enumerate(sorted(skewed.collect(), key=lambda r: (r["value"], r["id"])))}
    assert {r["id"]: r["n"] for r in rows} == expected


def test_every_kth(skewed):
    want = [r["id"] for r in sorted(skewed.collect(), key=lambda r: (r["ts"], r["id"]))][5:200:3]
    assert sorted(r["id"] for r in ordered.every_kth(skewed, ["ts", "id"], 5, 200, 3).collect()) == sorted(want)


def test_average_ranks(skewed):
    values = sorted(r["value"] for r in skewed.select("value").collect())
    want = {v: sum(i + 1 for i, w in enumerate(values) if w == v) / values.count(v) for v in set(values)}
    assert {r["value"]: r["rank"] for r in window.avg_rank(skewed, "value").collect()} == want


def test_cumulative_and_ecdf(skewed):
    last = window.cumulative(skewed, "value").orderBy(F.desc("value")).first()
    assert last["cum_n"] == 3000 and last["cum_freq"] == 1.0
    steps = [r["f"] for r in window.ecdf(skewed, "value").orderBy("x").collect()]
    assert steps == sorted(steps) and steps[0] == 0.0 and steps[-1] == 1.0


def test_change_alert_equals_loop(skewed):
    want, last = set(), {}
    for r in sorted(skewed.collect(), key=lambda r: (r["ts"], r["id"])):
        before, last[r["key"]] = last.get(r["key"]), r["value"]
        if before is not None and abs((r["value"] - before) / before * 100) >= 5:
            want.add((r["id"], before, "up" if r["value"] > before else "down"))
    for bucket in (F.to_date("ts"), F.date_trunc("hour", "ts"), F.lit(0)):
        rows = window.change_alert(skewed, "key", ["ts", "id"], "value", bucket, 5).collect()
        assert {(r["id"], r["previous"], r["direction"]) for r in rows} == want


def test_alert_threshold_can_be_strict(spark):
    df = spark.createDataFrame([("a", 1, 100.0), ("a", 2, 105.0)], "k string, t int, v double")
    assert window.change_alert(df, "k", ["t"], "v", F.lit(0), 5.0).count() == 1
    assert window.change_alert(df, "k", ["t"], "v", F.lit(0), 5.0, strict=True).count() == 0


def test_null_previous_is_kept_as_null(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5.0), ("a", 3, 6.0)], "k string, t int, v double")
    for bucket in (F.lit(0), F.col("t")):
        rows = window.previous_value(df, "k", ["t"], "v", bucket).orderBy("t").collect()
        assert [r["previous"] for r in rows] == [None, None, 5.0]


def test_previous_value_after_a_null_time(spark):
    """A row without a time comes first, whatever the buckets are."""
    df = spark.createDataFrame([("a", None, 10.0), ("a", 0, 20.0), ("a", 5, 30.0), (None, 1, 1.0), (None, 9, 2.0)], "k string, t int, v double")
    for bucket in (F.lit(0), F.col("t"), (F.col("t") / 3).cast("int")):
        rows = window.previous_value(df, "k", ["t"], "v", bucket).collect()
        assert {(r["k"], r["t"]): r["previous"] for r in rows} == {("a", None): None, ("a", 0): 10.0, ("a", 5): 20.0, (None, 1): None, (None, 9): 1.0}


def test_large_top_k(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), "id")
    rows = window.topk_per_key(df, "k", [F.desc("id")], 1500).collect()
    assert {(r["k"], r["place"], r["id"]) for r in rows} == {(i % 2, (4999 - i) // 2 + 1, i) for i in range(2000, 5000)}


def test_no_alert_from_zero(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 5.0), ("a", 3, 6.0)], "k string, t int, v double")
    assert [r["t"] for r in window.change_alert(df, "k", ["t"], "v", F.lit(0)).collect()] == [3]


def test_latest_and_topk(skewed):
    rows = skewed.collect()
    latest = {r["key"]: r["id"] for r in window.latest_per_key(skewed, "key", ["ts", "id"]).collect()}
    assert latest == {k: max((r for r in rows if r["key"] == k), key=lambda r: (r["ts"], r["id"]))["id"] for k in latest}
    top = window.topk_per_key(skewed, "key", [F.desc("value"), "id"], 3).filter("key = 'hot'").orderBy("place").collect()
    hot = sorted((r for r in rows if r["key"] == "hot"), key=lambda r: (-r["value"], r["id"]))[:3]
    assert [r["id"] for r in top] == [r["id"] for r in hot]


def test_percentage_ignores_null_flags(spark):
    df = spark.createDataFrame([("a", True), ("a", None), ("a", False), ("a", True)], "k string, f boolean")
    row = agg.pct_flag(df, "k", F.col("f")).first()
    assert (row["messages"], row["pct"]) == (4, 67)


def test_edges_and_keys(spark):
    vertices = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    edges = spark.createDataFrame([(1, 2), (2, 9), (8, 3), (8, 9)], "src int, dst int")
    assert [tuple(r) for r in join.resolve_edges(edges, vertices, "src", "dst", "id").collect()] == [(1, 2)]
    bad = {(r["src"], r["dst"]): (r["missing_src"], r["missing_dst"]) for r in join.dangling_edges(edges, vertices, "src", "dst", "id").collect()}
    assert bad == {(2, 9): (False, True), (8, 3): (True, False), (8, 9): (True, True)}
    assert join.duplicate_keys(edges, ["dst"]).collect()[0]["copies"] == 2


def test_overlapping_ranges_are_flagged(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 5), ("b", 9), ("c", 10)], "g string, v int")
    rows = {r["g"]: r["overlaps_next"] for r in agg.functional_ranges(df, "g", "v").collect()}
    assert rows == {"a": True, "b": False, "c": False}


def test_nested_documents_are_sorted(spark):
    df = spark.createDataFrame([("x", 2, 1.1), ("x", 1, 2.2), ("x", 2, 0.1), ("y", 3, 1.0)], "o string, i int, a double")
    rows = {r["o"]: r for r in agg.nested_revenue(agg.totals(df, ["o", "i"], "a"), "o", "i").collect()}
    assert [(p["i"], p["sales"], p["revenue"]) for p in rows["x"]["parts"]] == [(1, 1, 2.2), (2, 2, 1.2)]
    assert rows["x"]["revenue"] == 3.4
