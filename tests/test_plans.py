"""The physical plans the library relies on."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lodestar.operators import aggregate as agg
from lodestar.operators import ordered, window
from lodestar.plans import inspect, tables
from lodestar.session import scratch

SF = "/root/testdata/sf0.001"


def _events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


def test_filter_reaches_the_scan_and_counts_combine_early(spark):
    plan = agg.excess_count(_events(spark), "user_id", "value", 90.0)
    text = inspect.plan_text(plan)
    assert any("GreaterThan(value,90.0)" in f for f in inspect.pushed_filters(plan))
    assert "partial_count" in text and "ReadSchema: struct<user_id:bigint,value:double>" in text


def test_topk_limits_before_the_shuffle(spark):
    plan = inspect.plan_text(window.topk_per_key(_events(spark).select("user_id", "event_id", "value"), "user_id", [F.desc("value"), "event_id"], 5))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert "TakeOrderedAndProject" in inspect.plan_text(window.top_n(_events(spark), ["value", "event_id"], 5))


def test_latest_needs_no_full_row_shuffle(spark):
    plan = inspect.plan_text(window.latest_per_key(_events(spark), "user_id", ["ts", "event_id"]))
    assert "partial_max_by" in plan and "Window" not in plan


def test_no_window_without_partition_over_rows(spark):
    """Global order work never plans a window over all rows in one task."""
    for df in (
        ordered.number_records(_events(spark), ["value", "event_id"]),
        window.cumulative(_events(spark), "value"),
    ):
        for line in inspect.plan_text(df).splitlines():
            if "Window [" in line and "windowspecdefinition(_s" not in line:
                assert "_t#" in line  # the window over one total per slice


def test_partition_pruning_and_full_scan_warning(spark):
    path = scratch(spark, "by-type")
    tables.write_query_table(_events(spark), path, ["event_type"], [F.desc("value"), "event_id"])
    table = spark.read.parquet(path)
    assert inspect.scan_warning(table.filter("value > 90")) is not None
    pruned = table.filter("event_type = 'error' AND value > 90")
    assert inspect.scan_warning(pruned) is None
    assert table.count() == _events(spark).count()


def test_partitions_a_question_reads(spark):
    path = scratch(spark, "guarded")
    rows = [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0), (None, 1, 4.0)]
    spark.createDataFrame(rows, "kind string, day int, v double").write.partitionBy("kind", "day").parquet(path)
    stored = spark.read.parquet(path)
    asked = {
        "one": ["kind = 'a'", "day = 1", "v > 0"],
        "kind": [F.col("kind") == "a"],
        "day": ["day = 1"],
        "other": ["v > 2"],
        "mixed": ["kind = 'a' OR v > 2"],
        "none": [],
        "no such": ["kind = 'z'"],
    }
    found = {r["question"]: (r["n_read"], r["n_all"], r["full_scan"]) for r in inspect.partitions_read(stored, ["kind", "day"], asked).collect()}
    assert found == {
        "one": (1, 4, False), "kind": (2, 4, False), "day": (3, 4, False), "other": (4, 4, True),
        "mixed": (4, 4, True), "none": (4, 4, True), "no such": (0, 4, False),
    }
    for name, conditions in asked.items():  # the scan itself agrees
        kept = stored
        for c in conditions:
            kept = kept.filter(c)
        assert (inspect.scan_warning(kept) is None) == any("kind" in str(c) and "OR" not in str(c) or "day" in str(c) for c in conditions)
    empty = stored.filter("false")
    assert inspect.partitions_read(empty, ["kind", "day"], {"all": []}).first()["full_scan"] is False
    with pytest.raises(AnalysisException):
        inspect.partitions_read(stored, ["kind", "day"], {"typo": ["knd = 'a'"]})
    with pytest.raises(ValueError):
        inspect.partitions_read(stored, ["kind", "day"], {})


def test_month_directories_prune(spark):
    path = scratch(spark, "monthly")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    tables.monthly_partition(orders, "o_orderdate", "o_custkey", path)
    wanted = spark.read.parquet(path).filter("month = '1997-08' AND o_custkey = 7")
    assert inspect.scan_warning(wanted) is None
    assert any("EqualTo(o_custkey,7)" in f for f in inspect.pushed_filters(wanted))


def test_bucketed_table_joins_without_a_shuffle(spark):
    name = "bucketed_orders_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey", "o_orderkey")
    tables.write_query_table(orders, name, ["o_custkey"], ["o_custkey", "o_orderkey"], buckets=4)
    counts = spark.table(name).groupBy("o_custkey").count()
    assert "Exchange" not in inspect.plan_text(counts)
    spark.sql(f"DROP TABLE {name}")
