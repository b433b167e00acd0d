"""Projections, filters, joins, aggregates and per-key rankings on the given tables.

``events`` plays the speed readings (limit 90), ``customer`` the trucks and stores, its market
segment the depot, ``orders`` the sales.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.catalog import Catalog, table
from lodestar.functions.columns import money
from lodestar.operators import aggregate as agg
from lodestar.operators import join, ordered, project, window

catalog = Catalog()
LIMIT = 90.0
SPEED_CLASSES = [(90.0, "excess"), (70.0, "fast")]
PRICE_BOUNDS = [100000.0, 200000.0, 300000.0, 400000.0]
PRICE_LABELS = ["E", "D", "C", "B", "A"]
_PRICE_CASE = (
    "CASE WHEN {c} <= 100000 THEN 'E' WHEN {c} <= 200000 THEN 'D' WHEN {c} <= 300000 THEN 'C' "
    "WHEN {c} <= 400000 THEN 'B' ELSE 'A' END"
)


def _price_bins(spark, sf):
    return project.cut(table(spark, sf, "orders"), "o_totalprice", PRICE_BOUNDS, PRICE_LABELS, "grade")


# --- projections and predicates -------------------------------------------------------------


@catalog.add("project_cols", "SELECT user_id, value FROM events")
def _(spark, sf):
    return project.project(table(spark, sf, "events"), ["user_id", "value"])


@catalog.add("rename_cols", "SELECT c_custkey AS truck, c_mktsegment AS depot FROM customer")
def _(spark, sf):
    cols = project.project(table(spark, sf, "customer"), ["c_custkey", "c_mktsegment"])
    return project.rename(cols, {"c_custkey": "truck", "c_mktsegment": "depot"})


@catalog.add("derived_flag", "SELECT event_id, value, value > 90 AS over, CAST(user_id AS INTEGER) AS truck FROM events")
def _(spark, sf):
    cols = project.project(table(spark, sf, "events"), ["event_id", "user_id", "value"])
    return project.derive(cols, over=F.col("value") > LIMIT, truck=F.col("user_id").cast("int")).drop("user_id")


@catalog.add(
    "speed_category",
    "SELECT event_id, value, CASE WHEN value > 90 THEN 'excess' WHEN value > 70 THEN 'fast' ELSE 'normal' END AS category FROM events",
)
def _(spark, sf):
    cols = project.project(table(spark, sf, "events"), ["event_id", "value"])
    return project.categorize(cols, "value", SPEED_CLASSES, "normal", "category")


@catalog.add("over_threshold", "SELECT event_id, user_id, value FROM events WHERE value > 90")
def _(spark, sf):
    return project.threshold_filter(table(spark, sf, "events"), "value", LIMIT).select("event_id", "user_id", "value")


@catalog.add("filter_and", "SELECT c_custkey FROM customer WHERE c_acctbal < 5000 AND c_nationkey > 10")
def _(spark, sf):
    kept = project.filter_all(table(spark, sf, "customer"), F.col("c_acctbal") < 5000, F.col("c_nationkey") > 10)
    return kept.select("c_custkey")


@catalog.add("filter_eq", "SELECT event_id, user_id FROM events WHERE event_type = 'error'")
def _(spark, sf):
    return project.filter_eq(table(spark, sf, "events"), "event_type", "error").select("event_id", "user_id")


@catalog.add("filter_in", "SELECT * FROM customer WHERE c_custkey IN (1, 12, 25)")
def _(spark, sf):
    return project.filter_in(table(spark, sf, "customer"), "c_custkey", [1, 12, 25])


@catalog.add("filter_between", "SELECT event_id, value FROM events WHERE event_id BETWEEN 100 AND 200")
def _(spark, sf):
    return project.filter_between(table(spark, sf, "events"), "event_id", 100, 200).select("event_id", "value")


@catalog.add("lookup_id", "SELECT event_id, user_id, event_type, value FROM events WHERE event_id = 42")
def _(spark, sf):
    return project.lookup(table(spark, sf, "events"), "event_id", 42).select("event_id", "user_id", "event_type", "value")


def _documents(spark, sf):
    """One document per market segment with the totals of its nations."""
    sums = project.rename(agg.totals(table(spark, sf, "orders"), "o_custkey", "o_totalprice"), {"o_custkey": "c_custkey"})
    joined = join.enrich(sums, table(spark, sf, "customer"), "c_custkey")
    return agg.nested_revenue(joined, "c_mktsegment", "c_nationkey")


@catalog.add(
    "nested_find",
    """SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS sales FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE c_mktsegment IN (SELECT c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 7)
       GROUP BY c_mktsegment""",
)
def _(spark, sf):
    return project.nested_find(_documents(spark, sf), "parts", "c_nationkey", 7, ["c_mktsegment", "sales"])


@catalog.add(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({e}) AS BIGINT) AS nulls FROM orders"
        for c, e in [
            ("o_orderkey", "o_orderkey"),
            ("o_custkey", "o_custkey"),
            ("o_orderstatus", "nullif(o_orderstatus, 'P')"),
            ("o_totalprice", "o_totalprice"),
            ("o_orderdate", "o_orderdate"),
            ("o_orderpriority", "nullif(o_orderpriority, '5-LOW')"),
        ]
    ),
)
def _(spark, sf):
    holes = table(spark, sf, "orders").withColumns(
        {
            "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
            "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW")),
        }
    )
    return project.null_counts(holes)


@catalog.add(
    "fill_missing",
    "SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'unknown') AS o_orderpriority FROM orders",
)
def _(spark, sf):
    holes = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority")
    )
    return project.fill_category(holes, "o_orderpriority", "unknown")


@catalog.add(
    "every_kth",
    """SELECT o_orderkey, o_totalprice FROM
       (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS i FROM orders)
       WHERE i >= 10 AND i < 5000 AND (i - 10) % 7 = 0""",
)
def _(spark, sf):
    cols = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordered.every_kth(cols, ["o_totalprice", "o_orderkey"], 10, 5000, 7)


@catalog.add("grade_bins", f"SELECT o_orderkey, o_totalprice, {_PRICE_CASE.format(c='o_totalprice')} AS grade FROM orders")
def _(spark, sf):
    return _price_bins(spark, sf).select("o_orderkey", "o_totalprice", "grade")


# --- joins ----------------------------------------------------------------------------------


def _excess(spark, sf):
    return agg.excess_count(table(spark, sf, "events"), "user_id", "value", LIMIT)


@catalog.add(
    "excess_by_driver",
    """SELECT c_custkey, c_name, c_mktsegment, excess FROM
       (SELECT user_id AS c_custkey, count(*) AS excess FROM events WHERE value > 90 GROUP BY user_id)
       JOIN customer USING (c_custkey)""",
)
def _(spark, sf):
    counts = project.rename(_excess(spark, sf), {"user_id": "c_custkey"})
    drivers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return join.enrich(counts, drivers, "c_custkey").orderBy(F.desc("excess"), "c_custkey")


@catalog.add(
    "revenue_sql",
    """SELECT n_name, count(*) AS sales, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def _(spark, sf):
    return spark.sql(
        """SELECT n_name, count(*) AS sales, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
           FROM (SELECT o_custkey AS custkey, o_totalprice FROM {orders})
           JOIN (SELECT c_custkey AS custkey, c_nationkey AS nationkey FROM {customer}) USING (custkey)
           JOIN (SELECT n_nationkey AS nationkey, n_name FROM {nation}) USING (nationkey)
           GROUP BY n_name ORDER BY revenue DESC, n_name""",
        orders=table(spark, sf, "orders"),
        customer=table(spark, sf, "customer"),
        nation=table(spark, sf, "nation"),
    )


@catalog.add(
    "excess_by_depot",
    """SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS excess FROM events JOIN customer ON user_id = c_custkey
       WHERE value > 90 GROUP BY c_mktsegment""",
)
def _(spark, sf):
    counts = project.rename(_excess(spark, sf), {"user_id": "c_custkey"})
    enriched = join.enrich(counts, table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    return agg.rollup_sum(enriched, "c_mktsegment", "excess").orderBy(F.desc("excess"))


def _vertex(kind, key):
    return F.struct(F.lit(kind).alias("kind"), F.col(key).alias("key"))


@catalog.add(
    "resolve_edges",
    """SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
         AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10)""",
)
def _(spark, sf):
    # Vertices are the settled orders and the larger parts, so some lines miss an end.
    orders = table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(_vertex("order", "o_orderkey").alias("id"))
    parts = table(spark, sf, "part").filter("p_size > 10").select(_vertex("part", "p_partkey").alias("id"))
    edges = table(spark, sf, "lineitem").select(
        _vertex("order", "l_orderkey").alias("src"), _vertex("part", "l_partkey").alias("dst"), "l_linenumber"
    )
    kept = join.resolve_edges(edges, orders.unionByName(parts), "src", "dst", "id")
    return kept.select(F.col("src.key").alias("l_orderkey"), F.col("dst.key").alias("l_partkey"), "l_linenumber")


@catalog.add(
    "dangling_edges",
    """SELECT user_id AS src, l AS dst, event_id, u IS NULL AS missing_src, v IS NULL AS missing_dst FROM
       (SELECT event_id, user_id, CAST(props->>'$.k' AS BIGINT) AS l FROM events)
       LEFT JOIN (SELECT c_custkey AS u FROM customer WHERE c_nationkey <> 3) ON user_id = u
       LEFT JOIN (SELECT c_custkey AS v FROM customer WHERE c_nationkey <> 3) ON l = v
       WHERE u IS NULL OR v IS NULL""",
)
def _(spark, sf):
    # Links user -> props.k; vertices are the customers outside one nation.
    links = table(spark, sf, "events").select(
        F.col("user_id").alias("src"), F.get_json_object("props", "$.k").cast("long").alias("dst"), "event_id"
    )
    known = table(spark, sf, "customer").filter("c_nationkey <> 3").select(F.col("c_custkey").alias("id"))
    return join.dangling_edges(links, known, "src", "dst", "id")


@catalog.add(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, sf):
    return join.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- aggregates -----------------------------------------------------------------------------

_EXCESS_SQL = "SELECT user_id, count(*) AS excess FROM events WHERE value > 90 GROUP BY user_id"


@catalog.add("excess_count", _EXCESS_SQL)
def excess_count(spark, sf):
    return _excess(spark, sf)


@catalog.add("excess_count_sql", _EXCESS_SQL)
def _(spark, sf):
    return agg.excess_count_sql(spark, table(spark, sf, "events"), "user_id", "value", LIMIT)


_COUNTED = ["customer", "orders", "lineitem", "events"]


@catalog.add("row_counts", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in _COUNTED))
def _(spark, sf):
    return agg.row_counts(**{t: table(spark, sf, t) for t in _COUNTED})


@catalog.add("distinct_users", "SELECT count(DISTINCT user_id) AS n FROM events")
def _(spark, sf):
    return agg.distinct_count(table(spark, sf, "events"), "user_id")


@catalog.add(
    "mean_by_key",
    """SELECT event_type, CAST(round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,8)) / count(*), 2) AS DOUBLE) AS mean_value,
       CAST(round(CAST(sum(CAST(props->>'$.k' AS INTEGER)) AS DECIMAL(38,8)) / count(*), 2) AS DOUBLE) AS mean_k
       FROM events GROUP BY event_type""",
)
def _(spark, sf):
    k = F.get_json_object("props", "$.k").cast("decimal(18,2)")
    return agg.mean_by_key(table(spark, sf, "events"), "event_type", {"mean_value": money(F.col("value")), "mean_k": k}, 2)


@catalog.add(
    "revenue_by_nation",
    """SELECT n_name, count(*) AS sales, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def _(spark, sf):
    sums = project.rename(agg.totals(table(spark, sf, "orders"), "o_custkey", "o_totalprice"), {"o_custkey": "c_custkey"})
    stores = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    joined = join.enrich(join.enrich(sums, stores, "c_custkey"), table(spark, sf, "nation"), "n_nationkey")
    return agg.revenue_by(joined, "n_name")


@catalog.add(
    "nested_revenue",
    """WITH small AS (SELECT c_mktsegment, c_nationkey, count(*) AS sales, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
       SELECT c_mktsegment, CAST(sum(sales) AS BIGINT) AS sales, CAST(sum(revenue) AS DOUBLE) AS revenue,
         string_agg(c_nationkey || ':' || sales || ':' || CAST(revenue AS VARCHAR), ',' ORDER BY c_nationkey) AS parts
       FROM small GROUP BY c_mktsegment""",
)
def _(spark, sf):
    entry = lambda p: F.concat_ws(":", p["c_nationkey"], p["sales"], p["revenue"].cast("decimal(28,2)"))
    return _documents(spark, sf).withColumn("parts", F.concat_ws(",", F.transform("parts", entry)))


@catalog.add("max_having", "SELECT user_id, max(value) AS largest FROM events GROUP BY user_id HAVING max(value) > 90")
def _(spark, sf):
    return agg.max_having(table(spark, sf, "events"), "user_id", "value", LIMIT)


@catalog.add(
    "functional_ranges",
    f"""WITH g AS (SELECT {_PRICE_CASE.format(c='o_totalprice')} AS grade, o_totalprice AS v FROM orders),
        r AS (SELECT grade, min(v) AS low, max(v) AS high, count(*) AS n FROM g GROUP BY grade)
        SELECT *, coalesce(lead(low) OVER (ORDER BY low, high, grade) <= high, false) AS overlaps_next FROM r""",
)
def _(spark, sf):
    return agg.functional_ranges(_price_bins(spark, sf), "grade", "o_totalprice")


@catalog.add("distinct_keys", "SELECT DISTINCT user_id FROM events")
def _(spark, sf):
    return agg.distinct_keys(table(spark, sf, "events"), "user_id")


@catalog.add("counter_per_key", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def _(spark, sf):
    return agg.counter(table(spark, sf, "events"), "user_id")


@catalog.add(
    "pct_flag",
    """SELECT user_id, count(*) AS messages,
       CAST(round(CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100) AS INTEGER) AS pct
       FROM events GROUP BY user_id""",
)
def _(spark, sf):
    return agg.pct_flag(table(spark, sf, "events"), "user_id", F.col("event_type") == "error")


@catalog.add("top_groups", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10")
def _(spark, sf):
    return agg.top_groups(table(spark, sf, "events"), "user_id", 10)


_LINE_STATUS = ["F", "O"]


@catalog.add(
    "crosstab",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS "F", count(*) FILTER (l_linestatus = 'O') AS "O"
       FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, sf):
    return agg.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", _LINE_STATUS)


@catalog.add(
    "crosstab_margins",
    """SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'Sum' ELSE l_returnflag END AS l_returnflag,
       count(*) FILTER (l_linestatus = 'F') AS "F", count(*) FILTER (l_linestatus = 'O') AS "O", count(*) AS "Sum"
       FROM lineitem GROUP BY CUBE (l_returnflag)""",
)
def _(spark, sf):
    return agg.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", _LINE_STATUS, margins=True)


@catalog.add(
    "conditional_freq",
    """WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL),
       m AS (SELECT *, CAST(sum(n) OVER (PARTITION BY l_returnflag) AS BIGINT) AS n_a,
         CAST(sum(n) OVER (PARTITION BY l_linestatus) AS BIGINT) AS n_b, sum(n) OVER () AS t FROM c)
       SELECT l_returnflag, l_linestatus, n, n_a, n_b, round(CAST(n AS DOUBLE) / t, 6) AS joint,
         round(CAST(n AS DOUBLE) / n_a, 6) AS b_given_a, round(CAST(n AS DOUBLE) / n_b, 6) AS a_given_b FROM m""",
)
def _(spark, sf):
    table_ = agg.frequencies(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return table_.withColumns({c: F.round(c, 6) for c in ("joint", "b_given_a", "a_given_b")})


@catalog.add(
    "off_by_one",
    f"""WITH g AS (SELECT {_PRICE_CASE.format(c='o_totalprice')} AS t, {_PRICE_CASE.format(c='o_totalprice * 1.25')} AS p FROM orders),
        i AS (SELECT t, p, list_position(['E','D','C','B','A'], t) AS a, list_position(['E','D','C','B','A'], p) AS b FROM g)
        SELECT count(*) AS n, round(avg(CASE WHEN t = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
          round(avg(CASE WHEN abs(a - b) <= 1 THEN 1.0 ELSE 0.0 END), 6) AS within_one FROM i""",
)
def _(spark, sf):
    # The "prediction" is a price that is a quarter too high, put through the same bins.
    high = _price_bins(spark, sf).withColumn("_p", F.col("o_totalprice") * 1.25)
    both = project.cut(high, "_p", PRICE_BOUNDS, PRICE_LABELS, "guess")
    result = agg.accuracy(both, "grade", "guess", PRICE_LABELS)
    return result.withColumns({c: F.round(c, 6) for c in ("accuracy", "within_one")})


# --- rankings and cumulative tables ---------------------------------------------------------


@catalog.add(
    "top_n",
    "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 20",
)
def _(spark, sf):
    return window.top_n(table(spark, sf, "events").select("event_id", "user_id", "value"), [F.desc("value"), "event_id"], 20)


@catalog.add(
    "topk_per_key",
    """SELECT * FROM (SELECT user_id, event_id, value,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS INTEGER) AS place FROM events) WHERE place <= 5""",
)
def _(spark, sf):
    cols = table(spark, sf, "events").select("user_id", "event_id", "value")
    return window.topk_per_key(cols, "user_id", [F.desc("value"), "event_id"], 5)


@catalog.add(
    "latest_per_key",
    """SELECT event_id, user_id, event_type, value FROM
       (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def _(spark, sf):
    cols = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return window.latest_per_key(cols, "user_id", ["ts", "event_id"]).drop("ts")


CHANGE_ALERT_SQL = """WITH p AS (SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events),
     c AS (SELECT *, (value - previous) / previous * 100 AS change_pct FROM p WHERE previous IS NOT NULL)
     SELECT event_id, user_id, value, previous, round(change_pct, 4) AS change_pct,
       CASE WHEN change_pct > 0 THEN 'up' ELSE 'down' END AS direction FROM c WHERE abs(change_pct) >= 0.05"""


@catalog.add("change_alert", CHANGE_ALERT_SQL)
def _(spark, sf):
    ticks = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    alerts = window.change_alert(ticks, "user_id", ["ts", "event_id"], "value", F.date_trunc("minute", "ts"))
    return alerts.withColumn("change_pct", F.round("change_pct", 4)).drop("ts")


@catalog.add(
    "daily_leaderboard",
    """SELECT * FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, event_id, value,
       CAST(row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY value DESC, user_id, event_id) AS INTEGER) AS place
       FROM events WHERE value > 90) WHERE place <= 10""",
)
def _(spark, sf):
    fast = project.threshold_filter(table(spark, sf, "events"), "value", LIMIT)
    daily = fast.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id", "event_id", "value")
    return window.topk_per_key(daily, "day", [F.desc("value"), "user_id", "event_id"], 10)


_CUMULATIVE = """SELECT l_quantity, n, CAST(sum(n) OVER (ORDER BY l_quantity) AS BIGINT) AS cum_n, CAST(sum(n) OVER () AS BIGINT) AS t
     FROM (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity)"""


@catalog.add(
    "cumulative_counts",
    f"""SELECT l_quantity, n, cum_n, round(CAST(n AS DOUBLE) / t, 6) AS freq, round(CAST(cum_n AS DOUBLE) / t, 6) AS cum_freq
        FROM ({_CUMULATIVE})""",
)
def _(spark, sf):
    result = window.cumulative(table(spark, sf, "lineitem"), "l_quantity")
    return result.withColumns({c: F.round(c, 6) for c in ("freq", "cum_freq")})


@catalog.add(
    "ecdf",
    f"""SELECT l_quantity AS x, round(CAST(cum_n AS DOUBLE) / t, 6) AS f FROM ({_CUMULATIVE})
        UNION ALL SELECT min(l_quantity) - 1, 0.0 FROM lineitem UNION ALL SELECT max(l_quantity) + 1, 1.0 FROM lineitem""",
)
def _(spark, sf):
    return window.ecdf(table(spark, sf, "lineitem"), "l_quantity").withColumn("f", F.round("f", 6))


@catalog.add(
    "avg_rank",
    """SELECT value, count(*) AS n, avg(r) AS rank FROM (SELECT value, row_number() OVER (ORDER BY value) AS r FROM events)
       GROUP BY value""",
)
def _(spark, sf):
    return window.avg_rank(table(spark, sf, "events"), "value")
