"""Sources, sinks, key/value and document forms, and query-first tables.

Each query writes the given table through a sink into the shared folder and reads it back, so
its result shows what really went through the format.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.catalog import Catalog, table
from lodestar.operators import aggregate as agg
from lodestar.operators import join, ordered, window
from lodestar.plans import inspect, tables
from lodestar.session import scratch
from lodestar.sources import documents, files, log
from lodestar.streaming import decode

catalog = Catalog()
CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
READING_DDL = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
MESSAGE_DDL = "user_id BIGINT, event_type STRING, value DOUBLE"


@catalog.add("csv_roundtrip", "SELECT * FROM customer")
def _(spark, sf):
    path = scratch(spark, "csv")
    files.write_csv(table(spark, sf, "customer"), path)
    return files.read_csv(spark, path, CUSTOMER_DDL)


@catalog.add("tsv_roundtrip", "SELECT * FROM customer")
def _(spark, sf):
    path = scratch(spark, "tsv")
    files.write_csv(table(spark, sf, "customer"), path, sep="\t")
    return files.read_csv(spark, path, CUSTOMER_DDL, sep="\t")


@catalog.add(
    "headerless_scan",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus, o_totalprice FROM orders",
)
def _(spark, sf):
    path = scratch(spark, "headerless")
    day = F.date_format("o_orderdate", "yyyyMMdd").alias("o_orderdate")
    rows = table(spark, sf, "orders").select("o_orderkey", day, "o_orderstatus", "o_totalprice")
    files.write_csv(rows, path, header=False)
    ddl = "o_orderkey BIGINT, o_orderdate STRING, o_orderstatus STRING, o_totalprice DOUBLE"
    return files.read_headerless_csv(spark, path, ddl, {"o_orderdate": "yyyyMMdd"})


def _readings(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")


@catalog.add("text_records", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    path = scratch(spark, "lines")
    files.write_csv(_readings(spark, sf), path)
    return files.read_text_records(spark, path, READING_DDL, header_prefix="event_id")


def _damaged(spark, sf):
    """Reading lines where error events lost their number and signups their last field."""
    path = scratch(spark, "damaged")
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    last = F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(value)
    line = F.concat_ws(",", "event_id", "user_id", "event_type", last)
    _readings(spark, sf).select(line.alias("value")).write.text(path)
    return path


@catalog.add(
    "malformed_drop",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type NOT IN ('error', 'signup')",
)
def _(spark, sf):
    return files.read_text_records(spark, _damaged(spark, sf), READING_DDL, malformed="drop")


@catalog.add(
    "malformed_null",
    """SELECT event_id, user_id, event_type, CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS value,
       CASE event_type WHEN 'error' THEN event_id || ',' || user_id || ',error,n/a'
                       WHEN 'signup' THEN event_id || ',' || user_id || ',signup' END AS _corrupt_record FROM events""",
)
def _(spark, sf):
    return files.read_text_records(spark, _damaged(spark, sf), READING_DDL, malformed="null")


@catalog.add("csv_sink", "SELECT user_id, count(*) AS excess FROM events WHERE value > 90 GROUP BY user_id")
def _(spark, sf):
    path = scratch(spark, "excess-csv")
    files.write_csv(agg.excess_count(table(spark, sf, "events"), "user_id", "value", 90.0), path)
    return files.read_csv(spark, path, "user_id BIGINT, excess BIGINT")


@catalog.add("parquet_sink", "SELECT user_id, count(*) AS excess FROM events WHERE value > 90 GROUP BY user_id")
def _(spark, sf):
    path = scratch(spark, "excess-parquet")
    files.write_parquet(agg.excess_count(table(spark, sf, "events"), "user_id", "value", 90.0), path)
    return spark.read.parquet(path)


@catalog.add("text_pairs", "SELECT user_id || chr(9) || count(*) AS line FROM events WHERE value > 90 GROUP BY user_id")
def _(spark, sf):
    path = scratch(spark, "pairs")
    counts = agg.excess_count(table(spark, sf, "events"), "user_id", "value", 90.0)
    files.write_text_pairs(counts, path, "user_id", "excess")
    return spark.read.text(path).withColumnRenamed("value", "line")


@catalog.add(
    "document_sink",
    """SELECT n_name, CAST(sum(s) AS BIGINT) AS sales, CAST(sum(r) AS DOUBLE) AS revenue,
       string_agg(c_mktsegment || '=' || s || '/' || CAST(r AS VARCHAR), ';' ORDER BY c_mktsegment) AS parts
       FROM (SELECT n_name, c_mktsegment, count(*) AS s, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS r FROM orders
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL) GROUP BY n_name""",
)
def _(spark, sf):
    path = scratch(spark, "documents")
    sums = agg.totals(table(spark, sf, "orders"), "o_custkey", "o_totalprice").withColumnRenamed("o_custkey", "c_custkey")
    stores = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    joined = join.enrich(join.enrich(sums, stores, "c_custkey"), table(spark, sf, "nation"), "n_nationkey")
    documents.write_documents(agg.nested_revenue(joined, "n_name", "c_mktsegment"), path)
    ddl = """n_name STRING, sales BIGINT, revenue DOUBLE,
             parts ARRAY<STRUCT<c_mktsegment: STRING, sales: BIGINT, revenue: DOUBLE>>"""
    entry = lambda p: F.concat(p["c_mktsegment"], F.lit("="), p["sales"], F.lit("/"), p["revenue"].cast("decimal(28,2)"))
    return spark.read.schema(ddl).json(path).withColumn("parts", F.concat_ws(";", F.transform("parts", entry)))


@catalog.add(
    "document_import",
    "SELECT *, sha256(c_custkey || '|' || c_name || '|' || c_mktsegment) AS _id FROM customer",
)
def _(spark, sf):
    path = scratch(spark, "import")
    files.write_csv(table(spark, sf, "customer"), path)
    return documents.with_document_id(files.read_csv(spark, path, CUSTOMER_DDL), ["c_custkey", "c_name", "c_mktsegment"])


@catalog.add("document_random_id", "SELECT count(*) AS documents, count(*) AS ids FROM customer")
def _(spark, sf):
    ids = documents.with_document_id(table(spark, sf, "customer"))
    return ids.agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("_id").alias("ids"))


@catalog.add(
    "number_records",
    "SELECT o_orderkey, o_orderdate, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS n FROM orders",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ordered.number_records(rows, ["o_orderdate", "o_orderkey"])


@catalog.add(
    "keyed_hash",
    """SELECT 'reading:' || event_id AS key,
       '{"user_id":"' || user_id || '","event_type":"' || event_type || '","value":"' || value || '"}' AS fields FROM events""",
)
def _(spark, sf):
    hashes = files.keyed_hash(_readings(spark, sf), "reading", "event_id", ["user_id", "event_type", "value"])
    return hashes.withColumn("fields", F.to_json("fields"))


def event_log(spark, sf):
    """``events`` as a keyed log of three partitions in files; returns the path."""
    path = scratch(spark, "log")
    events = table(spark, sf, "events")
    messages = events.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct("user_id", "event_type", "value")).alias("value"),
        (F.col("user_id") % 3).alias("_p"),
        F.col("event_id").alias("_o"),
        F.col("ts").alias("_t"),
    )
    log.as_envelope(messages, "events", F.col("_p"), F.col("_o"), F.col("_t")).write.parquet(path)
    return path


@catalog.add(
    "log_encode",
    """SELECT CAST(user_id AS VARCHAR) AS key,
       '{"user_id":' || user_id || ',"event_type":"' || event_type || '","value":' || value || '}' AS value FROM events""",
)
def _(spark, sf):
    return log.encode_log(table(spark, sf, "events"), "user_id", ["user_id", "event_type", "value"])


@catalog.add("log_batch_decode", "SELECT event_id AS \"offset\", user_id, event_type, value FROM events")
def _(spark, sf):
    messages = log.read_log(spark, "parquet", {}, event_log(spark, sf)).select("offset", "value")
    return decode.decode_json(messages, "value", MESSAGE_DDL)


@catalog.add(
    "replay_count",
    """SELECT CAST(user_id % 3 AS INTEGER) AS "partition", count(*) AS messages, max(event_id) + 1 AS end_offset
       FROM events GROUP BY 1""",
)
def _(spark, sf):
    return log.replay_count(log.read_log(spark, "parquet", {}, event_log(spark, sf)))


@catalog.add(
    "sse_decode",
    "SELECT user_id, event_type, value, CAST(NULL AS BOOLEAN) AS bot FROM events WHERE event_type <> 'error'",
)
def _(spark, sf):
    # Error events lose their key field; every event is preceded by a mark line and a comment.
    path = scratch(spark, "event-lines")
    message = F.to_json(F.struct(F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), "event_type", "value"))
    lines = F.explode(F.array(F.lit("event: message"), F.lit(":ok"), F.concat(F.lit("data: "), message), F.lit("")))
    table(spark, sf, "events").select(lines.alias("value")).write.text(path)
    return decode.decode_event_lines(spark.read.text(path), "value", MESSAGE_DDL + ", bot BOOLEAN", "user_id")


@catalog.add("decode_json", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def _(spark, sf):
    return decode.decode_json(table(spark, sf, "events").select("event_id", "props"), "props", "k INT")


@catalog.add(
    "decode_json_damaged",
    """SELECT event_id, CASE WHEN event_type NOT IN ('signup', 'click') THEN CAST(props->>'$.k' AS INTEGER) END AS k
       FROM events WHERE event_type <> 'error'""",
)
def _(spark, sf):
    # Error events carry half a document; the policy drops them instead of forming a null group. An
    # empty document and one with other fields only are whole and stay.
    half = (
        F.when(F.col("event_type") == "error", F.lit('{"k": '))
        .when(F.col("event_type") == "signup", F.lit("{}"))
        .when(F.col("event_type") == "click", F.lit('{"other": 1}'))
        .otherwise(F.col("props"))
    )
    rows = table(spark, sf, "events").select("event_id", half.alias("props"))
    return decode.decode_json(rows, "props", "k INT", drop_malformed=True)


@catalog.add("variant_field", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "props")
    return decode.variant_field(rows, "props", "$.k", "int", "k").drop("props")


# --- query-first tables ---------------------------------------------------------------------


def _by_type(spark, sf):
    """The question table: one directory per event type, fastest reading first."""
    path = scratch(spark, "by-type")
    tables.write_query_table(_readings(spark, sf), path, ["event_type"], [F.desc("value"), "event_id"])
    return spark.read.parquet(path)


@catalog.add(
    "query_table_topk",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'purchase' ORDER BY value DESC, event_id LIMIT 5",
)
def _(spark, sf):
    fastest = _by_type(spark, sf).filter("event_type = 'purchase'")
    return window.top_n(fastest, [F.desc("value"), "event_id"], 5)


@catalog.add(
    "query_table_max",
    "SELECT event_type, max(value) AS largest FROM events WHERE event_type = 'view' GROUP BY event_type",
)
def _(spark, sf):
    best = window.top_n(_by_type(spark, sf).filter("event_type = 'view'"), [F.desc("value"), "event_id"], 1)
    return best.select("event_type", F.col("value").alias("largest"))


@catalog.add(
    "query_table_excess",
    "SELECT event_id, value FROM events WHERE event_type = 'click' AND value > 90",
)
def _(spark, sf):
    return _by_type(spark, sf).filter("event_type = 'click' AND value > 90").select("event_id", "value")


@catalog.add(
    "scan_guard",
    """WITH n AS (SELECT count(DISTINCT event_type) AS n_all, count(DISTINCT event_type) FILTER (event_type = 'click') AS n_click FROM events)
       SELECT question, n_read, n_all, n_read = n_all AND n_all > 0 AS full_scan FROM
       (SELECT 'clicks above 90' AS question, n_click AS n_read, n_all FROM n UNION ALL SELECT 'above 90', n_all, n_all FROM n
        UNION ALL SELECT 'clicks or above 90', n_all, n_all FROM n)""",
)
def _(spark, sf):
    questions = {
        "clicks above 90": ["event_type = 'click'", "value > 90"],
        "above 90": ["value > 90"],
        "clicks or above 90": ["event_type = 'click' OR value > 90"],
    }
    return inspect.partitions_read(_by_type(spark, sf), ["event_type"], questions)


@catalog.add(
    "monthly_partition",
    """SELECT o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, o_totalprice FROM orders
       WHERE o_orderpriority = '2-HIGH' AND strftime(o_orderdate, '%Y-%m') = '1997-08'""",
)
def _(spark, sf):
    path = scratch(spark, "monthly")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    tables.monthly_partition(rows, "o_orderdate", "o_orderpriority", path)
    wanted = spark.read.schema(
        "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_totalprice DOUBLE, o_orderpriority STRING, month STRING"
    ).parquet(path).filter("o_orderpriority = '2-HIGH' AND month = '1997-08'")
    return wanted.drop("o_orderdate")


@catalog.add(
    "pk_overwrite",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM
       (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1""",
)
def _(spark, sf):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *order)
    return tables.pk_overwrite(rows, ["l_orderkey", "l_linenumber"], order)


@catalog.add("partition_count", "SELECT count(*) AS n FROM events WHERE event_type = 'error'")
def _(spark, sf):
    return tables.partition_count(_by_type(spark, sf), "event_type", "error")
