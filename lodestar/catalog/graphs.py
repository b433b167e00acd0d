"""Graph queries. The trade graph links orders and parts through all lines of ``lineitem``; the
customer graph links all orders to their customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.catalog import Catalog, table
from lodestar.operators import graph

catalog = Catalog()

_EDGES = """e AS (SELECT 'O' || l_orderkey AS src, 'P' || l_partkey AS dst, l_linenumber AS line, CAST(l_quantity AS INTEGER) AS qty FROM lineitem),
     u AS (SELECT src, dst, line, qty FROM e UNION ALL SELECT dst, src, line, qty FROM e)"""


def _trade(spark, sf):
    orders = table(spark, sf, "orders").select(F.concat(F.lit("O"), "o_orderkey").alias("id"))
    parts = table(spark, sf, "part").select(F.concat(F.lit("P"), "p_partkey").alias("id"))
    edges = table(spark, sf, "lineitem").select(
        F.concat(F.lit("O"), "l_orderkey").alias("src"),
        F.concat(F.lit("P"), "l_partkey").alias("dst"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("int").alias("qty"),
    )
    return graph.build_graph(orders.unionByName(parts), edges)


@catalog.add("graph_undirected", f"WITH {_EDGES} SELECT * FROM u")
def _(spark, sf):
    return graph.undirected(_trade(spark, sf))


@catalog.add("neighbours", f"WITH {_EDGES} SELECT dst AS neighbour, line, qty FROM u WHERE src = 'P17'")
def _(spark, sf):
    return graph.neighbours(_trade(spark, sf), "P17", "qty")


@catalog.add("degree_topn", f"WITH {_EDGES} SELECT src AS id, count(*) AS degree FROM u GROUP BY src ORDER BY degree DESC, id LIMIT 10")
def _(spark, sf):
    return graph.degree(_trade(spark, sf), 10)


@catalog.add("graph_triples", f"WITH {_EDGES} SELECT src AS vertex, dst AS neighbour, qty FROM u")
def _(spark, sf):
    return graph.triples(_trade(spark, sf), "qty")


@catalog.add(
    "shortest_path_hops",
    f"""WITH RECURSIVE {_EDGES}, d AS (SELECT src, dst, min(qty) AS qty FROM u GROUP BY ALL),
        bfs(id, lvl) AS (SELECT 'O1', 0 UNION SELECT d.dst, lvl + 1 FROM bfs JOIN d ON d.src = bfs.id WHERE lvl < 8),
        first AS (SELECT id, min(lvl) AS lvl FROM bfs GROUP BY id),
        pred AS (SELECT v.id, min(w.id) AS p FROM first v JOIN d ON d.dst = v.id JOIN first w ON w.id = d.src AND w.lvl = v.lvl - 1 GROUP BY v.id),
        walk(id, path, hops, total) AS (SELECT 'O5', 'O5', 0, 0 FROM first WHERE id = 'O5'
          UNION ALL SELECT p, p || '>' || path, hops + 1, total + d.qty FROM walk JOIN pred USING (id) JOIN d ON d.src = p AND d.dst = walk.id)
        SELECT path, hops, CAST(total AS DOUBLE) AS total FROM walk WHERE id = 'O1'""",
)
def _(spark, sf):
    found = graph.shortest_path(_trade(spark, sf), "O1", "O5", "qty")
    return found.withColumn("path", F.concat_ws(">", "path"))


@catalog.add(
    "components",
    """SELECT 'O' || o_orderkey AS id, 'C' || o_custkey AS component FROM orders
       UNION ALL SELECT 'C' || c_custkey, 'C' || c_custkey FROM customer""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.concat(F.lit("O"), "o_orderkey").alias("src"), F.concat(F.lit("C"), "o_custkey").alias("dst"))
    customers = table(spark, sf, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("id"))
    vertices = orders.select(F.col("src").alias("id")).unionByName(customers)
    return graph.components(vertices, orders)


@catalog.add(
    "trade_components",
    """WITH RECURSIVE e AS (SELECT DISTINCT 'O' || l_orderkey AS o, 'P' || l_partkey AS p FROM lineitem),
       u AS (SELECT o AS a, p AS b FROM e UNION ALL SELECT p, o FROM e),
       reach(id) AS (SELECT min(o) FROM e UNION SELECT b FROM reach JOIN u ON a = id),
       v AS (SELECT 'O' || o_orderkey AS id FROM orders UNION ALL SELECT 'P' || p_partkey FROM part)
       SELECT CASE WHEN id IN (SELECT id FROM reach) THEN (SELECT min(o) FROM e) ELSE id END AS component, count(*) AS n FROM v GROUP BY 1""",
)
def _(spark, sf):
    """Orders and parts are even and odd numbers on the way, a fraction of the bytes of their names; a component is named at the end."""
    number = lambda key, odd: F.shiftleft(F.col(key).cast("long"), 1).bitwiseOR(F.lit(odd))
    orders = table(spark, sf, "orders").select(number("o_orderkey", 0).alias("id"))
    parts = table(spark, sf, "part").select(number("p_partkey", 1).alias("id"))
    edges = table(spark, sf, "lineitem").select(number("l_orderkey", 0).alias("src"), number("l_partkey", 1).alias("dst"))
    g = graph.build_graph(orders.unionByName(parts), edges)
    name = F.concat(F.when(F.col("id").bitwiseAND(F.lit(1)) == 1, "P").otherwise("O"), F.shiftright("id", 1))
    sizes = graph.components(g.vertices, g.edges).groupBy("component").agg(F.min(name).alias("name"), F.count(F.lit(1)).alias("n"))
    return sizes.select(F.col("name").alias("component"), "n")
