"""Clustering of ``embeddings`` (64 dimensions, true labels) and of ``part`` in two dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.catalog import Catalog, table
from lodestar.operators import cluster, dbscan, learn, radii, ward

catalog = Catalog()
PART_COLS = ["p_size", "p_retailprice"]
EPS, MIN_SAMPLES = 0.1, 6


def _embeddings(spark, sf):
    return cluster.points(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")


def _parts(spark, sf):
    """Parts in the plane of standardised size and price."""
    return cluster.points(learn.standardize(table(spark, sf, "part"), PART_COLS), "p_partkey", PART_COLS)


# --- distances ------------------------------------------------------------------------------

_PAIRS = """p AS (SELECT a.vec_id AS i, a.label AS own, b.label AS other, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
     FROM embeddings a, embeddings b)"""
_SILHOUETTE = """WITH {pairs}, s AS (SELECT i, own, other, sum({d}) AS s, count(*) AS n FROM p GROUP BY ALL),
     t AS (SELECT i, max(CASE WHEN own = other THEN n END) AS size, max(CASE WHEN own = other THEN s / greatest(n - 1, 1) END) AS a,
           min(CASE WHEN own <> other THEN s / n END) AS b FROM s GROUP BY i)
     SELECT {n}round(avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM t"""


@catalog.add("silhouette", _SILHOUETTE.format(pairs=_PAIRS, d="d", n="count(*) AS n, "))
def _(spark, sf):
    return cluster.silhouette(_embeddings(spark, sf), "label").withColumn("silhouette", F.round("silhouette", 6))


@catalog.add("silhouette_squared", _SILHOUETTE.format(pairs=_PAIRS, d="d * d", n=""))
def _(spark, sf):
    return cluster.silhouette_squared(_embeddings(spark, sf), "label").withColumn("silhouette", F.round("silhouette", 6))


@catalog.add(
    "k_distance",
    f"""WITH {_PAIRS} SELECT i AS id, round(d, 6) AS distance FROM
        (SELECT i, d, row_number() OVER (PARTITION BY i ORDER BY d) AS r FROM p) WHERE r = 5""",
)
def _(spark, sf):
    return cluster.k_distance(_embeddings(spark, sf), 5).withColumn("distance", F.round("distance", 6))


# --- density --------------------------------------------------------------------------------

_NEAR = f"""z AS (SELECT p_partkey AS id, (p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part) AS x,
       (p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part) AS y FROM part),
     near AS (SELECT a.id AS i, b.id AS j FROM z a JOIN z b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS * EPS!r}),
     core AS (SELECT i AS id, count(*) AS neighbours FROM near GROUP BY i HAVING count(*) >= {MIN_SAMPLES})"""


@catalog.add("dbscan_core", f"WITH {_NEAR} SELECT * FROM core")
def _(spark, sf):
    return dbscan.core_points(_parts(spark, sf), EPS, MIN_SAMPLES)


_CLUSTER_STEPS = """link AS (SELECT i, j FROM near WHERE i IN (SELECT id FROM core) AND j IN (SELECT id FROM core)),
     reach(id, root) AS (SELECT id, id FROM core UNION SELECT j, root FROM reach JOIN link ON i = id WHERE root < j),
     label AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
     border AS (SELECT i AS id, min(root) AS root FROM near JOIN label ON j = label.id WHERE i NOT IN (SELECT id FROM core) GROUP BY i),
     every AS (SELECT * FROM label UNION ALL SELECT * FROM border),
     numbered AS (SELECT id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM every)"""
_DBSCAN_SQL = f"WITH RECURSIVE {_NEAR}, {_CLUSTER_STEPS}"
_PAIRS_BY_ID = """p AS (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
     FROM embeddings a, embeddings b)"""


@catalog.add("dbscan", _DBSCAN_SQL + " SELECT z.id, coalesce(cluster, -1) AS cluster FROM z LEFT JOIN numbered USING (id)")
def dbscan_parts(spark, sf):
    return dbscan.dbscan(_parts(spark, sf), EPS, MIN_SAMPLES, 2).select("id", "cluster")


WIDE_EPS, WIDE_MIN_SAMPLES = 1.12, 4


@catalog.add(
    "dbscan_embeddings",
    f"""WITH RECURSIVE {_PAIRS_BY_ID}, near AS (SELECT i, j FROM p WHERE d <= {WIDE_EPS}),
     core AS (SELECT i AS id, count(*) AS neighbours FROM near GROUP BY i HAVING count(*) >= {WIDE_MIN_SAMPLES}),
     {_CLUSTER_STEPS} SELECT v.vec_id AS id, coalesce(cluster, -1) AS cluster FROM embeddings v LEFT JOIN numbered ON numbered.id = vec_id""",
)
def _(spark, sf):
    """The same in 64 dimensions, where cells around pivots take the place of the grid."""
    return dbscan.dbscan(_embeddings(spark, sf), WIDE_EPS, WIDE_MIN_SAMPLES, 64).select("id", "cluster")


#: 24 radii around the knee of the k-distances, and seven densities.
GRID_EPS, GRID_MIN_SAMPLES = [round(1.16 + 0.005 * i, 3) for i in range(24)], [4, 5, 6, 8, 10, 12, 15]


@catalog.add("dbscan_grid")
def _(spark, sf):
    return radii.dbscan_grid(_embeddings(spark, sf), GRID_EPS, GRID_MIN_SAMPLES, clusters=(2, 5), max_noise=0.5, top=10)


@catalog.add(
    "cluster_sizes",
    _DBSCAN_SQL + """, c AS (SELECT coalesce(cluster, -1) AS cluster, count(*) AS n FROM z LEFT JOIN numbered USING (id) GROUP BY 1)
     SELECT cluster, n, round((SELECT coalesce(sum(CASE WHEN cluster = -1 THEN n ELSE 0 END), 0) / sum(n) FROM c), 6) AS noise_share FROM c""",
)
def _(spark, sf):
    return cluster.cluster_sizes(dbscan_parts(spark, sf), "cluster").withColumn("noise_share", F.round("noise_share", 6))


# --- centres, trees, mixtures ---------------------------------------------------------------


@catalog.add("kmeans_sweep")
def _(spark, sf):
    return cluster.kmeans_sweep(_embeddings(spark, sf), range(2, 9))


@catalog.add("kmeans_inertia", "SELECT count(*) AS n, true AS as_reported FROM embeddings")
def _(spark, sf):
    """Inertia recomputed from labels and centres against the one the model reports."""
    pts = _embeddings(spark, sf)
    model = cluster.kmeans(pts, 5, seeds=1)
    centres = F.lit([[float(v) for v in c] for c in model.centres]).cast("array<array<double>>")
    gaps = F.zip_with("x", F.get(centres, F.col("cluster")), lambda a, b: (a - b) * (a - b))
    labelled = cluster.kmeans_labels(pts, model).select(F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v).alias("d2"))
    reported = model.inertia
    return labelled.agg(F.count(F.lit(1)).alias("n"), (F.abs(F.sum("d2") / reported - 1) < 1e-6).alias("as_reported"))


@catalog.add(
    "pca2_plane",
    """WITH v AS (SELECT var_samp(p_size) AS a, var_samp(p_retailprice) AS c, covar_samp(p_size, p_retailprice) AS b FROM part),
         r AS (SELECT (a + c) / 2 AS m, sqrt(pow((a - c) / 2, 2) + b * b) AS h FROM v)
       SELECT round(m + h, 3) AS first, round(m - h, 3) AS second FROM r""",
)
def _(spark, sf):
    """Variances along the principal axes of two columns, against their closed form."""
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.array(F.col("p_size").cast("double"), "p_retailprice").alias("x"))
    return cluster.pca2(rows).agg(F.round(F.var_samp("pc1"), 3).alias("first"), F.round(F.var_samp("pc2"), 3).alias("second"))


@catalog.add("ward_micro")
def _(spark, sf):
    return cluster.cluster_sizes(ward.ward(_embeddings(spark, sf), 3), "cluster")


@catalog.add("gmm")
def _(spark, sf):
    pts = _parts(spark, sf)
    return cluster.cluster_sizes(cluster.gmm_labels(pts, cluster.gmm(pts, 3)), "cluster")


@catalog.add("gmm_bic")
def _(spark, sf):
    return cluster.gmm_bic(_parts(spark, sf), range(2, 6))


@catalog.add("pca2")
def _(spark, sf):
    return cluster.pca2(_embeddings(spark, sf))


# --- agreement ------------------------------------------------------------------------------

_TABLE = """c AS (SELECT label AS a, embedding[1] > 0 AS b, CAST(count(*) AS DOUBLE) AS n FROM embeddings GROUP BY ALL),
     ra AS (SELECT a, sum(n) AS n FROM c GROUP BY a), rb AS (SELECT b, sum(n) AS n FROM c GROUP BY b), t AS (SELECT sum(n) AS n FROM c)"""


def _two_labels(spark, sf):
    """True labels against a rule: the sign of the first coordinate."""
    return table(spark, sf, "embeddings").select("label", (F.col("embedding")[0] > 0).alias("rule"))


@catalog.add(
    "ari",
    f"""WITH {_TABLE}, s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM c) AS i, (SELECT sum(n * (n - 1) / 2) FROM ra) AS x,
          (SELECT sum(n * (n - 1) / 2) FROM rb) AS y, (SELECT n * (n - 1) / 2 FROM t) AS z)
        SELECT round((i - x * y / z) / ((x + y) / 2 - x * y / z), 8) AS ari FROM s""",
)
def _(spark, sf):
    return cluster.ari(_two_labels(spark, sf), "label", "rule").withColumn("ari", F.round("ari", 8))


@catalog.add(
    "nmi",
    f"""WITH {_TABLE}, s AS (SELECT (SELECT sum(c.n / t.n * ln(c.n * t.n / (ra.n * rb.n))) FROM c JOIN ra USING (a) JOIN rb USING (b), t) AS mi,
          (SELECT -sum(ra.n / t.n * ln(ra.n / t.n)) FROM ra, t) AS ha, (SELECT -sum(rb.n / t.n * ln(rb.n / t.n)) FROM rb, t) AS hb)
        SELECT round(mi / ((ha + hb) / 2), 8) AS nmi FROM s""",
)
def _(spark, sf):
    return cluster.nmi(_two_labels(spark, sf), "label", "rule").withColumn("nmi", F.round("nmi", 8))


@catalog.add("method_table")
def _(spark, sf):
    """K-means, Ward, mixture and density clustering of all features against the true labels."""
    pts = _embeddings(spark, sf)
    return cluster.compare_methods(
        {
            "k-means": lambda: cluster.kmeans_labels(pts, cluster.kmeans(pts, 10)),
            "ward": lambda: ward.ward(pts, 10),
            "mixture": lambda: cluster.gmm_labels(pts, cluster.gmm(pts, 10)),
            "density": lambda: dbscan.dbscan(pts, WIDE_EPS, WIDE_MIN_SAMPLES, 64),
        },
        "cluster",
        "label",
    )
