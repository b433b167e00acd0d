"""Clustering methods, their evaluation and their comparison."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import metric, mixture
from lodestar.operators.centres import Centres, blocks, lloyd
from lodestar.operators.tiles import sample_rows, tile_join
from lodestar.session import cut

NOISE = -1

#: Up to this many labels distances are summed per label by a matrix product.
MATRIX_LABELS = 32


def points(df: DataFrame, id_col: str, features: Sequence[str] | str, *keep: str) -> DataFrame:
    """``id``, the coordinates as array ``x``, and columns to keep."""
    x = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(f).cast("double") for f in features])
    return df.select(F.col(id_col).cast("long").alias("id"), x.alias("x"), *keep)


def with_vector(pts: DataFrame) -> DataFrame:
    return pts.withColumn("features", array_to_vector("x"))


# --- methods --------------------------------------------------------------------------------


def _best_models(pts: DataFrame, ks: Sequence[int], seeds: int, seed: int) -> dict[int, Centres]:
    """Per k the best of several starts by inertia. The starts are chosen side by side, then all of them move in the same passes."""
    starts = [(k, seed + i) for k in sorted(ks, reverse=True) for i in range(seeds)]
    spark = pts.sparkSession
    data = with_vector(pts.select("x")).persist()
    try:
        data.count()  # once, before the fits ask for it together
        fit = lambda start: np.array(KMeans(k=start[0], seed=start[1], maxIter=0).fit(data).clusterCenters())
        with ThreadPoolExecutor(min(len(starts), spark.sparkContext.defaultParallelism)) as pool:
            first = list(pool.map(inheritable_thread_target(spark)(fit), starts))
        rows = blocks(data).persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()
    finally:
        data.unpersist()
    try:
        models = lloyd(rows, first)
    finally:
        rows.unpersist()
    return {k: min((m for (of, _), m in zip(starts, models) if of == k), key=lambda m: m.inertia) for k in ks}


def kmeans(pts: DataFrame, k: int, seeds: int = 10, seed: int = 42) -> Centres:
    """Best of several starts by inertia."""
    return _best_models(pts, [k], seeds, seed)[k]


def kmeans_labels(pts: DataFrame, model: Centres, out: str = "cluster") -> DataFrame:
    """The nearest centre of every row; of equally near ones the first."""
    sent = pts.sparkSession.sparkContext.broadcast(model.centres)

    @F.pandas_udf("int")
    def nearest(x: pd.Series) -> pd.Series:
        return pd.Series(metric.squared_distances(np.stack(x.to_numpy()).astype(float), sent.value).argmin(1) if len(x) else [], dtype="int32")

    return pts.withColumn(out, nearest("x"))


def kmeans_sweep(pts: DataFrame, ks: Sequence[int], seeds: int = 10, silhouettes: bool = True) -> DataFrame:
    """Inertia and silhouette (of squared distances, so linear in the points) per k."""
    spark, ks, rows = pts.sparkSession, list(ks), []
    models = _best_models(pts, ks, seeds, 42)
    for k in ks:
        score = None
        if silhouettes:
            score = silhouette_squared(kmeans_labels(pts, models[k]), "cluster").first()["silhouette"]
        rows.append((k, models[k].inertia, score))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def gmm(pts: DataFrame, k: int, seed: int = 42) -> mixture.Mixture:
    """Gaussian mixture with full covariances, started from k-means."""
    return mixture.fit(pts, k, seed)


def gmm_labels(pts: DataFrame, model: mixture.Mixture, out: str = "cluster") -> DataFrame:
    return mixture.labels(pts, model, out)


def gmm_bic(pts: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Bayesian information criterion per number of components (full covariances)."""
    n, rows = pts.count(), []
    for k in ks:
        model = gmm(pts, k)
        rows.append((k, model.log_likelihood, float(mixture.bic(model, n))))
    return pts.sparkSession.createDataFrame(rows, "k int, log_likelihood double, bic double")


def pca2(pts: DataFrame) -> DataFrame:
    """First two principal components of the centred points.

    Sign convention: in each component the loading of largest size is positive.
    """
    centred = StandardScaler(inputCol="features", outputCol="_c", withMean=True, withStd=False)
    data = with_vector(pts)
    data = centred.fit(data).transform(data)
    model = PCA(k=2, inputCol="_c", outputCol="_pc").fit(data)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.abs(loadings[:, j]).argmax(), j]) or 1.0) for j in range(2)]
    parts = model.transform(data).withColumn("_a", vector_to_array("_pc"))
    rest = [c for c in pts.columns if c != "x"]
    return parts.select(*rest, (F.col("_a")[0] * signs[0]).alias("pc1"), (F.col("_a")[1] * signs[1]).alias("pc2"))


# --- distances ------------------------------------------------------------------------------


def silhouette(labelled: DataFrame, label: str, sample: int | None = None, seed: int = 42) -> DataFrame:
    """Mean silhouette with plain Euclidean distance, noise (-1) left out: (n, silhouette).

    Exact over all points by default. That needs every distance, so for large tables give
    ``sample``: that many points are scored, still against every point.
    """
    pts = labelled.filter(F.col(label) != NOISE).select("id", "x", F.col(label).cast("long").alias("label"))
    queries = sample_rows(pts, sample, seed) if sample else pts

    def sums(q: pd.DataFrame, batches) -> pd.DataFrame:
        total: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for p, d2 in batches:
            names, place = np.unique(p["label"].to_numpy(), return_inverse=True)
            if len(names) <= MATRIX_LABELS:
                added = np.sqrt(d2) @ (place[:, None] == np.arange(len(names))).astype(float)
            else:
                order = np.argsort(place, kind="stable")
                added = np.add.reduceat(np.sqrt(d2)[:, order], np.searchsorted(place[order], np.arange(len(names))), axis=1)
            for one, column, n in zip(names, added.T, np.bincount(place)):
                total[one] = total.get(one, 0.0) + column
                count[one] = count.get(one, 0) + int(n)
        parts = [
            pd.DataFrame({"id": q["id"], "own": q["label"], "label": one, "s": total[one], "n": count[one]}) for one in total
        ]
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({c: [] for c in ("id", "own", "label", "s", "n")})

    schema = "id long, own long, label long, s double, n long"
    per_label = tile_join(queries, pts, sums, schema).groupBy("id", "own", "label").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    own = F.col("own") == F.col("label")
    per_point = per_label.groupBy("id").agg(
        F.max(F.when(own, F.col("n"))).alias("size"),
        F.max(F.when(own, F.col("s") / F.greatest(F.col("n") - 1, F.lit(1)))).alias("a"),
        F.min(F.when(~own, F.col("s") / F.col("n"))).alias("b"),
    )
    apart = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    score = F.when(F.col("b").isNotNull(), F.when(F.col("size") == 1, 0.0).otherwise(apart))
    return per_point.agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("silhouette"))


def silhouette_squared(labelled: DataFrame, label: str) -> DataFrame:
    """Mean silhouette with squared Euclidean distance: exact in one linear pass."""
    pts = with_vector(labelled.filter(F.col(label) != NOISE))
    evaluator = ClusteringEvaluator(predictionCol=label, featuresCol="features", metricName="silhouette")
    score = evaluator.evaluate(pts.withColumn(label, F.col(label).cast("double")))
    return labelled.sparkSession.createDataFrame([(float(score),)], "silhouette double")


def k_distance(pts: DataFrame, k: int, sample: int | None = None, seed: int = 42) -> DataFrame:
    """Distance of every point to its k-th nearest point, itself counted, in ascending order.

    Points look into the cells of a metric index that can hold a nearer one. ``sample`` asks for that many
    points only, still among all. With fewer than ``k`` points there is no such distance and no row.
    """
    index = metric.build(pts.select("id", "x"))
    queries = sample_rows(pts, sample, seed) if sample else pts
    wanted = index.table.join(queries.select("x").distinct(), "x", "left_semi") if sample else index.table
    best = metric.k_nearest(index, wanted, k).filter(F.size("best") == k)
    kth = index.table.join(best, "i").select("x", F.sqrt(F.get("best", F.lit(k - 1))).alias("distance"))
    return queries.select("id", "x").join(kth, "x").select("id", "distance").orderBy("distance", "id")


# --- agreement of two partitions ------------------------------------------------------------


def _cells(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table: ``a``, ``b``, ``n``."""
    return df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("n"))


def _with_margins(cells: DataFrame) -> DataFrame:
    """Cells with their margins and the number of cells each margin has."""
    of_a = cells.groupBy("a").agg(F.sum("n").alias("na"), F.count(F.lit(1)).alias("ka")).withColumnRenamed("a", "of_a")
    of_b = cells.groupBy("b").agg(F.sum("n").alias("nb"), F.count(F.lit(1)).alias("kb")).withColumnRenamed("b", "of_b")
    both = cells.join(of_a, F.col("a").eqNullSafe(F.col("of_a"))).join(of_b, F.col("b").eqNullSafe(F.col("of_b")))
    return both.select("a", "b", "n", "na", "nb", "ka", "kb")


def _ari(margins: DataFrame) -> DataFrame:
    pairs = lambda c: F.col(c) * (F.col(c) - 1) / 2
    sums = margins.agg(
        F.sum(pairs("n")).alias("both"),
        F.sum(pairs("na") / F.col("ka")).alias("in_a"),
        F.sum(pairs("nb") / F.col("kb")).alias("in_b"),
        F.sum("n").alias("total"),
    )
    chance = F.coalesce(F.try_divide(F.col("in_a") * F.col("in_b"), pairs("total")), F.lit(0.0))
    top, bottom = F.col("both") - chance, (F.col("in_a") + F.col("in_b")) / 2 - chance
    return sums.select(F.when(bottom == 0, 1.0).otherwise(top / bottom).alias("ari"))


def _nmi(margins: DataFrame) -> DataFrame:
    total = margins.agg(F.sum("n")).scalar()
    shares = margins.withColumn("t", total)
    n, na, nb, t = (F.col(c) for c in ("n", "na", "nb", "t"))
    sums = shares.agg(
        F.sum(n / t * F.log(n * t / (na * nb))).alias("mi"),
        F.sum(-n / t * F.log(na / t)).alias("ha"),
        F.sum(-n / t * F.log(nb / t)).alias("hb"),
    )
    mean = (F.col("ha") + F.col("hb")) / 2
    return sums.select(F.when(mean == 0, 1.0).otherwise(F.col("mi") / mean).alias("nmi"))


def ari(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index from the contingency counts (each margin enters once per its cells)."""
    return _ari(_with_margins(_cells(df, a, b)))


def nmi(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mutual information over the arithmetic mean of both entropies."""
    return _nmi(_with_margins(_cells(df, a, b)))


def cluster_sizes(df: DataFrame, label: str) -> DataFrame:
    """Rows per cluster and the share of noise, repeated in every row."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    noise = sizes.agg(F.sum(F.when(F.col(label) == NOISE, F.col("n")).otherwise(0)) / F.sum("n")).scalar()
    return sizes.withColumn("noise_share", noise)


def compare_methods(labelled: dict[str, DataFrame | Callable[[], DataFrame]], label: str, truth: str) -> DataFrame:
    """One row per method: clusters found, noise share, agreement with the true labels.

    Each labelling is computed once, for its contingency table; everything else follows from that. Labellings given as
    functions are fitted side by side: each is a row of many short jobs that leave most cores idle.
    """

    def contingency(one: DataFrame | Callable[[], DataFrame]) -> DataFrame:
        return cut(_with_margins(_cells(one if isinstance(one, DataFrame) else one(), truth, label)))

    spark = SparkSession.active()
    with ThreadPoolExecutor(max(1, len(labelled))) as pool:
        tables = list(pool.map(inheritable_thread_target(spark)(contingency), labelled.values()))
    table = None
    for name, margins in zip(labelled, tables):
        counts = margins.agg(
            F.count_distinct(F.when(F.col("b") != NOISE, F.col("b"))).alias("clusters"),
            (F.sum(F.when(F.col("b") == NOISE, F.col("n")).otherwise(0)) / F.sum("n")).alias("noise_share"),
        )
        row = counts.select(F.lit(name).alias("method"), "clusters", "noise_share", _ari(margins).scalar().alias("ari"), _nmi(margins).scalar().alias("nmi"))
        table = row if table is None else table.unionByName(row)
    return table
