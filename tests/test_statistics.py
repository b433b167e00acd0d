import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.functions.pvalues import _chi2_tail, _t_two_sided
from lodestar.operators import bivariate as bi
from lodestar.operators import ordered
from lodestar.operators import univariate as uni


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, 1500).astype(float)
    y = np.round(x * 0.3 + rng.normal(0, 4, 1500), 1)
    g = rng.choice(["a", "b", "c"], 1500, p=[0.7, 0.2, 0.1])
    rows = [(float(a), float(b), str(c)) for a, b, c in zip(x, y, g)]
    return spark.createDataFrame(rows, "x double, y double, g string").cache(), x, y, g


@pytest.mark.parametrize("accuracy", [10_000, 50, 3])
def test_quantiles(data, monkeypatch, accuracy):
    """Narrow windows and windows too coarse to be trusted agree."""
    monkeypatch.setattr(ordered, "SKETCH_ACCURACY", accuracy)
    df, x, y, g = data
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    rows = {r["p"]: r["q"] for r in ordered.quantiles(df, "y", probs).collect()}
    assert rows == pytest.approx(dict(zip(probs, np.quantile(y, probs))))
    per_group = {(r["g"], r["p"]): r["q"] for r in ordered.quantiles(df, "y", [0.3], ["g"]).collect()}
    assert per_group == pytest.approx({(k, 0.3): np.quantile(y[g == k], 0.3) for k in "abc"})


def test_histogram_counts_and_edges(data):
    df, x, y, g = data
    counts, edges = np.histogram(y, bins=12)
    rows = uni.histogram(df, "y").orderBy("bin").collect()
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["left"] for r in rows] == pytest.approx(edges[:-1].tolist())
    assert uni.sturges(df).first()["classes"] == 12


def test_constant_column_has_one_class(spark):
    df = spark.createDataFrame([(2.0,)] * 4, "v double")
    rows = uni.histogram(df, "v", 3).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [4, 0, 0]


def test_weighted_statistics(data):
    df, x, y, g = data
    counts, edges = np.histogram(y, bins=12)
    mids = (edges[:-1] + edges[1:]) / 2
    hist = uni.histogram(df, "y", 12)
    row = uni.weighted_stats(hist).first()
    mean = np.average(mids, weights=counts)
    assert (row["mean"], row["variance"]) == pytest.approx((mean, np.average((mids - mean) ** 2, weights=counts)))
    at = (np.cumsum(counts) - 0.5 * counts) / counts.sum()
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r["p"]: r["q"] for r in uni.weighted_quantile(hist, probs).collect()}
    assert got == pytest.approx(dict(zip(probs, np.interp(probs, at, mids))))
    assert uni.expand_classes(hist).count() == 1500


def test_large_classes_expand_in_runs(spark):
    hist = spark.createDataFrame([(1.5, 25_001), (2.5, 0), (3.5, 10_000)], "mid double, n int")
    rows = {r["x"]: r["count"] for r in uni.expand_classes(hist).groupBy("x").count().collect()}
    assert rows == {1.5: 25_001, 3.5: 10_000}


def test_boxplot_keeps_the_group(data):
    df, x, y, g = data
    for r in uni.boxplot_stats(df, "y", ["g"]).collect():
        mine = y[g == r["g"]]
        q1, q2, q3 = np.quantile(mine, [0.25, 0.5, 0.75])
        inside = mine[(mine >= q1 - 1.5 * (q3 - q1)) & (mine <= q3 + 1.5 * (q3 - q1))]
        assert (r["median"], r["whisker_low"], r["whisker_high"]) == pytest.approx((q2, inside.min(), inside.max()))
        assert r["outliers"] == len(mine) - len(inside)
    total = uni.boxplot_stats(df, "y", ["g"]).agg(F.sum("outliers")).first()[0]
    assert uni.boxplot_outliers(df, "y", ["g"]).count() == total


def test_skewness_sign(spark):
    right = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 2, 2, 9]], "v double")
    assert uni.shape(right, "v").first()["skewness"] > 0


def test_all_modes(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,)], "v int")
    assert sorted(r["v"] for r in uni.modes(df, "v").collect()) == [1, 2]


def test_spearman(data):
    df, x, y, g = data

    def ranks(v):
        order = np.sort(v)
        return np.array([(np.searchsorted(order, a, "left") + np.searchsorted(order, a, "right") + 1) / 2 for a in v])

    want = np.corrcoef(ranks(x), ranks(y))[0, 1]
    row = bi.spearman_test(df, "x", "y").first()
    assert row["rho"] == pytest.approx(want) and row["p_value"] < 1e-6


# Critical values of the printed tables (fixed values).
@pytest.mark.parametrize("x, dof, p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (37.652484, 25, 0.05)])
def test_chi2_tail(x, dof, p):
    assert _chi2_tail(x, dof) == pytest.approx(p, abs=1e-7)


@pytest.mark.parametrize("t, dof, p", [(12.7062047, 1, 0.05), (4.3026527, 2, 0.05), (3.1824463, 3, 0.05), (2.5705818, 5, 0.05), (2.2281389, 10, 0.05), (2.0422725, 30, 0.05)])
def test_t_tail(t, dof, p):
    assert _t_two_sided(t, dof) == pytest.approx(p, abs=1e-7)


def test_chi_square_of_known_table(spark):
    cells = {("m", "y"): 30, ("m", "n"): 10, ("f", "y"): 15, ("f", "n"): 25}
    df = spark.createDataFrame([k for k, n in cells.items() for _ in range(n)], "a string, b string")
    plain = bi.chi_square(df, "a", "b", correction=False).first()
    assert plain["chi2"] == pytest.approx(80 * (30 * 25 - 10 * 15) ** 2 / (40 * 40 * 45 * 35)) and plain["dof"] == 1
    yates = bi.chi_square_test(df, "a", "b").first()
    assert yates["chi2"] == pytest.approx(80 * (abs(30 * 25 - 10 * 15) - 40) ** 2 / (40 * 40 * 45 * 35))
    simulated = bi.permutation_test(df, "a", "b", 4000).first()["p_value"]
    assert simulated < 0.01
    assert bi.permutation_test(df, "a", "b", 4000).first()["p_value"] == simulated


def test_permutation_agrees_with_chi_square(data):
    df, *_ = data
    df = df.withColumn("h", F.when(F.col("y") > 6, "hi").otherwise("lo"))
    p = bi.chi_square_test(df, "g", "h", correction=False).first()["p_value"]
    assert bi.permutation_test(df, "g", "h", 3000).first()["p_value"] == pytest.approx(p, abs=0.05)


def test_hypergeometric_draws():
    """Moments of the sampler, in a small population and in one beyond 32 bits, and exact corner cases."""
    for good, bad, size in ((30, 70, 20), (4 * 10**9, 6 * 10**9, 10**6), (3, 10**12, 10**6), (70, 30, 90)):
        rng = np.random.default_rng(1)
        drawn = np.array([bi._hypergeometric(rng, good, bad, size) for _ in range(20_000)])
        share, total = good / (good + bad), good + bad
        spread = (size * share * (1 - share) * (total - size) / (total - 1)) ** 0.5
        assert abs(drawn.mean() - size * share) < 5 * spread / len(drawn) ** 0.5
        assert spread < 0.01 or abs(drawn.std() / spread - 1) < 0.05
        assert drawn.min() >= max(0, size - bad) and drawn.max() <= min(good, size)
    rng = np.random.default_rng(2)
    assert [bi._hypergeometric(rng, *a) for a in ((0, 5, 3), (5, 0, 3), (5, 5, 0), (5, 5, 10))] == [0, 3, 0, 5]


def test_tail_probabilities():
    from lodestar.functions import pvalues

    assert pvalues._t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-9)
    assert pvalues._t_two_sided(3.5, 1001) == pytest.approx(0.000485753569, rel=1e-8)
    assert pvalues._chi2_tail(18.307038053, 10) == pytest.approx(0.05, abs=1e-9)
    assert pvalues._chi2_tail(5.0, 2) == pytest.approx(np.exp(-2.5))


def test_quantiles_of_several_columns(spark, monkeypatch):
    """All columns side by side, with nulls, ties and a column of nulls; also where a window misses its quantile."""
    rng = np.random.default_rng(8)
    rows = [(float(rng.integers(0, 5)), None if i % 3 else float(rng.normal()), None) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    probs = {"q1": 0.25, "q2": 0.5, "q9": 0.93}
    columns = {c: [r[i] for r in rows if r[i] is not None] for i, c in enumerate("ab")}
    want = {c: np.quantile(v, list(probs.values())).tolist() for c, v in columns.items()}
    for accuracy in (ordered.SKETCH_ACCURACY, 10**9):  # the second one's windows hold one value, so quantiles between two are missed
        monkeypatch.setattr(ordered, "SKETCH_ACCURACY", accuracy)
        found = {r["column"]: [r[p] for p in probs] for r in ordered.quantile_table(df, ["a", "b", "c"], probs).collect()}
        assert found.keys() == want.keys() and all(found[c] == pytest.approx(want[c]) for c in want)
