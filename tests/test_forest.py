"""Forests against trees grown row by row, their bags, and the jobs they take."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import forest, learn

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 600
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 30, n) / 4, rng.integers(0, 2, n)]).astype(float)
    y = np.round(x[:, 0] * x[:, 2] - x[:, 1] + rng.normal(0, 1, n), 3)
    kind = ((x[:, 0] > 5).astype(int) + (x[:, 1] > 3)) * (rng.random(n) < 0.9)
    table = [(i, *map(float, v), float(t), float(k)) for i, (v, t, k) in enumerate(zip(x, y, kind))]
    frame = spark.createDataFrame(table, "id long, a double, b double, c double, y double, kind double")
    return learn.assemble(frame, FEATURES).cache(), x, y, kind


def _grown(x, y, classes, depth):
    """Prediction of a tree for its own rows: the best of all splits, the first of equal ones, as long as it gains."""

    def loss(v):
        return len(v) - sum((v == c).sum() ** 2 for c in set(v)) / len(v) if classes else ((v - v.mean()) ** 2).sum()

    best = (1e-9, None)
    for k in range(x.shape[1] if depth else 0):
        values = np.unique(x[:, k])
        for at in (values[1:] + values[:-1]) / 2:
            low = x[:, k] <= at
            gain = loss(y) - loss(y[low]) - loss(y[~low])
            if gain > best[0] + 1e-9:
                best = (gain, low)
    out = np.empty(len(y))
    if best[1] is None:
        out[:] = np.bincount(y.astype(int)).argmax() if classes else y.mean()
    else:
        for part in (best[1], ~best[1]):
            out[part] = _grown(x[part], y[part], classes, depth - 1)
    return out


@pytest.mark.parametrize("depth", [0, 3, 30])
def test_one_tree_is_that_of_all_splits(rows, depth):
    df, x, y, kind = rows
    for label, truth, classes in (("y", y, False), ("kind", kind, True)):
        model = forest.fit(df, label, 1, depth, 1, classes)
        got = [r["prediction"] for r in model.transform(df).orderBy("id").collect()]
        assert got == pytest.approx(_grown(x, truth.astype(float), classes, depth))


def test_full_forests_take_few_jobs(spark, rows):
    """300 trees of depth 30 were several jobs per level and group of nodes."""
    df, _, y, kind = rows
    for name, fit, label in (("number", learn.random_forest("y"), "y"), ("class", learn.forest_classifier("kind"), "kind")):
        spark.sparkContext.setJobGroup(f"forest-{name}", name)
        try:
            model = fit(df)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"forest-{name}")) < 20
        assert len(model.trees) == 300 and len({len(t[0]) for t in model.trees}) > 1
        fitted = np.array([r["prediction"] for r in model.transform(df).orderBy("id").collect()])
        assert ((fitted - y) ** 2).mean() < 0.6 * y.var() if label == "y" else (fitted == kind).mean() > 0.85


def test_bags_hold_every_row_once_on_average(rows):
    df, *_ = rows
    model = forest.fit(df, "y", 200, 0, 5)
    means = np.array([t[3][0, 0] for t in model.trees])
    y = rows[2]
    assert abs(means.mean()) < 5 * y.std() / len(y) ** 0.5 / len(means) ** 0.5  # next to the mean of all rows
    assert means.std() == pytest.approx(y.std() / len(y) ** 0.5, rel=0.25)


def test_a_forest_does_not_depend_on_where_rows_lie(rows, monkeypatch):
    df, *_ = rows
    predicted = lambda some: [r["prediction"] for r in forest.fit(some, "y", 20, 30, 9).transform(df).orderBy("id").collect()]
    once = predicted(df)
    assert predicted(df.repartition(7, F.rand(3))) == pytest.approx(once)
    monkeypatch.setattr(forest, "HELD", 500)  # sums handed over many times, draws and comparisons in small pieces
    monkeypatch.setattr(forest, "ROWS", 7)
    monkeypatch.setattr(forest, "COMPARED", 64)
    assert predicted(df) == pytest.approx(once)


def test_many_values_are_cut_at_quantiles(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, 5000)
    frame = learn.assemble(spark.createDataFrame([(float(v), float(k % 50 == 0), float(v > 0.5)) for k, v in enumerate(x)], "a double, b double, y double"), ["a", "b"])
    ends = forest.thresholds(frame.select(forest.vector_to_array("features").alias("v")), 2)
    assert list(ends[1]) == [0.5]  # a rare value keeps its bin
    assert len(ends[0]) == forest.BINS - 1
    np.testing.assert_allclose([(x <= t).mean() for t in ends[0]], np.arange(1, forest.BINS) / forest.BINS, atol=2e-3)
    model = forest.fit(frame, "y", 30, 5, 1)
    assert model.transform(frame).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 0.05


def test_labels_that_are_none(spark):
    frame = lambda rows: learn.assemble(spark.createDataFrame(rows, "a double, y double"), ["a"])
    for rows, classes in (([(1.0, 2.0), (2.0, None)], False), ([(1.0, float("nan")), (2.0, 1.0)], False), ([(1.0, 0.5), (2.0, 1.0)], True), ([(1.0, -1.0)], True)):
        with pytest.raises(Exception, match="labels that are missing"):
            forest.fit(frame(rows), "y", 3, 2, 1, classes)
    with pytest.raises(ValueError, match="no rows"):
        forest.fit(frame([(1.0, 1.0)]).filter("a > 5"), "y", 3, 2, 1)
