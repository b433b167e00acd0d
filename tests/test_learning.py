import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestar.operators import centres, cluster, dbscan, graph, learn, metric, mixture, radii, tiles, ward


@pytest.fixture(scope="module")
def study(spark):
    rng = np.random.default_rng(11)
    n = 400
    a, b, c = rng.normal(0, 1, n), rng.normal(5, 3, n), rng.integers(0, 2, n).astype(float)
    y = 3 * a - 2 * b + c + rng.normal(0, 1, n)
    rows = [(i, *map(float, v)) for i, v in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").cache(), np.column_stack([a, b, c]), y


FEATURES = ["a", "b", "c"]


def test_leave_one_out_error(study):
    df, x, y = study
    z = (x - x.mean(0)) / x.std(0)
    alphas = [0.01, 1.0, 100.0]
    got = {r["alpha"]: r["loo_mse"] for r in learn.ridge_grid(df, FEATURES, "y", alphas).collect()}
    for alpha in alphas:
        errors = []
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            # The intercept is free of the penalty.
            design = np.column_stack([np.ones(keep.sum()), z[keep]])
            penalty = alpha * np.diag([0, 1, 1, 1])
            w = np.linalg.solve(design.T @ design + penalty, design.T @ y[keep])
            errors.append((y[i] - w @ np.concatenate([[1], z[i]])) ** 2)
        assert got[alpha] == pytest.approx(np.mean(errors))


def test_models_find_the_line(study):
    df, *_ = study
    table = learn.model_table(
        {
            "linear": learn.cv_scores(df, learn.linear("y"), FEATURES, "y", "id"),
            "ridge": learn.cv_scores(df, learn.ridge("y", FEATURES, learn.log_spaced(-3, 3, 5)), FEATURES, "y", "id"),
            "lasso": learn.cv_scores(df, learn.lasso("y", 0.01), FEATURES, "y", "id"),
            "poly": learn.cv_scores(df, learn.poly2("y"), FEATURES, "y", "id"),
            "forest": learn.cv_scores(df, learn.random_forest("y", trees=20), FEATURES, "y", "id"),
        }
    ).collect()
    scores = {r["model"]: r["r2"] for r in table}
    assert [r["r2"] for r in table] == sorted(scores.values(), reverse=True)
    assert all(v > 0.95 for k, v in scores.items() if k != "forest") and scores["forest"] > 0.7


def test_lasso_matches_the_textbook_objective(study):
    """Coordinate descent on 1/(2n)·|y - Zw|² + alpha·|w| with standardised inputs."""
    df, x, y = study
    z = (x - x.mean(0)) / x.std(0)
    target, w, alpha = y - y.mean(), np.zeros(3), 0.5
    for _ in range(500):
        for j in range(3):
            rho = z[:, j] @ (target - z @ w + z[:, j] * w[j]) / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0)
    model = learn.lasso("y", alpha)(learn.assemble(learn.standardize(df, FEATURES), FEATURES))
    assert model.coefficients.toArray() == pytest.approx(w, abs=0.01)


def test_coefficients_and_residuals(study):
    df, x, y = study
    model = learn.linear("y")(learn.assemble(df, FEATURES))
    rows = learn.coef_table(df, model, FEATURES).collect()
    assert [r["feature"] for r in rows] == ["a", "b", "c"]
    pred = model.transform(learn.assemble(df, FEATURES))
    stats = learn.residual_stats(pred, "y").first()
    assert stats["mean"] == pytest.approx(0, abs=1e-9) and stats["std"] == pytest.approx(1, abs=0.15)
    assert learn.test_metrics(pred, "y").first()["r2"] > 0.95


def test_folds_do_not_move(study):
    df, *_ = study
    one = {r["id"]: r["fold"] for r in learn.folds(df, "id").collect()}
    two = {r["id"]: r["fold"] for r in learn.folds(df.repartition(3), "id").collect()}
    assert one == two and set(one.values()) == set(range(5))


def test_first_category_is_dropped(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "g string")
    out = learn.dummies(df, {"g": ["c", "a", "b"]})
    assert out.columns == ["g_b", "g_c"]
    assert [tuple(r) for r in out.collect()] == [(1, 0), (0, 0), (0, 1), (0, 0)]
    sparse = learn.one_hot(df, ["g"])
    assert {r["g"]: tuple(r["features"]) for r in sparse.collect()} == {"c": (1, 0), "b": (0, 1), "a": (0, 0), None: (0, 0)}


# --- clustering -----------------------------------------------------------------------------


def _frame(spark, x, **more):
    rows = [(i, [float(v) for v in p], *[int(col[i]) for col in more.values()]) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id long, x array<double>" + "".join(f", {c} int" for c in more))


def _distances(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))


def _brute_dbscan(x, eps, min_samples):
    near = _distances(x) <= eps
    core = near.sum(1) >= min_samples
    root = np.where(core, np.arange(len(x)), len(x))
    changed = True
    while changed:
        best = np.array([min([root[i]] + [root[j] for j in np.flatnonzero(near[i] & core)]) if core[i] else root[i] for i in range(len(x))])
        changed = (best != root).any()
        root = best
    label = np.array([root[i] if core[i] else min([root[j] for j in np.flatnonzero(near[i] & core)], default=-1) for i in range(len(x))])
    names = {r: k for k, r in enumerate(sorted(set(label) - {-1}))}
    return [names.get(v, -1) for v in label]


def _blobs(rng, d, n=260):
    """Two moon-like strips, one very dense spot, many exact copies, and scattered noise."""
    t = rng.uniform(0, np.pi, n // 3)
    a = np.column_stack([np.cos(t), np.sin(t)] + [np.zeros_like(t)] * (d - 2))[:, :d]
    b = np.column_stack([1 - np.cos(t), 0.4 - np.sin(t)] + [np.zeros_like(t)] * (d - 2))[:, :d]
    spot = np.full((n // 3, d), 2.5) + rng.normal(0, 0.03, (n // 3, d))
    copies = np.repeat(np.full((1, d), -1.5), 30, axis=0)
    noise = rng.uniform(-2, 3, (25, d))
    x = np.concatenate([a + rng.normal(0, 0.03, a.shape), b + rng.normal(0, 0.03, b.shape), spot, copies, noise])
    return x[rng.permutation(len(x))]


@pytest.mark.parametrize("d, eps, min_samples, seed", [(1, 0.05, 4, 1), (2, 0.15, 5, 2), (2, 0.3, 12, 3), (3, 0.2, 4, 4), (4, 0.25, 4, 5)])
def test_dbscan_equals_brute_force(spark, monkeypatch, d, eps, min_samples, seed):
    monkeypatch.setattr(dbscan, "SLOT_POINTS", 10)
    x = _blobs(np.random.default_rng(seed), d)
    rows = dbscan.dbscan(_frame(spark, x), eps, min_samples, d).collect()
    got = [r["cluster"] for r in sorted(rows, key=lambda r: r["id"])]
    assert got == _brute_dbscan(x, eps, min_samples)


def test_dense_cells_link_only_when_points_touch(spark):
    """Two full cells side by side whose nearest points are just inside or just outside eps."""
    rng = np.random.default_rng(8)
    eps = 1.0
    left = rng.uniform([0.0, 0.0], [0.2, 0.6], (80, 2))
    for gap, clusters in ((0.999, 1), (1.001, 2)):
        right = rng.uniform([0.0, 0.0], [0.2, 0.6], (80, 2))
        edge_l, edge_r = np.array([[0.2, 0.3]]), np.array([[0.2 + gap, 0.3]])
        right = right + [0.2 + gap + 0.05, 0.0]
        x = np.concatenate([left, edge_l, edge_r, right])
        assert set(_brute_dbscan(x, eps, 5)) == set(range(clusters))
        rows = dbscan.dbscan(_frame(spark, x), eps, 5, 2).collect()
        assert {r["cluster"] for r in rows} == set(range(clusters))


def test_dense_slots_link_by_parts(spark, monkeypatch):
    """Cells cut into small slots: parts grow together across slots and cells, in any number of dimensions."""
    monkeypatch.setattr(metric, "SLOT", 10)
    monkeypatch.setattr(metric.build, "__defaults__", (24, 8192, 42))
    x = _blobs(np.random.default_rng(7), 6)
    rows = dbscan.dbscan(_frame(spark, x), 0.3, 6, 6).collect()
    assert [r["cluster"] for r in sorted(rows, key=lambda r: r["id"])] == _brute_dbscan(x, 0.3, 6)


def test_core_points(spark):
    x = _blobs(np.random.default_rng(9), 3)
    n = (_distances(x) <= 0.2).sum(1)
    got = {r["id"]: r["neighbours"] for r in dbscan.core_points(_frame(spark, x), 0.2, 5).collect()}
    assert got == {i: c for i, c in enumerate(n) if c >= 5}


def _kruskal(edges):
    root, kept = {}, []

    def find(v):
        while root.get(v, v) != v:
            v = root[v]
        return v

    for w, a, b in sorted((w, min(a, b), max(a, b)) for a, b, w in edges):
        if find(a) != find(b):
            root[find(a)] = find(b)
            kept.append((a, b, w))
    return sorted(kept)


def test_spanning_forest(spark):
    rng = np.random.default_rng(3)
    for n, m in ((2, 1), (12, 30), (40, 90)):
        pairs = {(min(a, b), max(a, b)) for a, b in rng.integers(0, n, (m, 2)).tolist() if a != b} | {(0, 1)}
        edges = [(a, b, float(rng.integers(0, 4))) for a, b in sorted(pairs)]
        a, b, w = map(np.array, zip(*edges))
        kept = radii.local_forest(a, b, w)
        assert sorted(zip(a[kept].tolist(), b[kept].tolist(), w[kept].tolist())) == _kruskal(edges)
    both = edges + [(b, a, w + 1) for a, b, w in edges] + [(5, 5, 0.0)]
    got = graph.spanning_forest(spark.createDataFrame(both, "src long, dst long, weight double")).collect()
    assert sorted(map(tuple, got)) == _kruskal(edges)
    assert graph.spanning_forest(spark.createDataFrame([], "src long, dst long, weight double")).count() == 0


def test_grid_equals_single_runs(spark, monkeypatch):
    """Every pair of the grid: the clusters, the noise and all labels of a run of its own."""
    monkeypatch.setattr(metric.build, "__defaults__", (24, 8192, 42))
    df = _frame(spark, _blobs(np.random.default_rng(2), 2))
    x = np.array([r["x"] for r in sorted(df.collect(), key=lambda r: r["id"])])
    eps_list, counts = [0.1, 0.2, 0.4, 0.6], [1, 4, 12]
    table, chosen = radii.label_grid(df, eps_list, counts, (1, 40), 0.9)
    found = {(r["pair"], r["id"]): r["label"] for r in df.join(table, "x").collect()}
    want = {}
    for eps in eps_list:
        for m in counts:
            label = np.array(_brute_dbscan(x, eps, m))
            if 1 <= label.max() + 1 <= 40 and (label < 0).sum() < 0.9 * len(x):
                want[eps, m] = label
    assert {c[:2]: c[2:] for c in chosen} == {p: (label.max() + 1, (label < 0).sum()) for p, label in want.items()}
    for k, (eps, m, *_) in enumerate(chosen):
        roots = [found.get((k, i), -1) for i in range(len(x))]
        names = {r: n for n, r in enumerate(sorted(set(roots) - {-1}))}
        assert [names.get(r, -1) for r in roots] == want[eps, m].tolist()
    best = radii.dbscan_grid(df, eps_list, counts, top=3).collect()
    assert [r["silhouette"] for r in best] == sorted((r["silhouette"] for r in best), reverse=True)
    for r in best:
        label = want[r["eps"], r["min_samples"]]
        assert r["silhouette"] == pytest.approx(_brute_silhouette(x, label, squared=True)) and 2 <= r["n_clusters"] <= 5
    plain = radii.dbscan_grid(df, [0.6], [12], plain=True).collect()
    assert [r["silhouette"] for r in plain] == [pytest.approx(_brute_silhouette(x, want[0.6, 12]))]
    assert radii.dbscan_grid(df, [1e-9], [5]).collect() == []


def _brute_silhouette(x, label, squared=False):
    keep = label >= 0
    x, label = x[keep], label[keep]
    dist = _distances(x) ** (2 if squared else 1)
    scores = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = dist[i, own].sum() / (own.sum() - 1)
        b = min(dist[i, label == c].mean() for c in set(label) - {label[i]})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


@pytest.mark.parametrize("block", [5000, 37])
def test_silhouette_by_blocks(spark, monkeypatch, block):
    rng = np.random.default_rng(4)
    x, label = rng.normal(0, 1, (150, 3)), rng.integers(-1, 4, 150)
    label[0] = 9
    df = _frame(spark, x, label=label)
    monkeypatch.setattr(tiles.tile_join, "__defaults__", (block,))
    row = cluster.silhouette(df, "label").first()
    assert row["n"] == (label >= 0).sum() and row["silhouette"] == pytest.approx(_brute_silhouette(x, label))
    sampled = cluster.silhouette(df, "label", sample=20).first()
    assert sampled["n"] == 20
    wide = _frame(spark, x).withColumn("label", F.pmod("id", F.lit(40)))  # more labels than one product takes
    assert cluster.silhouette(wide, "label").first()["silhouette"] == pytest.approx(_brute_silhouette(x, np.arange(len(x)) % 40))


def test_silhouette_copies_rows_to_few_blocks(spark, monkeypatch):
    """At most eight small blocks, then blocks grow: 20 blocks of 20 rows would copy every row 20 times."""
    monkeypatch.setattr(tiles, "SMALL_ROWS", 20)
    rows = _frame(spark, np.random.default_rng(8).normal(0, 1, (400, 3)))
    tiled = tiles.tile_join(rows, rows, lambda q, pairs: pd.DataFrame({"n": [len(q) * sum(len(p) for p, _ in pairs)]}), "n long")
    assert tiled.agg(F.sum("n")).first()[0] == 400 * 400 and tiled.agg(F.count("n")).first()[0] <= 64 * 2


@pytest.mark.parametrize("n, d, cells", [(600, 2, 16), (300, 5, 64), (30, 3, 256)])
def test_k_distance(spark, monkeypatch, n, d, cells):
    monkeypatch.setattr(metric.build, "__defaults__", (cells, 8192, 42))
    monkeypatch.setattr(metric, "SLOT", 50)
    monkeypatch.setattr(metric, "TASK_QUERIES", 40)
    x = np.round(np.random.default_rng(4).normal(0, 1, (n, d)), 2)
    x[: n // 5] = x[0]
    df = _frame(spark, x)
    for k in (4, 40):
        got = [r["distance"] for r in cluster.k_distance(df, k).collect()]
        assert got == pytest.approx(np.sort(np.sort(_distances(x), axis=1)[:, k - 1]).tolist() if k <= n else [])
    assert cluster.k_distance(df, 4, sample=9).count() == 9 and cluster.k_distance(df.limit(0), 4).count() == 0


def test_queries_visit_few_cells(spark, monkeypatch):
    """In the plane a small radius reaches into the neighbouring cells only."""
    monkeypatch.setattr(metric.build, "__defaults__", (20, 8192, 42))
    x = np.random.default_rng(4).uniform(0, 1, (4000, 2))
    index = metric.build(_frame(spark, x))
    share = metric.visited_share(index, index.within(index.table.select("x", "cell"), 0.01))
    assert len(index.cells.weight) == 200 and share < 0.05


def test_visits_leave_a_task_in_small_pieces(spark):
    """Rows that visit every cell must not become one frame of all their visits, and there are not many cells where bounds rule out little."""
    x = np.random.default_rng(5).normal(0, 1, (5000, 12))
    index = metric.build(_frame(spark, x))
    assert len(index.cells.weight) == 3
    part = pd.DataFrame({"i": np.arange(4000), "x": list(x[:4000])})
    which, to = np.nonzero(np.ones((4000, 3)))
    pieces = list(index.cells.spread(part, which, to))
    assert max(map(len, pieces)) <= metric.VISITS
    seen = pd.concat(pieces)
    assert len(seen) == 4000 * index.cells.slots.sum() == len(seen.drop_duplicates(["i", "to", "slot"]))


def test_distances_by_matrix_product():
    """Lattice points far from the origin: ties with a limit, copies and near copies are told as by the sum over dimensions."""
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 3, (70, 20)) + 1e5, rng.integers(0, 3, (300, 20)) + 1e5
    b[:5] = a[:5]
    b[5:10] = a[5:10] + 1e-7
    want = ((a[:, None] - b[None]) ** 2).sum(2)
    for limits in ([20.0], [17.0, 20.0, 23.0]):
        got = metric.squared_distances(a, b, limits)
        np.testing.assert_allclose(got, want, rtol=1e-9)
        assert all(((got <= v) == (want <= v)).all() for v in limits)
    far = b.copy()
    far[-1] = 1e12
    np.testing.assert_allclose(metric.squared_distances(a, far), ((a[:, None] - far[None]) ** 2).sum(2), rtol=1e-9)


def test_agreement_measures(spark):
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 4, 200), rng.integers(0, 3, 200)
    df = _frame(spark, np.zeros((200, 1)), a=a, b=b).withColumn("c", F.col("a") * 10 + 3)
    assert cluster.ari(df, "a", "c").first()["ari"] == pytest.approx(1)
    assert cluster.nmi(df, "a", "c").first()["nmi"] == pytest.approx(1)
    table = np.array([[((a == i) & (b == j)).sum() for j in range(3)] for i in range(4)])
    pairs = lambda v: (v * (v - 1) / 2).sum()
    chance = pairs(table.sum(1)) * pairs(table.sum(0)) / pairs(np.array([200]))
    want = (pairs(table) - chance) / ((pairs(table.sum(1)) + pairs(table.sum(0))) / 2 - chance)
    assert cluster.ari(df, "a", "b").first()["ari"] == pytest.approx(want)


@pytest.fixture(scope="module")
def groups(spark):
    rng = np.random.default_rng(7)
    truth = np.repeat([0, 1, 2], 50)
    return _frame(spark, rng.normal(0, 0.3, (150, 2)) + np.array([[0, 0], [4, 0], [0, 4]])[truth], truth=truth).cache()


def test_methods_find_separate_groups(groups):
    table = cluster.compare_methods(
        {"k-means": cluster.kmeans_labels(groups, cluster.kmeans(groups, 3, seeds=2)), "ward": ward.ward(groups, 3),
         "density": dbscan.dbscan(groups, 0.6, 5, 2)}, "cluster", "truth")
    rows = {r["method"]: r for r in table.collect()}
    assert all(r["ari"] > 0.9 and r["nmi"] > 0.8 and r["clusters"] == 3 for r in rows.values())
    assert rows["ward"]["noise_share"] == 0


def test_sweep_finds_the_number_of_groups(groups):
    sweep = cluster.kmeans_sweep(groups, [2, 3, 4], seeds=2).collect()
    assert [r["inertia"] for r in sweep] == sorted((r["inertia"] for r in sweep), reverse=True)
    assert max(sweep, key=lambda r: r["silhouette"])["k"] == 3


def test_mixture_finds_separate_groups(groups):
    model = cluster.gmm(groups, 3)
    assert cluster.ari(cluster.gmm_labels(groups, model), "cluster", "truth").first()["ari"] > 0.9
    assert cluster.gmm_bic(groups, [2, 3]).orderBy("bic").first()["k"] == 3


def test_mixture_steps_like_the_textbook(spark):
    """A few steps from the same start against responsibilities written out, with fewer rows than dimensions in a component."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (40, 5)) + 50, rng.normal(4, 2, (4, 5)) + 50])
    df = _frame(spark, x)
    start = mixture.Mixture(np.array([0.5, 0.5]), x[[0, 43]], np.stack([np.eye(5)] * 2))
    model = start
    for _ in range(3):
        model = mixture._step(df, model, 1e-6, hard=False)
    weights, means, covs = start.weights, start.means, start.covariances
    for _ in range(3):
        gaps = x[:, None] - means
        power = -0.5 * np.einsum("nki,kij,nkj->nk", gaps, np.linalg.inv(covs), gaps)
        p = weights * np.exp(power) / np.sqrt(np.linalg.det(2 * np.pi * covs))
        likelihood, r = np.log(p.sum(1)).sum(), p / p.sum(1, keepdims=True)
        weights, means = r.mean(0), (r.T @ x) / r.sum(0)[:, None]
        gaps = x[:, None] - means
        covs = np.einsum("nk,nki,nkj->kij", r, gaps, gaps) / r.sum(0)[:, None, None] + 1e-6 * np.eye(5)
    assert model.weights == pytest.approx(weights) and model.means == pytest.approx(means) and model.log_likelihood == pytest.approx(likelihood)
    assert model.covariances == pytest.approx(covs, rel=1e-6, abs=1e-7)


def _brute_ward(x, k):
    """Merge the cheapest pair, one at a time."""
    groups, mean, size = [[i] for i in range(len(x))], x.copy(), np.ones(len(x))
    alive = np.ones(len(x), bool)
    for _ in range(len(x) - k):
        cost = size[:, None] * size / (size[:, None] + size) * _distances(mean) ** 2
        cost[~alive], cost[:, ~alive] = np.inf, np.inf
        np.fill_diagonal(cost, np.inf)
        a, b = sorted(np.unravel_index(cost.argmin(), cost.shape))
        mean[a] = (size[a] * mean[a] + size[b] * mean[b]) / (size[a] + size[b])
        size[a] += size[b]
        groups[a] += groups[b]
        alive[b] = False
    return {frozenset(groups[i]) for i in np.flatnonzero(alive)}


@pytest.mark.parametrize("per_cell", [1000, 20])
def test_ward_equals_the_definition(spark, monkeypatch, per_cell):
    monkeypatch.setattr(ward, "CELL_GROUPS", per_cell)
    x = np.random.default_rng(1).normal(0, 1, (100, 3))
    x[:10] = x[0]
    got = {}
    for r in ward.ward(_frame(spark, x), 5).collect():
        got.setdefault(r["cluster"], set()).add(r["id"])
    assert sorted(got) == list(range(5)) and set(map(frozenset, got.values())) == _brute_ward(x, 5)


@pytest.mark.parametrize("last", [60, 1000])
def test_ward_in_many_dimensions_equals_the_definition(spark, monkeypatch, last):
    """Also of groups whose nearest are found in blocks by Spark."""
    monkeypatch.setattr(ward, "LAST_GROUPS", last)
    x = np.random.default_rng(6).normal(0, 1, (120, 12))
    x[:10] = x[0]
    got = {}
    for r in ward.ward(_frame(spark, x), 5).collect():
        got.setdefault(r["cluster"], set()).add(r["id"])
    assert sorted(got) == list(range(5)) and set(map(frozenset, got.values())) == _brute_ward(x, 5)


def test_ward_ends_where_many_pairs_cost_the_same():
    corners = np.array([[(i >> bit) & 1 for bit in range(9)] for i in range(64)], float)
    tree = ward._merge_all(pd.DataFrame({"i": np.arange(64), "x": list(corners), "w": 1, "h": 0.0}))
    assert sorted(tree["b"]) == list(range(1, 64)) and (tree["a"] < tree["b"]).all() and tree["height"].min() == 0.5


def test_ward_rules_out_by_rounded_products_only_what_is_dearer():
    rng = np.random.default_rng(7)
    for size, shift in ((1e-20, 0.0), (1.0, 1e5), (1e25, 0.0)):
        x = (rng.normal(0, 1, (300, 20)) + shift) * size
        x[1], x[2] = x[0], x[0]
        w = rng.integers(1, 50, 300).astype(float)
        number = rng.permutation(300)
        found = ward._least_pairs(number[:90], x[:90], w[:90], number, x, w).set_index("i")
        cost = ward.growth(w[:, None], w[None, :], metric._by_dimension(x, x))
        np.fill_diagonal(cost, np.inf)
        for row in range(90):
            assert found.loc[number[row], "cost"] == cost[row].min()
            pairs = [tuple(sorted((number[row], number[j]))) for j in np.flatnonzero(cost[row] == cost[row].min())]
            assert tuple(found.loc[number[row], ["a", "b"]].astype(int)) == min(pairs)


def test_ward_of_few_points(spark):
    df = _frame(spark, np.array([[0.0], [0.0], [1.0]]))
    assert sorted(map(tuple, ward.ward(df, 5).select("id", "cluster").collect())) == [(0, 0), (1, 0), (2, 1)]
    assert {r["cluster"] for r in ward.ward(df, 1).collect()} == {0}


def test_pca_of_centred_points(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (100, 4)) * [3, 2, 1, 0.5] + 10
    rows = sorted(cluster.pca2(_frame(spark, x)).collect(), key=lambda r: r["id"])
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    signs = np.sign(vt[np.arange(4), np.abs(vt).argmax(1)])
    want = ((x - x.mean(0)) @ vt.T * signs)[:, :2]
    assert np.array([[r["pc1"], r["pc2"]] for r in rows]) == pytest.approx(want)


def test_fits_run_side_by_side(spark, monkeypatch):
    """The starts of all k are handed out together; the model with the least inertia of each k stays."""
    x = np.random.default_rng(9).normal(0, 1, (90, 3))
    data = cluster.with_vector(_frame(spark, x)).persist()
    one_by_one = {(k, s): cluster.KMeans(k=k, seed=s, maxIter=300).fit(data).summary.trainingCost for k in (2, 3) for s in (42, 43)}
    sizes = []

    class Pool(cluster.ThreadPoolExecutor):
        def map(self, fn, starts):
            sizes.append(len(starts))
            return super().map(fn, starts)

    monkeypatch.setattr(cluster, "ThreadPoolExecutor", Pool)
    sweep = cluster.kmeans_sweep(_frame(spark, x), [2, 3], seeds=2).collect()
    assert sizes == [4]
    assert [r["inertia"] for r in sweep] == pytest.approx([min(one_by_one[k, 42], one_by_one[k, 43]) for k in (2, 3)])
    data.unpersist()


def test_starts_move_in_the_same_passes(spark, monkeypatch):
    """A round serves all starts that still move, and each ends where Spark's own iteration does."""
    x = np.random.default_rng(19).normal(0, 1, (300, 3)) + 1000
    df = _frame(spark, x)
    data = cluster.with_vector(df).persist()
    whole = [cluster.KMeans(k=k, seed=s, maxIter=300).fit(data) for k in (2, 4) for s in (1, 2, 3)]
    first = [np.array(cluster.KMeans(k=k, seed=s, maxIter=0).fit(data).clusterCenters()) for k in (2, 4) for s in (1, 2, 3)]
    moved, once = [], centres._round

    def counted(rows, now):
        moved.append(len(now))
        return once(rows, now)

    monkeypatch.setattr(centres, "_round", counted)
    found = centres.lloyd(centres.blocks(df), first)
    assert moved[0] == 6 and moved == sorted(moved, reverse=True) and sum(moved) > len(moved)
    for model, got in zip(whole, found):
        assert got.centres == pytest.approx(np.array(model.clusterCenters()), abs=1e-6)
        assert got.inertia == pytest.approx(model.summary.trainingCost, rel=1e-6)
    want = cluster.with_vector(df).select("id", "features")
    want = {r["id"]: r["prediction"] for r in whole[4].transform(want).collect()}
    assert {r["id"]: r["cluster"] for r in cluster.kmeans_labels(df, found[4]).collect()} == want
    data.unpersist()


def test_centres_without_rows_stay(spark):
    found = centres.lloyd(centres.blocks(_frame(spark, np.array([[0.0], [1.0]]))), [np.array([[0.0], [50.0]]), np.array([[0.5]])])
    assert [f.centres.ravel().tolist() for f in found] == [[0.5, 50.0], [0.5]] and [f.inertia for f in found] == [0.5, 0.5]


def test_a_mixture_packs_its_rows_once(groups, monkeypatch):
    packed, pack = [], centres.blocks
    monkeypatch.setattr(centres, "blocks", lambda pts: packed.append(1) or pack(pts))
    assert mixture.fit(groups, 3).steps > 2 and packed == [1]


def test_methods_are_fitted_side_by_side(groups):
    """Labellings given as functions meet while they run; the table keeps their order."""
    meet = threading.Barrier(3, timeout=120)

    def labels(fit):
        meet.wait()
        return fit()

    table = cluster.compare_methods(
        {"ward": lambda: labels(lambda: ward.ward(groups, 3)), "mixture": lambda: labels(lambda: cluster.gmm_labels(groups, cluster.gmm(groups, 3))),
         "density": lambda: labels(lambda: dbscan.dbscan(groups, 0.6, 5, 2)), "truth": groups.withColumn("cluster", F.col("truth"))}, "cluster", "truth")
    rows = table.collect()
    assert [r["method"] for r in rows] == ["ward", "mixture", "density", "truth"]
    assert all(r["ari"] > 0.9 and r["clusters"] == 3 for r in rows)


def test_small_files_are_dealt_over_the_cores(spark, monkeypatch):
    monkeypatch.setattr(learn, "SPREAD_ROWS", 10)
    rows = spark.range(0, 35, 1, 1)
    dealt = learn.spread(rows)
    assert dealt.rdd.getNumPartitions() == 4 and dealt.count() == 35
    assert learn.spread(spark.range(0, 9, 1, 1)).rdd.getNumPartitions() == 1
    seen = []

    def fit(train):
        seen.append(train.rdd.getNumPartitions())
        return learn.stump("y")(train)

    frame = rows.select("id", F.col("id").cast("double").alias("y"), (F.col("id") % 3).alias("a"))
    learn.cv_scores(frame, fit, ["a"], "y", "id", k=2, fold=F.col("id") % 2)
    assert min(seen) > 1


def test_wide_queries_are_copied_once_per_block(spark, monkeypatch):
    """In many dimensions a query that visits every cell goes to few blocks of them, and what it finds is what is there."""
    for name, value in (("SLOT", 10), ("BLOCK", 100), ("LEAST_BLOCKS", 2), ("FOLD", 30), ("HELD", 2000), ("TASK_QUERIES", 150)):
        monkeypatch.setattr(metric, name, value, raising=False)
    monkeypatch.setattr(metric.build, "__defaults__", (10, 8192, 42))
    rng = np.random.default_rng(12)
    x = np.round(np.concatenate([rng.normal(0, 1, (300, 12)), rng.normal(0, 1, (100, 12)) + 40]), 1)
    x[50:80] = x[50]
    frame = _frame(spark, x)
    index = metric.build(frame)
    n = index.table.count()
    assert len(index.cells.weight) > 30
    everywhere = index.within(index.table.select("i", "x", "cell"), 1e6)
    assert everywhere.count() <= n * 6  # was one copy per slot, more than 30
    assert index.within(index.table.select("i", "x", "cell"), 5.0).count() < n * 4.5  # the far blobs share no block but one
    d = _distances(x)
    for k in (3, 31):
        assert [r["distance"] for r in cluster.k_distance(frame, k).collect()] == pytest.approx(np.sort(np.sort(d, axis=1)[:, k - 1]).tolist())
    rows = dbscan.dbscan(frame, 3.6, 5, 12).collect()
    assert [r["cluster"] for r in sorted(rows, key=lambda r: r["id"])] == _brute_dbscan(x, 3.6, 5)
    grid = radii.dbscan_grid(frame, [3.4, 3.6], [4, 5], clusters=(1, 400), max_noise=1.1, top=None).collect()
    for r in grid:
        labels = _brute_dbscan(x, r["eps"], r["min_samples"])
        assert (r["n_clusters"], r["n_noise"]) == (max(labels) + 1, labels.count(-1))
    assert len(grid) == 4


def test_few_queries_copy_points_to_few_blocks(spark):
    """Blocks of both sides give tasks enough; points are copied once per block of queries, so few queries are few blocks."""
    rows = _frame(spark, np.random.default_rng(8).normal(0, 1, (6000, 3)))
    met = lambda some: tiles.meet_blocks(some, rows, lambda q, p: pd.DataFrame({"q": [len(q)], "p": [len(p)]}), "q long, p long").agg(
        F.sum(F.col("q") * F.col("p")).alias("pairs"), F.sum("p").alias("copies")).first()
    assert tuple(met(rows.filter("id < 30"))) == (30 * 6000, 6000)
    assert tiles._blocks(20_000, 1_000_000, 65_536) == (2, 57) and tiles._blocks(1_000_000, 1_000_000, 65_536) == (16, 16)
