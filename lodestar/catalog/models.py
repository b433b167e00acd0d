"""Feature preparation and regression studies on ``lineitem`` (linear models) and ``part`` (the rest)."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from lodestar.catalog import Catalog, table
from lodestar.operators import bivariate as bi
from lodestar.operators import foldwise, learn

catalog = Catalog()
LABEL = "l_extendedprice"
NUMBERS = ["l_quantity", "l_discount", "l_tax"]

FLAGS = ["l_returnflag", "l_linestatus"]


def _round(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _scores(scores):
    return _round(_round(scores.select("r2", "r2_std", "mae"), 8, "r2", "r2_std"), 4, "mae")


def _lines(spark, sf):
    return table(spark, sf, "lineitem").withColumn("row_key", F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))


def _coded(frame, cols):
    """Categories as dummies of the levels the table has."""
    return learn.dummies(frame, learn.levels(frame, cols))


def _parts(spark, sf):
    """Parts as features: size and dummies of type; the price is the label."""
    frame = table(spark, sf, "part").select("p_partkey", "p_size", "p_type", "p_retailprice")
    encoded = _coded(frame, ["p_type"])
    features = [c for c in encoded.columns if c not in ("p_partkey", "p_retailprice")]
    return encoded, features


def _part_scores(spark, sf, fit_for):
    frame, features = _parts(spark, sf)
    return learn.cv_scores(frame, fit_for(features), features, "p_retailprice", "p_partkey")


@catalog.add(
    "dummies",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS "l_returnflag_N",
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS "l_returnflag_R", CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS "l_linestatus_O"
       FROM lineitem""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return _coded(rows, FLAGS)


@catalog.add(
    "standardize",
    """SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part), 8) AS p_size,
       round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part), 8) AS p_retailprice FROM part""",
)
def _(spark, sf):
    cols = ["p_size", "p_retailprice"]
    return _round(learn.standardize(table(spark, sf, "part").select("p_partkey", *cols), cols), 8, *cols)


@catalog.add(
    "split_counts",
    """SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS part, count(*) AS n FROM orders GROUP BY 1""",
)
def _(spark, sf):
    train, test = learn.split(table(spark, sf, "orders"), F.col("o_orderkey") % 5 == 0)
    return (
        train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part")))
        .groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    )


@catalog.add("fold_balance")
def _(spark, sf):
    return learn.folds(table(spark, sf, "orders"), "o_orderkey").groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@catalog.add(
    "baseline_mae",
    """WITH m AS (SELECT avg(l_extendedprice) AS m FROM lineitem)
       SELECT round(max(m), 4) AS mean, round(avg(abs(l_extendedprice - m)), 4) AS mae FROM lineitem, m""",
)
def _(spark, sf):
    return _round(learn.baseline(table(spark, sf, "lineitem"), LABEL), 4, "mean", "mae")


@catalog.add(
    "linreg_two_features",
    """WITH c AS (SELECT covar_pop(l_quantity, l_extendedprice) AS ayy, covar_pop(l_discount, l_extendedprice) AS byy,
         var_pop(l_quantity) AS aa, var_pop(l_discount) AS bb, covar_pop(l_quantity, l_discount) AS ab,
         avg(l_quantity) AS ma, avg(l_discount) AS mb, avg(l_extendedprice) AS my FROM lineitem),
       s AS (SELECT *, (ayy * bb - byy * ab) / (aa * bb - ab * ab) AS wa, (byy * aa - ayy * ab) / (aa * bb - ab * ab) AS wb FROM c)
       SELECT 'l_quantity' AS feature, round(wa, 3) AS coefficient FROM s UNION ALL SELECT 'l_discount', round(wb, 3) FROM s
       UNION ALL SELECT '(intercept)', round(my - wa * ma - wb * mb, 3) FROM s""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(*NUMBERS[:2], LABEL)
    model = learn.linear(LABEL)(learn.assemble(rows, NUMBERS[:2]))
    intercept = spark.createDataFrame([("(intercept)", float(model.intercept))], "feature string, coefficient double")
    return _round(learn.coef_table(rows, model, NUMBERS[:2]).unionByName(intercept), 3, "coefficient")


_LINE = """t AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
     FROM lineitem WHERE l_orderkey % 5 <> 0)"""


def _line_split(spark, sf):
    train, test = learn.split(table(spark, sf, "lineitem"), F.col("l_orderkey") % 5 == 0)
    return train, test, bi.simple_regression(train, "l_quantity", LABEL)


@catalog.add(
    "residual_stats",
    f"""WITH {_LINE}, r AS (SELECT l_extendedprice - (a * l_quantity + b) AS r FROM lineitem, t WHERE l_orderkey % 5 <> 0)
        SELECT count(r) AS n, round(avg(r), 4) + 0.0 AS mean, round(stddev_samp(r), 4) AS std FROM r""",
)
def _(spark, sf):
    train, _, line = _line_split(spark, sf)
    return _round(learn.residual_stats(learn.line_prediction(train, line, "l_quantity"), LABEL), 4, "mean", "std")


@catalog.add(
    "test_metrics",
    f"""WITH {_LINE}, p AS (SELECT l_extendedprice AS y, a * l_quantity + b AS p FROM lineitem, t WHERE l_orderkey % 5 = 0)
        SELECT round(1 - avg((y - p) * (y - p)) / var_pop(y), 8) AS r2, round(avg(abs(y - p)), 4) AS mae,
          round(sqrt(avg((y - p) * (y - p))), 4) AS rmse FROM p""",
)
def _(spark, sf):
    _, test, line = _line_split(spark, sf)
    result = learn.test_metrics(learn.line_prediction(test, line, "l_quantity"), LABEL)
    return _round(_round(result, 8, "r2"), 4, "mae", "rmse")


@catalog.add(
    "cv_scores",
    """WITH x AS (SELECT l_orderkey % 5 AS f, l_quantity AS a, l_discount AS b, l_extendedprice AS y FROM lineitem),
       k AS (SELECT unnest(range(5)) AS k),
       c AS (SELECT k, covar_pop(a, y) AS ayy, covar_pop(b, y) AS byy, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab,
         avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM x JOIN k ON f <> k GROUP BY k),
       w AS (SELECT *, (ayy * bb - byy * ab) / (aa * bb - ab * ab) AS wa, (byy * aa - ayy * ab) / (aa * bb - ab * ab) AS wb FROM c),
       e AS (SELECT f, y, y - (my + wa * (a - ma) + wb * (b - mb)) AS e FROM x JOIN w ON f = k),
       s AS (SELECT f, 1 - avg(e * e) / var_pop(y) AS r2, avg(abs(e)) AS mae FROM e GROUP BY f)
       SELECT round(avg(r2), 8) AS r2, round(stddev_pop(r2), 8) AS r2_std, round(avg(mae), 4) AS mae FROM s""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem")
    return _scores(foldwise.cv_table(rows, {"linear": foldwise.Linear(NUMBERS[:2])}, LABEL, F.col("l_orderkey") % 5))


@catalog.add(
    "cv_scores_any",
    """WITH m AS (SELECT k, avg(p_retailprice) AS m FROM part JOIN (SELECT unnest(range(5)) AS k) ON p_partkey % 5 <> k GROUP BY k),
       e AS (SELECT p_partkey % 5 AS f, p_retailprice AS y, p_retailprice - m AS e FROM part JOIN m ON p_partkey % 5 = k),
       s AS (SELECT f, 1 - avg(e * e) / var_pop(y) AS r2, avg(abs(e)) AS mae FROM e GROUP BY f)
       SELECT round(avg(r2), 8) AS r2, round(stddev_pop(r2), 8) AS r2_std, round(avg(mae), 4) AS mae FROM s""",
)
def _(spark, sf):
    """Cross-validation of an arbitrary learner, here one whose predictions are known: a tree without a split is the mean."""
    rows = table(spark, sf, "part")
    return _scores(learn.cv_scores(rows, learn.stump("p_retailprice"), ["p_size"], "p_retailprice", "p_partkey", fold=F.col("p_partkey") % 5))


@catalog.add("rf_cv")
def _(spark, sf):
    return _part_scores(spark, sf, lambda features: learn.random_forest("p_retailprice"))


@catalog.add("gbt_cv")
def _(spark, sf):
    return _part_scores(spark, sf, lambda features: learn.boosting("p_retailprice"))


@catalog.add("poly_cv")
def _(spark, sf):
    return foldwise.cv_table(_lines(spark, sf), {"polynomial": foldwise.Linear(NUMBERS, degree=2)}, LABEL, learn.fold_of("row_key", 5)).drop("model")


@catalog.add(
    "poly_cv_line",
    """WITH z AS (SELECT l_orderkey % 5 AS f, (l_quantity - 25) / 15 AS a, pow((l_quantity - 25) / 15, 2) AS b, l_extendedprice AS y FROM lineitem),
       k AS (SELECT unnest(range(5)) AS k),
       c AS (SELECT k, covar_pop(a, y) AS ayy, covar_pop(b, y) AS byy, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab,
         avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM z JOIN k ON f <> k GROUP BY k),
       w AS (SELECT *, (ayy * bb - byy * ab) / (aa * bb - ab * ab) AS wa, (byy * aa - ayy * ab) / (aa * bb - ab * ab) AS wb FROM c),
       e AS (SELECT f, y, y - (my + wa * (a - ma) + wb * (b - mb)) AS e FROM z JOIN w ON f = k),
       s AS (SELECT f, 1 - avg(e * e) / var_pop(y) AS r2, avg(abs(e)) AS mae FROM e GROUP BY f)
       SELECT round(avg(r2), 7) AS r2, round(stddev_pop(r2), 7) AS r2_std, round(avg(mae), 3) AS mae FROM s""",
)
def _(spark, sf):
    """A parabola in one column: least squares do not depend on how its two terms are scaled."""
    rows = table(spark, sf, "lineitem")
    scores = foldwise.cv_table(rows, {"parabola": foldwise.Linear(["l_quantity"], degree=2)}, LABEL, F.col("l_orderkey") % 5).drop("model")
    return _round(_round(scores, 7, "r2", "r2_std"), 3, "mae")


_ALPHAS = [0.01, 1.0, 100.0, 10000.0]


@catalog.add(
    "ridge_grid_line",
    f"""WITH m AS (SELECT avg(l_quantity) AS mx, stddev_pop(l_quantity) AS sx, avg(l_extendedprice) AS my, count(*) AS n FROM lineitem),
        z AS (SELECT (l_quantity - mx) / sx AS z, l_extendedprice - my AS y, n FROM lineitem, m),
        a AS (SELECT unnest({_ALPHAS}::DOUBLE[]) AS alpha), w AS (SELECT alpha, sum(z * y) / (max(n) + alpha) AS w FROM z, a GROUP BY alpha)
        SELECT alpha, round(avg(pow((y - w * z) / (1 - 1.0::DOUBLE / n - z * z / (n + alpha)), 2)), 2) AS loo_mse, count(*) AS n
        FROM z, w GROUP BY alpha""",
)
def _(spark, sf):
    return _round(learn.ridge_grid(table(spark, sf, "lineitem"), ["l_quantity"], LABEL, _ALPHAS), 2, "loo_mse")


@catalog.add("ridge_grid")
def _(spark, sf):
    return learn.ridge_grid(table(spark, sf, "lineitem"), NUMBERS, LABEL, learn.log_spaced(-3, 3, 20))


@catalog.add("ridge_cv")
def _(spark, sf):
    model = foldwise.Ridge(NUMBERS, learn.log_spaced(-3, 3, 20))
    return foldwise.cv_table(_lines(spark, sf), {"ridge": model}, LABEL, learn.fold_of("row_key", 5)).drop("model")


#: Per training set of one column: rows, means, deviation, products; scaled column ``z`` of its rows.
_TRAIN = """x AS (SELECT l_orderkey % 5 AS f, l_quantity AS a, l_extendedprice AS y FROM lineitem), k AS (SELECT unnest(range(5)) AS k),
       t AS (SELECT k, count(*) AS n, avg(a) AS ma, stddev_pop(a) AS sa, avg(y) AS my, count(*) * covar_pop(a, y) / stddev_pop(a) AS zy
         FROM x JOIN k ON f <> k GROUP BY k)"""
_HELD = """e AS (SELECT f, y, y - my - w * (a - ma) / sa AS e FROM x JOIN v ON f = v.k),
       s AS (SELECT f, 1 - avg(e * e) / var_pop(y) AS r2, avg(abs(e)) AS mae FROM e GROUP BY f)
       SELECT round(avg(r2), 8) AS r2, round(stddev_pop(r2), 8) AS r2_std, round(avg(mae), 4) AS mae FROM s"""


@catalog.add(
    "ridge_cv_line",
    f"""WITH {_TRAIN}, p AS (SELECT *, zy / (n + alpha) AS w FROM t, (SELECT unnest({_ALPHAS}::DOUBLE[]) AS alpha)),
       loo AS (SELECT p.k, alpha, any_value(w) AS w, any_value(ma) AS ma, any_value(sa) AS sa, any_value(my) AS my,
           sum(pow((y - my - w * (a - ma) / sa) / (1 - 1.0::DOUBLE / n - pow((a - ma) / sa, 2) / (n + alpha)), 2)) AS sse
         FROM p JOIN x ON f <> p.k GROUP BY p.k, alpha),
       v AS (SELECT * FROM loo QUALIFY row_number() OVER (PARTITION BY k ORDER BY sse, alpha) = 1), {_HELD}""",
)
def _(spark, sf):
    """Every fold picks its own penalty by the leave-one-out error of its training rows."""
    rows = table(spark, sf, "lineitem")
    return _scores(foldwise.cv_table(rows, {"ridge": foldwise.Ridge(["l_quantity"], _ALPHAS)}, LABEL, F.col("l_orderkey") % 5))


@catalog.add("lasso_cv")
def _(spark, sf):
    return foldwise.cv_table(_lines(spark, sf), {"lasso": foldwise.Lasso(NUMBERS, 0.1)}, LABEL, learn.fold_of("row_key", 5)).drop("model")


@catalog.add("lasso_cv_line", f"""WITH {_TRAIN}, v AS (SELECT *, sign(zy) * greatest(abs(zy) / n - 500, 0) AS w FROM t), {_HELD}""")
def _(spark, sf):
    """With one column the minimum is the product with the label, moved towards zero by the penalty."""
    rows = table(spark, sf, "lineitem")
    return _scores(foldwise.cv_table(rows, {"lasso": foldwise.Lasso(["l_quantity"], 500.0)}, LABEL, F.col("l_orderkey") % 5))


@catalog.add("linear_table")
def _(spark, sf):
    """Nested feature sets, then the penalised and the polynomial model, as one ranking from one pass of sums."""
    coded = _coded(_lines(spark, sf).select("row_key", *NUMBERS, *FLAGS, LABEL), FLAGS)
    every = [c for c in coded.columns if c not in ("row_key", LABEL)]
    return foldwise.cv_table(coded, _linear_models(NUMBERS, every), LABEL, learn.fold_of("row_key", 5)).orderBy(F.desc("r2"), "model")


def _linear_models(numbers, every):
    return {
        "linear, 2 features": foldwise.Linear(numbers[:2]),
        "linear, numbers": foldwise.Linear(numbers),
        "linear, all": foldwise.Linear(every),
        "ridge": foldwise.Ridge(every, learn.log_spaced(-3, 3, 20)),
        "lasso": foldwise.Lasso(every, 0.1),
        "polynomial": foldwise.Linear(every, degree=2),
    }


@catalog.add("model_table")
def _(spark, sf):
    """Linear models of growing feature sets, the penalised and the polynomial ones, forest and boosting, on the same folds."""
    frame, features = _parts(spark, sf)
    linear = foldwise.cv_table(frame, _linear_models(features[:2], features), "p_retailprice", learn.fold_of("p_partkey", 5))
    trees = {
        "forest": _part_scores(spark, sf, lambda _: learn.random_forest("p_retailprice")),
        "boosting": _part_scores(spark, sf, lambda _: learn.boosting("p_retailprice")),
    }
    return linear.unionByName(learn.model_table(trees)).orderBy(F.desc("r2"), "model")


@catalog.add(
    "study",
    """WITH x AS (SELECT l_orderkey % 5 = 0 AS held, (l_orderkey // 5) % 5 AS f, l_quantity AS a, l_discount AS b, l_extendedprice AS y FROM lineitem),
       k AS (SELECT unnest(range(6)) AS k),
       c AS (SELECT k, covar_pop(a, y) AS ayy, covar_pop(b, y) AS byy, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab,
         avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM x JOIN k ON f <> k WHERE NOT held GROUP BY k),
       w AS (SELECT *, (ayy * bb - byy * ab) / (aa * bb - ab * ab) AS wa, (byy * aa - ayy * ab) / (aa * bb - ab * ab) AS wb FROM c),
       p AS (SELECT held, f, y, my + wa * (a - ma) + wb * (b - mb) AS p FROM x JOIN w ON CASE WHEN held THEN k = 5 ELSE k = f END),
       s AS (SELECT f, 1 - avg(pow(y - p, 2)) / var_pop(y) AS r2, avg(abs(y - p)) AS mae FROM p WHERE NOT held GROUP BY f),
       g AS (SELECT y, p, len(list_filter([10000, 25000, 40000, 60000], lambda v: v < y)) AS cy, len(list_filter([10000, 25000, 40000, 60000], lambda v: v < p)) AS cp
         FROM p WHERE held)
       SELECT count(*) AS n_test, round(1 - avg(pow(y - p, 2)) / var_pop(y), 8) AS r2, round(avg(abs(y - p)), 3) AS mae,
         round(sqrt(avg(pow(y - p, 2))), 3) AS rmse, round(avg(CASE WHEN cy = cp THEN 1.0 ELSE 0.0 END), 8) AS accuracy,
         round(avg(CASE WHEN abs(cy - cp) <= 1 THEN 1.0 ELSE 0.0 END), 8) AS within_one, round((SELECT avg(r2) FROM s), 8) AS cv_r2,
         round((SELECT stddev_pop(r2) FROM s), 8) AS cv_r2_std, round((SELECT avg(mae) FROM s), 3) AS cv_mae FROM g""",
)
def _(spark, sf):
    """Price from quantity and discount: cross-validated on training rows, fitted once, judged once on held-out rows and their classes."""
    found = foldwise.study(table(spark, sf, "lineitem"), foldwise.Linear(NUMBERS[:2]), LABEL, F.col("l_orderkey"), [10000, 25000, 40000, 60000])
    return _round(_round(found, 8, "r2", "accuracy", "within_one", "cv_r2", "cv_r2_std"), 3, "mae", "rmse", "cv_mae")


@catalog.add("study_coded")
def _(spark, sf):
    """The same study of a ridge model over numbers and coded categories."""
    coded = _coded(table(spark, sf, "lineitem").select("l_orderkey", *NUMBERS, *FLAGS, LABEL), FLAGS)
    every = [c for c in coded.columns if c not in ("l_orderkey", LABEL)]
    model = foldwise.Ridge(every, learn.log_spaced(-3, 3, 20))
    return foldwise.study(coded, model, LABEL, F.col("l_orderkey"), [10000, 25000, 40000, 60000])


@catalog.add("coef_table")
def _(spark, sf):
    coded = _coded(table(spark, sf, "lineitem").select(*NUMBERS, *FLAGS, LABEL), FLAGS)
    features = [c for c in coded.columns if c != LABEL]
    return learn.coef_table(coded, learn.linear(LABEL)(learn.assemble(coded, features)), features)


@catalog.add("rf_classifier")
def _(spark, sf):
    """Type of a part from size and price, as a direct classification; accuracy on held-out parts."""
    rows = learn.assemble(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    indexed = StringIndexer(inputCol="p_type", outputCol="label_index", stringOrderType="alphabetAsc").fit(rows).transform(rows)
    train, test = learn.split(indexed, learn.fold_of("p_partkey", 5) == 0)
    scored = learn.forest_classifier("label_index")(learn.spread(train)).transform(test)
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col("label_index")).cast("double")).alias("accuracy"))
