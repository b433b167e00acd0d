"""One- and two-variable statistics on the given tables.

Doubles are compared after rounding to a place far above floating-point noise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.catalog import Catalog, table
from lodestar.operators import bivariate as bi
from lodestar.operators import ordered
from lodestar.operators import univariate as uni

catalog = Catalog()


def _round(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- one variable ---------------------------------------------------------------------------


@catalog.add("freq_table", "SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity")
def _(spark, sf):
    return uni.freq_table(table(spark, sf, "lineitem"), "l_quantity").drop("freq")


@catalog.add(
    "rel_freq",
    "SELECT c_mktsegment, count(*) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer), 6) AS freq FROM customer GROUP BY 1",
)
def _(spark, sf):
    return _round(uni.freq_table(table(spark, sf, "customer"), "c_mktsegment"), 6, "freq")


@catalog.add(
    "modes",
    "WITH t AS (SELECT p_size, count(*) AS n FROM part GROUP BY 1) SELECT * FROM t WHERE n = (SELECT max(n) FROM t)",
)
def _(spark, sf):
    return uni.modes(table(spark, sf, "part"), "p_size")


@catalog.add(
    "quantiles",
    " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(c_acctbal, {p}), 4) AS q FROM customer" for p in (0.25, 0.5, 0.75)
    ),
)
def _(spark, sf):
    return _round(ordered.quantiles(table(spark, sf, "customer"), "c_acctbal", [0.25, 0.5, 0.75]), 4, "q")


@catalog.add("quantiles_approx")
def _(spark, sf):
    return ordered.quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.25, 0.5, 0.75], approx=True)


@catalog.add("quantiles_approx_bound", "SELECT p, true AS within FROM (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) AS v(p)")
def _(spark, sf):
    """Whether the ranks of the approximate quantiles are as close as the sketch promises."""
    prices = table(spark, sf, "lineitem").select("l_extendedprice")
    marks = ordered.quantiles(prices, "l_extendedprice", [0.25, 0.5, 0.75], approx=True)
    row = marks.groupBy().pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q")).toDF("a", "b", "c").select(F.array("a", "b", "c")).scalar()
    shares = []
    for i in range(3):
        shares += [F.avg((F.col("l_extendedprice") < row[i]).cast("double")).alias(f"lo{i}"), F.avg((F.col("l_extendedprice") <= row[i]).cast("double")).alias(f"hi{i}")]
    slack = F.lit(1.0 / ordered.SKETCH_ACCURACY + 1e-9) + 1 / F.col("rows")  # the sketch's error, and one row
    held = [F.struct(F.lit(p).alias("p"), ((F.col(f"lo{i}") <= p + slack) & (F.col(f"hi{i}") >= p - slack)).alias("within")) for i, p in enumerate((0.25, 0.5, 0.75))]
    return prices.agg(F.count(F.lit(1)).alias("rows"), *shares).select(F.inline(F.array(*held)))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@catalog.add(
    "describe_table",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std,
            min({c}) AS min, round(quantile_cont({c}, 0.25), 5) AS q1, round(quantile_cont({c}, 0.5), 5) AS median,
            round(quantile_cont({c}, 0.75), 5) AS q3, max({c}) AS max FROM lineitem"""
        for c in _MEASURES
    ),
)
def _(spark, sf):
    return _round(uni.describe_table(table(spark, sf, "lineitem"), _MEASURES), 5, "mean", "std", "q1", "median", "q3")


@catalog.add(
    "describe_with_gaps",
    """WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN value END AS value, CAST(NULL AS DOUBLE) AS nothing FROM events)
       SELECT 'value' AS "column", count(value) AS count, round(avg(value), 5) AS mean, round(stddev_samp(value), 5) AS std, min(value) AS min,
         round(quantile_cont(value, 0.25), 5) AS q1, round(quantile_cont(value, 0.5), 5) AS median, round(quantile_cont(value, 0.75), 5) AS q3,
         max(value) AS max FROM e
       UNION ALL SELECT 'nothing', 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
)
def _(spark, sf):
    value = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    gaps = table(spark, sf, "events").select(value, F.lit(None).cast("double").alias("nothing"))
    return _round(uni.describe_table(gaps, ["value", "nothing"]), 5, "mean", "std", "q1", "median", "q3")


@catalog.add(
    "describe_text",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS "distinct", min({c}) AS min, max({c}) AS max,
            CAST(min(length({c})) AS INTEGER) AS min_length, CAST(max(length({c})) AS INTEGER) AS max_length FROM customer"""
        for c in ("c_name", "c_mktsegment")
    ),
)
def _(spark, sf):
    return uni.describe_text(table(spark, sf, "customer"), ["c_name", "c_mktsegment"])


@catalog.add(
    "boxplot_null_group",
    """WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, value FROM events),
         q AS (SELECT kind, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM e GROUP BY kind)
       SELECT e.kind, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
         min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
         max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
         count(*) FILTER (value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers, count(*) AS n
       FROM e JOIN q ON e.kind IS NOT DISTINCT FROM q.kind GROUP BY e.kind, q1, median, q3""",
)
def _(spark, sf):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    return _round(uni.boxplot_stats(table(spark, sf, "events").select(kind, "value"), "value", ["kind"]), 4, "q1", "median", "q3")


@catalog.add(
    "spread",
    "SELECT round(max(value) - min(value), 4) AS range, round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 4) AS iqr FROM events",
)
def _(spark, sf):
    return _round(uni.spread(table(spark, sf, "events"), "value"), 4, "range", "iqr")


@catalog.add(
    "variances",
    "SELECT round(var_pop(value), 4) AS var_pop, round(var_samp(value), 4) AS var_samp, round(stddev_samp(value), 4) AS std FROM events",
)
def _(spark, sf):
    return _round(uni.variances(table(spark, sf, "events"), "value"), 4, "var_pop", "var_samp", "std")


@catalog.add("coef_variation", "SELECT round(stddev_pop(value) / avg(value) * 100, 4) AS cv FROM events")
def _(spark, sf):
    return _round(uni.coef_variation(table(spark, sf, "events"), "value"), 4, "cv")


@catalog.add(
    "moments",
    "SELECT round(avg(pow(l_quantity, 3)), 2) AS raw, round(avg(pow(l_quantity - (SELECT avg(l_quantity) FROM lineitem), 3)), 2) + 0.0 AS central FROM lineitem",
)
def _(spark, sf):
    return _round(uni.moments(table(spark, sf, "lineitem"), "l_quantity", 3), 2, "raw", "central")


_CENTRED = "WITH m AS (SELECT avg(c_acctbal) AS a FROM customer), d AS (SELECT c_acctbal - a AS d FROM customer, m)"


@catalog.add("skew", f"{_CENTRED} SELECT round(avg(pow(d, 3)) / pow(avg(d * d), 1.5), 6) AS skewness FROM d")
def _(spark, sf):
    return _round(uni.shape(table(spark, sf, "customer"), "c_acctbal"), 6, "skewness").select("skewness")


@catalog.add("kurt", f"{_CENTRED} SELECT round(avg(pow(d, 4)) / pow(avg(d * d), 2), 6) AS kurtosis FROM d")
def _(spark, sf):
    return _round(uni.shape(table(spark, sf, "customer"), "c_acctbal"), 6, "kurtosis").select("kurtosis")


@catalog.add("sturges", "SELECT count(*) AS n, CAST(ceil(log2(count(*)) + 1) AS BIGINT) AS classes FROM orders")
def _(spark, sf):
    return uni.sturges(table(spark, sf, "orders"))


_HIST = """s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, CAST(ceil(log2(count(*)) + 1) AS INTEGER) AS k FROM customer),
     w AS (SELECT *, (hi - lo) / k AS w FROM s),
     b AS (SELECT CAST(least(floor((c_acctbal - lo) / w), k - 1) AS INTEGER) AS bin, count(*) AS n FROM customer, w GROUP BY 1),
     h AS (SELECT CAST(i AS INTEGER) AS bin, lo + w * i AS l, lo + w * (i + 1) AS r, lo + w * (i + 0.5) AS mid, coalesce(n, 0) AS n
           FROM (SELECT *, unnest(range(k)) AS i FROM w) LEFT JOIN b ON b.bin = i)"""


def _hist(spark, sf):
    return uni.histogram(table(spark, sf, "customer"), "c_acctbal")


@catalog.add(
    "histogram",
    f'WITH {_HIST} SELECT bin, round(l, 4) AS "left", round(r, 4) AS "right", round(mid, 4) AS mid, n FROM h',
)
def _(spark, sf):
    return _round(_hist(spark, sf), 4, "left", "right", "mid")


@catalog.add(
    "weighted_stats",
    f"""WITH {_HIST}, m AS (SELECT sum(mid * n) / sum(n) AS m FROM h)
        SELECT round(max(m), 4) AS mean, round(sum(n * (mid - m) * (mid - m)) / sum(n), 2) AS variance FROM h, m""",
)
def _(spark, sf):
    return uni.weighted_stats(_hist(spark, sf)).select(F.round("mean", 4).alias("mean"), F.round("variance", 2).alias("variance"))


@catalog.add(
    "weighted_quantile",
    f"""WITH {_HIST}, c AS (SELECT mid AS x, (sum(n) OVER (ORDER BY mid) - n * 0.5) / sum(n) OVER () AS c FROM h),
        p AS (SELECT unnest([0.25, 0.5, 0.75, 0.001, 0.999]::DOUBLE[]) AS p),
        e AS (SELECT p, max(CASE WHEN c <= p THEN c END) AS cl, max(CASE WHEN c <= p THEN x END) AS xl,
                     min(CASE WHEN c > p THEN c END) AS cr, min(CASE WHEN c > p THEN x END) AS xr FROM c, p GROUP BY p)
        SELECT p, round(CASE WHEN cl IS NULL THEN xr WHEN cr IS NULL THEN xl ELSE xl + (xr - xl) * (p - cl) / (cr - cl) END, 4) AS q FROM e""",
)
def _(spark, sf):
    return _round(uni.weighted_quantile(_hist(spark, sf), [0.25, 0.5, 0.75, 0.001, 0.999]), 4, "q")


@catalog.add("expand_classes", f"WITH {_HIST} SELECT round(mid, 4) AS x FROM (SELECT mid, unnest(range(n)) FROM h)")
def _(spark, sf):
    return _round(uni.expand_classes(_hist(spark, sf)), 4, "x")


_FENCES = """q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                 quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type),
     f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""


@catalog.add(
    "boxplot_stats",
    f"""WITH {_FENCES} SELECT event_type, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
        min(value) FILTER (value BETWEEN lo AND hi) AS whisker_low, max(value) FILTER (value BETWEEN lo AND hi) AS whisker_high,
        count(*) FILTER (value NOT BETWEEN lo AND hi) AS outliers, count(*) AS n
        FROM events JOIN f USING (event_type) GROUP BY event_type, f.q1, f.median, f.q3""",
)
def _(spark, sf):
    return _round(uni.boxplot_stats(table(spark, sf, "events"), "value", ["event_type"]), 4, "q1", "median", "q3")


@catalog.add(
    "boxplot_outliers",
    f"WITH {_FENCES} SELECT event_id, event_type, value FROM events JOIN f USING (event_type) WHERE value NOT BETWEEN lo AND hi",
)
def _(spark, sf):
    return uni.boxplot_outliers(table(spark, sf, "events").select("event_id", "event_type", "value"), "value", ["event_type"])


@catalog.add(
    "column_scales",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(stddev_samp({c}), 5) AS std FROM lineitem" for c in _MEASURES),
)
def _(spark, sf):
    return _round(uni.column_scales(table(spark, sf, "lineitem"), _MEASURES), 5, "std")


@catalog.add(
    "cap_share",
    """SELECT count(l_quantity) AS n, CAST(sum(CASE WHEN l_quantity >= 50 THEN 1 ELSE 0 END) AS BIGINT) AS capped,
       round(avg(CASE WHEN l_quantity >= 50 THEN 1.0 ELSE 0.0 END), 6) AS share FROM lineitem""",
)
def _(spark, sf):
    return _round(uni.cap_share(table(spark, sf, "lineitem"), "l_quantity", 50), 6, "share")


# --- two variables --------------------------------------------------------------------------


@catalog.add("covariance", "SELECT round(covar_samp(l_quantity, l_extendedprice), 2) AS covariance FROM lineitem")
def _(spark, sf):
    return _round(bi.covariance(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), 2, "covariance")


@catalog.add("correlation", "SELECT round(corr(l_quantity, l_extendedprice), 8) AS correlation FROM lineitem")
def _(spark, sf):
    return _round(bi.correlation(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), 8, "correlation")


@catalog.add(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 8) AS r FROM lineitem" for a in _MEASURES for b in _MEASURES
    ),
)
def _(spark, sf):
    return _round(bi.corr_matrix(table(spark, sf, "lineitem"), _MEASURES), 8, "r")


@catalog.add(
    "corr_target",
    " UNION ALL ".join(
        f"SELECT 'l_extendedprice' AS x, '{b}' AS y, round(corr(l_extendedprice, {b}), 8) AS r FROM lineitem" for b in _MEASURES
    ),
)
def _(spark, sf):
    return _round(bi.corr_matrix(table(spark, sf, "lineitem"), _MEASURES, target="l_extendedprice"), 8, "r")


def _expected(a, b, source):
    return f"""c AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {source} GROUP BY ALL),
        g AS (SELECT x.a, y.b FROM (SELECT DISTINCT a FROM c) x, (SELECT DISTINCT b FROM c) y),
        o AS (SELECT g.a, g.b, coalesce(n, 0) AS o FROM g LEFT JOIN c ON g.a = c.a AND g.b = c.b),
        e AS (SELECT *, CAST(sum(o) OVER (PARTITION BY a) AS DOUBLE) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM o)"""


@catalog.add(
    "expected_counts",
    f"WITH {_expected('c_mktsegment', 'c_nationkey', 'customer')} SELECT a AS c_mktsegment, b AS c_nationkey, o AS observed, round(e, 6) AS expected FROM e",
)
def _(spark, sf):
    return _round(bi.expected_counts(table(spark, sf, "customer"), "c_mktsegment", "c_nationkey"), 6, "expected")


@catalog.add(
    "chi_square",
    f"""WITH {_expected('l_returnflag', 'l_linestatus', 'lineitem')}
        SELECT round(sum((o - e) * (o - e) / e), 6) AS chi2, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM e""",
)
def _(spark, sf):
    return _round(bi.chi_square(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"), 6, "chi2")


@catalog.add(
    "chi_square_two_by_two",
    f"""WITH {_expected('l_linestatus', "(l_quantity > 25)", 'lineitem')}, d AS (SELECT *, abs(o - e) - least(0.5, abs(o - e)) AS d FROM e)
        SELECT round(sum(d * d / e), 6) AS chi2, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM d""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("big", F.col("l_quantity") > 25)
    return _round(bi.chi_square(lines, "l_linestatus", "big"), 6, "chi2")


@catalog.add(
    "chi_square_p",
    # With two degrees of freedom the tail is exp(-x/2).
    f"""WITH {_expected('l_returnflag', 'l_linestatus', 'lineitem')}, s AS (SELECT sum((o - e) * (o - e) / e) AS x FROM e)
        SELECT round(x, 6) AS chi2, CAST(2 AS BIGINT) AS dof, round(exp(-x / 2), 8) AS p_value FROM s""",
)
def _(spark, sf):
    test = bi.chi_square_test(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return _round(_round(test, 6, "chi2"), 8, "p_value")


_RANKS = """r AS (SELECT *, avg(rx) OVER (PARTITION BY x) AS ax, avg(ry) OVER (PARTITION BY y) AS ay FROM
     (SELECT l_quantity AS x, l_extendedprice AS y, row_number() OVER (ORDER BY l_quantity) AS rx,
             row_number() OVER (ORDER BY l_extendedprice) AS ry FROM lineitem))"""


@catalog.add("spearman", f"WITH {_RANKS} SELECT count(*) AS n, round(corr(ax, ay), 8) AS rho FROM r")
def _(spark, sf):
    return _round(bi.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), 8, "rho")


@catalog.add(
    "spearman_p",
    # The normal tail by the series of the error function, and the first correction for the degrees of freedom.
    f"""WITH {_RANKS}, s AS (SELECT count(*) AS n, corr(ax, ay) AS rho FROM r),
        t AS (SELECT n, rho, abs(rho) * sqrt((n - 2) / (1 - rho * rho)) AS t FROM s),
        e AS (SELECT n, rho, t, sum(CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END * pow(t / sqrt(2), 2 * k + 1) / (gamma(k + 1) * (2 * k + 1))) * 2 / sqrt(pi()) AS erf
              FROM t, range(0, 60) AS i(k) GROUP BY n, rho, t)
        SELECT n, round(rho, 8) AS rho, round(1 - erf + exp(-t * t / 2) / sqrt(2 * pi()) * t * (t * t + 1) / (2 * (n - 2)), 5) AS p_value FROM e""",
)
def _(spark, sf):
    test = bi.spearman_test(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return _round(_round(test, 8, "rho"), 5, "p_value")


@catalog.add(
    "simple_regression",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b,
         regr_r2(l_extendedprice, l_quantity) AS r2, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
       SELECT round(a, 4) AS slope, round(b, 4) AS intercept, round(r2, 8) AS r2, lo AS x_min, round(a * lo + b, 4) AS y_at_min,
         hi AS x_max, round(a * hi + b, 4) AS y_at_max FROM f""",
)
def _(spark, sf):
    line = bi.simple_regression(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return _round(_round(line, 4, "slope", "intercept", "y_at_min", "y_at_max"), 8, "r2")


@catalog.add("cond_weighted_mean", "SELECT round(avg(value), 6) AS mean FROM events WHERE event_type = 'purchase'")
def _(spark, sf):
    events = table(spark, sf, "events")
    return _round(bi.cond_weighted_mean(events, "value", F.col("event_type") == "purchase"), 6, "mean")


@catalog.add("perm_test")
def _(spark, sf):
    return bi.permutation_test(table(spark, sf, "customer"), "c_mktsegment", "c_nationkey", 9999)
