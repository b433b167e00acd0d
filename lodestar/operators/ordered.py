"""Order-dependent operators without a global window.

A window without ``PARTITION BY`` pulls every row into one task. The operators here sort by
range instead: Spark's range exchange splits the order into even slices (also inside one hot
key, because the slice bounds use all order columns), each slice is handled on its own, and
only one total per slice is combined globally.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.session import cut

# monotonically_increasing_id() keeps the slice number above bit 33 and the row position below.
_SLICE_BITS = 33
_POSITION_MASK = (1 << _SLICE_BITS) - 1

#: Rank error of a quantile sketch is one part in this many.
SKETCH_ACCURACY = 10_000


def _as_columns(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def _sliced(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Globally sorted rows with a fixed slice ``_s`` and position ``_i`` inside the slice.

    The result is cut to the shared folder: slice numbers come from sampled range bounds, so
    they must be fixed before they are used twice.
    """
    marked = df.orderBy(*_as_columns(order_by)).withColumn("_m", F.monotonically_increasing_id())
    return (
        cut(marked)
        .withColumn("_s", F.shiftright("_m", _SLICE_BITS))
        .withColumn("_i", F.col("_m").bitwiseAND(F.lit(_POSITION_MASK)))
        .drop("_m")
    )


def _slice_offsets(sliced: DataFrame, amount: Column) -> DataFrame:
    """Per slice: the total of all earlier slices ``_before`` and the grand total ``_all``.

    One row per slice (the number of shuffle partitions), so the unpartitioned window and the
    broadcast of its result are bounded by that setting and not by the data.
    """
    totals = sliced.groupBy("_s").agg(F.sum(amount).alias("_t"))
    earlier = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_s",
        F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_t").over(Window.partitionBy()).alias("_all"),
    )


def number_records(df: DataFrame, order_by: Sequence[str | Column], out: str = "n") -> DataFrame:
    """Contiguous numbers 1..n in the given (total) order."""
    sliced = _sliced(df, order_by)
    offsets = _slice_offsets(sliced, F.lit(1)).select("_s", "_before")
    return (
        sliced.join(F.broadcast(offsets), "_s")
        .withColumn(out, F.col("_before") + F.col("_i") + 1)
        .drop("_s", "_i", "_before")
    )


def every_kth(df: DataFrame, order_by: Sequence[str | Column], start: int, stop: int, step: int) -> DataFrame:
    """Positional sample: rows ``start, start+step, …`` below ``stop``, counted from 0."""
    position = F.col("_n") - 1
    wanted = (position >= start) & (position < stop) & ((position - start) % step == 0)
    return number_records(df, order_by, "_n").filter(wanted).drop("_n")


def prefix_sum(df: DataFrame, order_by: Sequence[str | Column], amount: str) -> DataFrame:
    """Add ``below`` (sum of ``amount`` on all earlier rows) and ``total`` (sum over all rows).

    Meant for reduced tables with one row per value; the order must be total.
    """
    sliced = _sliced(df, order_by)
    offsets = _slice_offsets(sliced, F.col(amount))
    inside = Window.partitionBy("_s").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_s")
        .withColumn("below", F.col("_before") + F.col("_in"))
        .withColumnRenamed("_all", "total")
        .drop("_s", "_i", "_in", "_before")
    )


def value_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, value): ``n`` copies, ``below`` smaller values, ``total`` group size.

    This is the base of cumulative counts, ranks and exact quantiles. Rows are reduced to
    distinct values first; a hot group is spread over many slices because the slices are cut
    on (group, value).
    """
    by = list(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = prefix_sum(counts, [*by, value], "n")
    if not by:
        return ranked
    starts = ranked.groupBy(*by).agg(F.min("below").alias("_start"), F.sum("n").alias("_size"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}")) for c in by]
    return ranked.alias("r").join(starts.alias("g"), same).select(
        *[F.col(f"r.{c}").alias(c) for c in by],
        F.col(f"r.{value}").alias(value),
        "n",
        (F.col("below") - F.col("_start")).alias("below"),
        F.col("_size").alias("total"),
    )


def _at_ranks(x: Column, upto: Column, total: Column, p: float, where: Column | None = None) -> Column:
    """Aggregate: the value at rank h = (total-1)·p, linear between whole ranks.

    The value at a whole rank r is the smallest one whose cumulative count exceeds r; ``min`` of
    a case expression finds it with map-side combining, so nothing is collected.
    """
    rank = (total - 1) * F.lit(float(p))
    known = F.lit(True) if where is None else where
    low = F.min(F.when(known & (upto > F.floor(rank)), x))
    high = F.min(F.when(known & (upto > F.ceil(rank)), x))
    return low + (high - low) * F.max(rank - F.floor(rank))


def quantile_columns(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles as one named column each, one row per group.

    The column is not sorted: a sketch brackets every quantile within a narrow value window,
    a second pass counts what lies below each window, and only the rows inside (some hundredths
    of a percent, or the copies of one value, which are counted first) are ranked. The counts show whether a window holds its quantile; should one
    ever miss it, all value counts are ranked instead, with the same result.
    """
    by = list(by)
    data = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"))
    narrowed = _narrowed(data, probs, by)
    if narrowed is not None:
        return narrowed
    ranks = value_ranks(data, "_x", by)
    upto = F.col("below") + F.col("n")
    return ranks.groupBy(*by).agg(*[_at_ranks(F.col("_x"), upto, F.col("total"), p).alias(c) for c, p in probs.items()])


def _attach(data: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the columns of a table with one row per group (one row without groups)."""
    extra = [c for c in small.columns if c not in by]
    if not by:
        row = small.select(F.struct(*extra)).scalar()
        return data.withColumns({c: row[c] for c in extra})
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by]
    return data.alias("d").join(small.alias("m"), same).select("d.*", *[f"m.{c}" for c in extra])


def _narrowed(data: DataFrame, probs: dict[str, float], by: list[str]) -> DataFrame | None:
    """:func:`quantile_columns` through value windows; None when a window misses its quantile."""
    margin = 2 / SKETCH_ACCURACY
    marks = [v for p in probs.values() for v in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = data.groupBy(*by).agg(F.percentile_approx("_x", F.array(*[F.lit(v) for v in marks]), F.lit(SKETCH_ACCURACY)).alias("_m"))
    windows = [
        F.struct(F.lit(i).alias("i"), F.col("_m")[2 * i].alias("lo"), F.col("_m")[2 * i + 1].alias("hi"))
        for i in range(len(probs))
    ]
    placed = _attach(data, sketch.select(*by, F.array(*windows).alias("_w")), by)
    x = F.col("_x")
    counts = [F.count(F.lit(1)).alias("_all")]
    for i in range(len(probs)):
        counts.append(F.sum((x < F.col("_w")[i]["lo"]).cast("long")).alias(f"_b{i}"))
        counts.append(F.sum((x <= F.col("_w")[i]["hi"]).cast("long")).alias(f"_u{i}"))
    bounds = cut(placed.groupBy(*by).agg(*counts))
    held = F.lit(True)
    for i, p in enumerate(probs.values()):
        rank = (F.col("_all") - 1) * F.lit(float(p))
        held = held & (F.col(f"_b{i}") <= F.floor(rank)) & (F.col(f"_u{i}") > F.ceil(rank))
    if not bounds.filter(~held).isEmpty():
        return None
    inside = F.explode(F.filter("_w", lambda w: x.between(w["lo"], w["hi"])))
    near = placed.select(*by, "_x", inside.alias("_e")).select(*by, "_x", F.col("_e.i").alias("_win"))
    ranks = _attach(value_ranks(near, "_x", [*by, "_win"]), bounds, by)
    aggs = []
    for i, (name, p) in enumerate(probs.items()):
        upto = F.col(f"_b{i}") + F.col("below") + F.col("n")
        aggs.append(_at_ranks(x, upto, F.col("_all"), p, F.col("_win") == i).alias(name))
    return ranks.groupBy(*by).agg(*aggs)


def quantile_table(df: DataFrame, cols: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Exact quantiles of several columns: ``column`` and one named column each, a row per column that has values.

    As in :func:`quantile_columns`, for all columns side by side: one pass sketches them, one counts what lies below
    each window, and only values inside a window become rows to be ranked.
    """
    spark, margin = df.sparkSession, 2 / SKETCH_ACCURACY
    numbers = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    marks = F.array(*[F.lit(v) for p in probs.values() for v in (max(0.0, p - margin), min(1.0, p + margin))])
    sketch = numbers.agg(*[F.percentile_approx(c, marks, F.lit(SKETCH_ACCURACY)).alias(c) for c in numbers.columns]).first()
    windows = [(i, w, p, *sketch[i][2 * w : 2 * w + 2]) for i in range(len(cols)) if sketch[i] for w, p in enumerate(probs.values())]
    sizes = [F.count(c).alias(f"n{i}") for i, c in enumerate(numbers.columns)]
    parts = [(F.sum((F.col(f"_{i}") < lo).cast("long")).alias(f"b{i}_{w}"), F.sum((F.col(f"_{i}") <= hi).cast("long")).alias(f"u{i}_{w}")) for i, w, _, lo, hi in windows]
    counts = numbers.agg(*sizes, *[c for pair in parts for c in pair]).first()
    held = [(i, w, counts[f"b{i}_{w}"], (counts[f"n{i}"] - 1) * p) for i, w, p, *_ in windows]
    if not all(below <= math.floor(rank) and counts[f"u{i}_{w}"] > math.ceil(rank) for i, w, below, rank in held):
        return quantile_columns(df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value"), "value", probs, ["column"])
    places = [F.when(F.col(f"_{i}").between(lo, hi), F.struct(F.lit(i).alias("_c"), F.lit(w).alias("_w"), F.col(f"_{i}").alias("_x"))) for i, w, _, lo, hi in windows]
    if not places:
        return spark.createDataFrame([], ", ".join(["column string", *[f"{name} double" for name in probs]]))
    near = numbers.select(F.explode(F.filter(F.array(*places), lambda e: e.isNotNull())).alias("_e")).select("_e.*")
    known = F.broadcast(spark.createDataFrame(held, "_c int, _w int, _b long, _rank double"))  # a row per column and quantile
    ranks = value_ranks(near, "_x", ["_c", "_w"]).join(known, ["_c", "_w"])
    upto, rank = F.col("_b") + F.col("below") + F.col("n"), F.col("_rank")
    low, high = F.min(F.when(upto > F.floor(rank), F.col("_x"))), F.min(F.when(upto > F.ceil(rank), F.col("_x")))
    each = ranks.groupBy("_c", "_w").agg((low + (high - low) * F.max(rank - F.floor(rank))).alias("_q"))
    named = F.get(F.array(*map(F.lit, cols)), F.col("_c")).alias("column")
    return each.groupBy("_c").agg(*[F.max(F.when(F.col("_w") == w, F.col("_q"))).alias(name) for w, name in enumerate(probs)]).select(named, *probs)


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Long table (group, ``p``, ``q``): exact by default, sketch based with ``approx``."""
    by = list(by)
    names = [f"_q{i}" for i in range(len(probs))]
    if approx:
        aggs = [F.percentile_approx(value, float(p), SKETCH_ACCURACY).cast("double").alias(c) for p, c in zip(probs, names)]
        wide = df.groupBy(*by).agg(*aggs)
    else:
        wide = quantile_columns(df, value, dict(zip(names, probs)), by)
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col(c).alias("q")) for p, c in zip(probs, names)])
    return wide.select(*by, F.inline(pairs))
