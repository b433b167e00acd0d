"""Bagged trees, for a number or a class, in a fixed number of jobs for any number of trees, levels and nodes.

As in the library's learners a tree sees of a feature only its bin, one of ``BINS`` between thresholds that are found once. So
rows of equal bins are one *cell*, and all that a tree needs of its bootstrap sample are sums per cell. Rows draw how often they
are in the sample of every tree where they lie, a partition adds the draws up by cell, and a tree grows out of its cells inside
one task; trees are dealt over the tasks. What is shuffled depends on the number of cells, not of rows, unless nearly every row
is a cell of its own. A row's draws come from its content, wherever it lies; equal rows draw together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a feature; accuracy of the quantiles between them where it has more values than that.
BINS, ACCURACY = 32, 10_000

#: Streams of random numbers, groups that trees are dealt over.
SLOTS, GROUPS = 256, 60

#: Rows that draw at a time, numbers that a task adds up before it hands them over, that are compared at a time, and predictions that are kept.
ROWS, HELD, COMPARED, KEPT = 2048, 1 << 22, 1 << 21, 100_000


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def thresholds(rows: DataFrame, d: int) -> list[np.ndarray]:
    """Per feature of ``v`` the upper ends of all bins but the last: between all values where they are few, else quantiles."""

    def few(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = [np.empty(0)] * d
        for frame in frames:
            if len(frame):
                x = matrix(frame["v"])
                for k in range(d):
                    if len(seen[k]) <= BINS:
                        seen[k] = np.unique(np.concatenate([seen[k], x[:, k]]))[: BINS + 1]
        yield pd.DataFrame({"k": np.repeat(np.arange(d), [len(s) for s in seen]), "at": np.concatenate(seen)})

    found = dict(rows.select("v").mapInPandas(few, "k int, at double").groupBy("k").agg(F.collect_set("at")).collect())
    if not found:
        raise ValueError("no rows to learn from")
    values = [np.unique(found[k]) for k in range(d)]
    wide = [k for k in range(d) if len(values[k]) > BINS]
    ends = [(v[1:] + v[:-1]) / 2 for v in values]
    if wide:
        shares = [i / BINS for i in range(1, BINS)]
        cut = rows.agg(*[F.percentile_approx(F.get("v", F.lit(k)), shares, ACCURACY) for k in wide]).first()
        for k, at in zip(wide, cut):
            ends[k] = np.unique(at)
    return ends


def binned(x: np.ndarray, ends: list[np.ndarray]) -> np.ndarray:
    """Bins of rows, one byte each; a value at a threshold lies below it."""
    return np.stack([np.searchsorted(t, x[:, k], "left") for k, t in enumerate(ends)], 1).astype(np.uint8)


def grow(bins: np.ndarray, sums: np.ndarray, classes: bool, depth: int, subset: int, rng: np.random.Generator) -> list[tuple[np.ndarray, ...]]:
    """Trees out of ``sums`` (cells, trees, numbers) of the cells with the given ``bins``, all trees level by level together.

    The numbers are weight, sum and sum of squares of the label, or the weight per class. A tree is (feature, bin, left,
    value) by node, root first: ``left`` is the place of the lower child with the upper one behind it, or -1 in a leaf. A node is split as long
    as that lowers the squared error (the Gini impurity) of its rows, where ``subset`` features are tried in each.
    """
    trees, d = sums.shape[1], bins.shape[1]
    weight = sums.sum(2) if classes else sums[:, :, 0]
    cell, tree = np.nonzero(weight > 0)
    stats = sums[cell, tree]
    node, owner = tree.copy(), np.arange(trees)  # nodes of a level, numbered through
    levels = []

    def kept(parts: np.ndarray) -> np.ndarray:
        """What of the label's squares the means of parts explain."""
        if classes:
            return (parts * parts).sum(-1) / np.maximum(parts.sum(-1), 1e-300)
        return parts[..., 1] ** 2 / np.maximum(parts[..., 0], 1e-300)

    for level in range(depth + 1):
        m = len(owner)
        total = np.stack([np.bincount(node, stats[:, s], m) for s in range(stats.shape[1])], 1)
        size = total.sum(1) if classes else total[:, 0]
        value = total / np.maximum(size, 1e-300)[:, None] if classes else (total[:, 1] / np.maximum(size, 1e-300))[:, None]
        feature, at, left = np.zeros(m, np.int32), np.zeros(m, np.uint8), np.full(m, -1)
        whole = size if classes else total[:, 2]
        least = 1e-12 * whole  # below that a gain is rounding
        open_ = np.flatnonzero((np.bincount(node, minlength=m) > 1) & (whole - kept(total) > least)) if level < depth else np.empty(0, int)
        place = np.full(m, -1)
        place[open_] = np.arange(len(open_))
        inside = place[node] >= 0
        cell, node, stats = cell[inside], node[inside], stats[inside]
        best = least[open_].copy()
        tried = np.argsort(rng.random((len(open_), d)), 1)[:, :subset] if subset < d else None
        order = np.argsort(place[node], kind="stable")
        cell, node, stats = cell[order], node[order], stats[order]
        at_node = place[node]
        width = max(1, COMPARED // (BINS * stats.shape[1]))
        for lo in range(0, len(open_), width):
            hi = min(len(open_), lo + width)
            here = slice(*np.searchsorted(at_node, [lo, hi]))
            some, old = stats[here], kept(total[open_[lo:hi]])
            for k in range(d):
                key = (at_node[here] - lo) * BINS + bins[cell[here], k]
                low = np.stack([np.bincount(key, some[:, s], (hi - lo) * BINS).reshape(-1, BINS) for s in range(some.shape[1])], 2).cumsum(1)
                low, high = low[:, :-1], low[:, -1:] - low[:, :-1]
                gain = kept(low) + kept(high) - old[:, None]
                empty = (low.sum(2) <= 0) | (high.sum(2) <= 0) if classes else (low[..., 0] <= 0) | (high[..., 0] <= 0)
                gain[empty] = -np.inf
                if tried is not None:
                    gain[~(tried[lo:hi] == k).any(1)] = -np.inf
                first = gain.argmax(1)
                top = gain[np.arange(hi - lo), first]
                better = np.flatnonzero(top > best[lo:hi])
                best[lo + better] = top[better]
                feature[open_[lo + better]], at[open_[lo + better]] = k, first[better]
                left[open_[lo + better]] = 0
        split = np.flatnonzero(left == 0)
        left[split] = 2 * np.arange(len(split))
        levels.append((owner, feature, at, left, value))
        going = left[node] >= 0
        cell, node, stats = cell[going], node[going], stats[going]
        node = left[node] + (bins[cell, feature[node]] > at[node])
        owner = np.repeat(owner[split], 2)
        if not len(owner):
            break
    # Nodes of one tree in the order of levels, where children are next to each other.
    starts = np.cumsum([0, *[len(v[0]) for v in levels]])
    owner, feature, at, left, value = (np.concatenate(v) for v in zip(*levels))
    left = np.concatenate([np.where(v[3] >= 0, v[3] + s, -1) for v, s in zip(levels, starts[1:])])
    found = []
    for t in range(trees):
        mine = np.flatnonzero(owner == t)
        new = np.searchsorted(mine, left[mine])
        found.append((feature[mine], at[mine], np.where(left[mine] >= 0, new, -1).astype(np.int32), value[mine]))
    return found


class Forest(Model):
    """Fitted trees: adds ``prediction``, the mean of the trees or the class with the greatest mean share of the rows in their leaves."""

    def __init__(self, ends: list[np.ndarray], trees: list[tuple[np.ndarray, ...]], classes: bool, shift: float):
        super().__init__()
        self.ends, self.trees, self.classes, self.shift = ends, trees, classes, shift

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """Of rows given by their bins."""
        roots = np.cumsum([0, *[len(t[0]) for t in self.trees]])[:-1]
        feature, at, value = (np.concatenate([t[k] for t in self.trees]) for k in (0, 1, 3))
        left = np.concatenate([np.where(t[2] >= 0, t[2] + r, -1) for t, r in zip(self.trees, roots)])
        rows = max(1, COMPARED // (len(roots) * value.shape[1]))
        out = []
        for start in range(0, len(bins), rows):
            some = bins[start : start + rows]
            node = np.broadcast_to(roots, (len(some), len(roots))).copy()
            row, col = np.nonzero(left[node] >= 0)
            while len(row):
                here = node[row, col]
                here = left[here] + (some[row, feature[here]] > at[here])
                node[row, col] = here
                more = left[here] >= 0
                row, col = row[more], col[more]
            mean = value[node].mean(1)
            out.append(mean.argmax(1).astype(float) if self.classes else mean[:, 0] + self.shift)
        return np.concatenate(out)

    def _transform(self, df: DataFrame) -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast((self.ends, self.trees, self.classes, self.shift))

        @F.pandas_udf("double")
        def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model, known = Forest(*sent.value), {}
            for batch in batches:
                if not len(batch):
                    yield pd.Series([], dtype=float)
                    continue
                keys = [row.tobytes() for row in binned(matrix(batch), model.ends)]
                new = list(set(keys) - known.keys())
                if new:
                    if len(known) > KEPT:
                        known, new = {}, list(set(keys))
                    known.update(zip(new, model.predict(np.frombuffer(b"".join(new), np.uint8).reshape(len(new), -1))))
                yield pd.Series([known[key] for key in keys])

        return df.withColumn("prediction", predicted(vector_to_array("features")))


def fit(df: DataFrame, label: str, trees: int, depth: int, seed: int, classes: bool = False) -> Forest:
    """Forest for the number (or class number) ``label`` from the vector ``features``.

    Every split may use every feature, for classes the root of their number. A single tree takes all rows as they are.
    """
    spark = df.sparkSession
    rows = df.select(vector_to_array("features").alias("v"), F.col(label).cast("double").alias("y"))
    one = rows.select(F.size("v").alias("d")).first()
    if one is None:
        raise ValueError("no rows to learn from")
    d = one["d"]
    ends = thresholds(rows, d)
    # The label moves next to zero, or squares would cancel.
    shift = 0.0 if classes else float(rows.agg(F.avg("y")).first()[0] or 0.0)
    numbers, groups = (1 if classes else 3), np.array_split(np.arange(trees), min(trees, GROUPS))

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            y = frame["y"].to_numpy(float)
            if not np.isfinite(y).all() or classes and ((y < 0) | (y != np.floor(y))).any():
                raise ValueError(f"{label} has labels that are missing, not finite or no class numbers")
            if len(frame):
                yield pd.DataFrame({"cell": [row.tobytes() for row in binned(matrix(frame["v"]), ends)], "y": y - shift})

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places: dict[tuple[bytes, int], int] = {}
        held, at, rng = np.zeros((64, trees * numbers)), None, None

        def handed() -> Iterator[pd.DataFrame]:
            table = held[: len(places)].reshape(len(places), trees, numbers)
            cell, c = [key[0] for key in places], [key[1] for key in places]
            for g, mine in enumerate(groups):
                yield pd.DataFrame({"g": g, "cell": cell, "c": c, "s": [row.tobytes() for row in np.ascontiguousarray(table[:, mine])]})

        for frame in frames:
            slot = frame["slot"].to_numpy()
            cell, y, n = frame["cell"].to_numpy(), frame["y"].to_numpy(), frame["n"].to_numpy()
            edges = np.flatnonzero(slot[1:] != slot[:-1]) + 1
            for lo, hi in zip([0, *edges], [*edges, len(frame)]):
                if lo < hi and slot[lo] != at:
                    at, rng = slot[lo], np.random.default_rng([seed, slot[lo]])
                for start in range(lo, hi, ROWS):
                    some = slice(start, min(hi, start + ROWS))
                    count = n[some, None]
                    w = (rng.poisson(count, (len(count), trees)) if trees > 1 else count).astype(float)
                    each = y[some, None]
                    drawn = (w if classes else np.stack([w, w * each, w * each * each], 2)).reshape(len(w), -1)
                    keys = list(zip(cell[some], y[some].astype(int) if classes else np.zeros(len(w), int)))
                    firsts = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]  # rows come sorted by cell
                    drawn = np.add.reduceat(drawn, firsts, axis=0)
                    for k in firsts:
                        places.setdefault(keys[k], len(places))
                    if len(places) > len(held):
                        held = np.concatenate([held, np.zeros((max(len(held), len(places) - len(held)), held.shape[1]))])
                    held[[places[keys[k]] for k in firsts]] += drawn
                    if len(places) * held.shape[1] > HELD:
                        yield from handed()
                        places.clear()
                        held[:] = 0
        if places:
            yield from handed()

    def grown(frame: pd.DataFrame) -> pd.DataFrame:
        g = int(frame["g"].iloc[0])
        mine = groups[g]
        frame = frame.sort_values(["cell", "c"], ignore_index=True)
        names, place = np.unique(frame["cell"].to_numpy(), return_inverse=True)
        c = frame["c"].to_numpy()
        table = np.zeros((len(names), len(mine), c.max() + 1 if classes else numbers))
        values = np.frombuffer(b"".join(frame["s"]), float).reshape(len(frame), len(mine), numbers)
        if classes:
            np.add.at(table, (place, slice(None), c), values[:, :, 0])
        else:
            np.add.at(table, place, values)
        bins = np.frombuffer(b"".join(names), np.uint8).reshape(len(names), -1)
        subset = int(np.ceil(np.sqrt(d))) if classes and trees > 1 else d
        found = grow(bins, table, classes, depth, subset, np.random.default_rng([seed, SLOTS + g]))
        return pd.DataFrame({"tree": mine, "nodes": [tree[0].tobytes() + tree[1].tobytes() + tree[2].tobytes() + tree[3].tobytes() for tree in found],
                             "n": [len(tree[0]) for tree in found]})

    copies = rows.mapInPandas(cells, "cell binary, y double").groupBy("cell", "y").agg(F.count(F.lit(1)).alias("n"))
    dealt = copies.withColumn("slot", F.pmod(F.xxhash64("cell", "y"), F.lit(SLOTS)).cast("int")).repartition(min(SLOTS, 2 * spark.sparkContext.defaultParallelism), "slot")
    drawn = dealt.sortWithinPartitions("slot", "cell", "y").mapInPandas(sums, "g int, cell binary, c int, s binary")
    nodes = drawn.repartition(len(groups), "g").groupBy("g").applyInPandas(grown, "tree int, nodes binary, n int")
    found = []
    for _, nodes, n in sorted(nodes.collect()):
        parts = [np.frombuffer(nodes, kind, n, start * n) for kind, start in ((np.int32, 0), (np.uint8, 4), (np.int32, 5))]
        found.append((*parts, np.frombuffer(nodes, float, offset=9 * n).reshape(n, -1)))
    return Forest(ends, found, classes, shift)
