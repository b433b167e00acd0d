"""Near-duplicate detection: a chosen-path set similarity join over word shingles.

Every distinct shingle set gets ``COORDINATES`` minwise tokens of one byte. In each of several independent trees a
document walks down from the root: a node chooses one coordinate by its own hash, and documents with the
same token there share the child. After the levels of the first stage each document is compared
with the least id of the node it shares most trees with, and components are formed. Nodes that still hold several
components are compared exhaustively if they are small: all pairs across components whose minwise
tokens agree often enough are candidates. The documents of nodes of more than ``SMALL`` start again from the roots of
the next stage's trees, which are deeper and as many more as the same recall takes; what is large in the last stage is
compared in blocks, whatever its size. No pair inside a component becomes a row, so a group of thousands of
copies costs a comparison per copy.

Two sets of Jaccard similarity s agree in k tokens, binomial over ``COORDINATES``, and share a node of d levels in a
given tree with probability (k / COORDINATES)^d. ``plan`` takes as many trees as make a pair at the threshold share
none with probability ``MISS`` at most, k drawn from the binomial. A pair none of whose shared nodes is small has both
documents in the next stage, so ``MISS`` adds up over the stages, and once more for the count of equal tokens below
which a pair is dropped. All candidates are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.components import stars
from lodestar.llm.text import chain, flat, lower_ascii, mix, names, seeded, signed, slices, word_bounds
from lodestar.session import cut

COORDINATES, SMALL = 384, 2048
#: Chance that a stage, or the count of equal tokens, loses a pair at the threshold: below 10^-5 over two stages and the count.
MISS = 3e-6
#: Trees of the second stage at most; where it takes more, large nodes of the first are compared in blocks.
MOST_TREES = 512
#: Ids from here on are made for rows without one.
_MADE = 1 << 62


def _agree(percent: int) -> np.ndarray:
    """Probability of each count of equal tokens, 0 to ``COORDINATES``, of a pair at the threshold."""
    n, s = COORDINATES, percent / 100
    if percent == 100:
        return np.eye(n + 1)[n]
    return np.array([exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(s) + (n - k) * log(1 - s)) for k in range(n + 1)])


def missed(percent: int, levels: int, trees: int) -> float:
    """Probability that a pair at the threshold shares no node of ``levels`` levels in ``trees`` trees."""
    return float((_agree(percent) * (1 - (np.arange(COORDINATES + 1) / COORDINATES) ** levels) ** trees).sum())


def _trees(percent: int, levels: int) -> int:
    """Least number of trees that misses a pair at the threshold with probability ``MISS`` at most."""
    enough = 1
    while missed(percent, levels, enough) > MISS:
        enough *= 2
    return next(t for t in range(enough // 2 + 1, enough + 1) if missed(percent, levels, t) <= MISS)


def plan(percent: int) -> list[tuple[int, int]]:
    """Levels and trees of each stage. A pair at the threshold shares a node of the first in about a quarter of the trees."""
    if not 10 <= percent <= 100:
        raise ValueError(f"percent must be from 10 to 100, not {percent}")
    first = 16 if percent > 91 else max(1, round(6 * log(0.8) / log(percent / 100)))
    stages = [(levels, _trees(percent, levels)) for levels in (first, first + (first + 1) // 2)]
    return stages[:1] + [s for s in stages[1:] if s[1] <= MOST_TREES]


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit names of the shingles of each row; a row of fewer words has one, an empty one none."""
    data, offsets = flat(column)
    data = lower_ascii(data)
    starts, ends, row = word_bounds(data, offsets)
    word = names(data, starts, ends)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    rolled = word
    for k in range(1, width):
        rolled = chain(rolled[: len(word) - k], word[k:]) if len(word) > k else word[:0]
    out = []
    for start, count in zip(first[:-1], counts):
        if count >= width:
            out.append(np.unique(rolled[start : start + count - width + 1]))
        elif count:
            name = word[start : start + 1]
            for k in range(1, count):
                name = chain(name, word[start + k : start + k + 1])
            out.append(seeded(name, int(count)))
        else:
            out.append(word[:0])
    return out


def _sketch(width: int):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), width)
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            both = np.concatenate(sets)
            cuts = (np.cumsum(n) - n)[full]
            least = np.zeros((len(sets), COORDINATES), np.uint8)
            c = np.zeros((2, len(sets)), np.uint64)
            if len(full):
                for k in range(COORDINATES):
                    a, b = seeded(np.array([2 * k, 2 * k + 1], np.uint64), 77)
                    token = mix(np.minimum.reduceat((both ^ a) * (b | np.uint64(1)), cuts))
                    least[full, k] = token >> np.uint64(56)
                for k in range(2):  # what tells sets apart: 128 bits
                    c[k, full] = np.add.reduceat(seeded(both, 80 + k), cuts)
            sig = pa.array([x.tobytes() for x in least], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(signed(c[0])), pa.array(signed(c[1])), sig], schema=schema)

    return run


def _step(node: np.ndarray, tokens: np.ndarray, level: int) -> np.ndarray:
    """Child of each row's node: the node chooses the coordinate, the row's token there the child."""
    coordinate = (seeded(node, 1000 + level) % np.uint64(COORDINATES)).astype(np.int64)
    return chain(node, tokens[np.arange(len(node)), coordinate].astype(np.uint64))


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), COORDINATES)


_NODE = pa.schema([("node", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])


def _walk(stage: int, levels: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = _tokens(batch.column("sig"))
            for tree in range(trees):
                node = seeded(np.full(len(batch), tree, np.uint64), 500 + stage)
                for level in range(levels):
                    node = _step(node, tokens, level)
                yield pa.RecordBatch.from_arrays([pa.array(signed(node)), batch.column("id"), batch.column("n")], schema=_NODE)

    return run


def _sets(width: int):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), width)
            n = np.array([len(s) for s in sets], np.int64)
            cuts = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            values = pa.ListArray.from_arrays(cuts, pa.array(signed(np.concatenate(sets))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), values], schema=schema)

    return run


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Sizes ``na`` and ``nb`` and exact intersection ``both`` of the full sets of pairs ``a``, ``b``."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    joined = pairs.select("a", "b").join(right, "b").join(left, "a")
    return joined.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("both"))


def _linked(measured: DataFrame, percent: int) -> DataFrame:
    return measured.filter(F.lit(100) * F.col("both") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _shared_nodes(nodes: DataFrame) -> DataFrame:
    """Rows of nodes that hold at least two documents, with the least id ``pivot``."""
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("pivot")).filter("m > 1")
    return nodes.join(sizes.select("node", "pivot"), "node")


def _agreeing(percent: int) -> int:
    """Equal tokens below which a pair is out of the question."""
    return int(np.searchsorted(np.cumsum(_agree(percent)), MISS, "right"))


def _compare(percent: int):
    """Candidates of whole nodes; rows come sorted by node."""
    least = _agreeing(percent)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        node, ident, n, root, pivot, far = (rows.column(c).to_numpy() for c in ("node", "id", "n", "root", "pivot", "far"))
        token = _tokens(rows.column("sig"))
        lists = rows.column("nodes")
        length = np.diff(lists.offsets.to_numpy())
        nodes = np.full((len(rows), length.max(initial=0)), np.iinfo(np.int64).max)
        nodes[np.arange(nodes.shape[1]) < length[:, None]] = lists.flatten().to_numpy()
        for start, stop in zip(*_groups(node)):
            # Every pair across components has a side outside the node's largest one.
            _, kind, size = np.unique(root[start:stop], return_inverse=True, return_counts=True)
            outside = kind != size.argmax()
            mine = start + np.flatnonzero(outside)
            other = slice(start, stop)
            for i in range(0, len(mine), 32):
                some = mine[i : i + 32]
                near = root[some, None] != root[None, other]
                near &= ~outside[None, :] | (ident[some, None] < ident[None, other])  # once, where both are outside
                sizes = n[some, None], n[None, other]
                near &= 100 * np.minimum(*sizes) >= percent * np.maximum(*sizes)
                # Jaccard distance is a metric: two distances to one document bound the distance of a pair.
                apart = np.abs(far[some, None] - far[None, other]) > 1 - percent / 100 + 1e-9
                near &= ~(apart & (pivot[some, None] == pivot[None, other]))
                near &= (token[some, None, :] == token[None, other, :]).sum(2, dtype=np.int16) >= least
                x, y = np.nonzero(near)
                first = _first_common(nodes, some[x], start + y) == node[start]
                a, b = ident[some[x[first]]], ident[start + y[first]]
                yield np.minimum(a, b), np.maximum(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the node that may go on in the next batch

        def flush(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for a, b in pairs(pa.concat_batches(rows)) if rows else ():
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

        for batch in batches:
            if not len(batch):
                continue
            start = int(_groups(batch.column("node").to_numpy())[0][-1])
            if held and start == 0 and batch.column("node")[0] == held[0].column("node")[-1]:
                held.append(batch)
                continue
            yield from flush(held + [batch.slice(0, start)])
            held = [batch.slice(start)]
        yield from flush(held)

    return run


def _first_common(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least node that both rows of each pair stand in; there the pair is reported, and nowhere else."""
    out = np.empty(len(left), np.int64)
    step = max(1, (1 << 25) // max(nodes.shape[1], 1) ** 2)
    for a in range(0, len(left), step):
        mine = nodes[left[a : a + step]]
        shared = (mine[:, :, None] == nodes[right[a : a + step]][:, None, :]).any(2)
        out[a : a + step] = mine[np.arange(len(mine)), shared.argmax(1)]
    return out


def _groups(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    return start, np.append(start[1:], len(node))


def _candidates(members: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """Pairs across components of nodes of any size; a large node is split into blocks that meet pairwise.

    ``about`` has of each document the tokens and its exact distance ``far`` to a document ``pivot``.
    """
    blocks = F.ceil(F.col("m") * 2 / SMALL).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(3)), blocks).cast("int")
    meets = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.xxhash64("node", F.least(b, F.col("own")), F.greatest(b, F.col("own"))))
    split = members.filter(F.col("m") > SMALL).withColumn("own", own).withColumn("to", F.explode(meets))
    whole = members.filter(F.col("m") <= SMALL).withColumn("to", F.col("node"))
    placed = whole.select("to", "id", "n", "root").unionByName(split.select("to", "id", "n", "root"))
    # A document stands in one node of each tree (or in one row of blocks), so its list is short.
    placed = cut(placed.withColumnRenamed("to", "node"))
    listed = placed.groupBy("id").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    rows = placed.join(listed.join(about, "id"), "id")
    together = rows.repartition("node").sortWithinPartitions("node")
    return together.select("node", "id", "n", "root", "pivot", "far", "sig", "nodes").mapInArrow(_compare(percent), "a long, b long").distinct()


def _divided(members: DataFrame) -> DataFrame:
    """Per node with several components: the number of its documents."""
    parts = members.groupBy("node", "root").agg(F.count(F.lit(1)).alias("m"))
    return parts.groupBy("node").agg(F.count(F.lit(1)).alias("parts"), F.sum("m").alias("m")).filter("parts > 1").select("node", "m")


def _identity() -> Column:
    """The document id, or for a null one a number made from the text, above all usual ids."""
    made = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(_MADE)
    return F.coalesce(F.col("doc_id").cast("long"), made)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``.

    Words are lower-cased in A-Z and separated by ASCII white space; a document's set are its
    distinct shingles of ``width`` words, of fewer words the whole sequence. Documents are linked when
    100 * intersection >= ``percent`` * union. A document without words (or with a null text) has an
    empty set and no links. Rows that repeat an id count as one document. Rows with a null id take
    part under a number made from their text above all usual ids; their ``component_id`` is null unless a row with an id
    is reachable. Other columns are ignored.
    """
    found = _grouped(docs, width, percent)
    return found.select(
        F.when(F.col("id") < F.lit(_MADE), F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("component") < F.lit(_MADE), F.col("component")).alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``near_duplicates`` keeps: one document of each component."""
    stay = _grouped(docs, width, percent).filter("id = component").select("id").distinct()
    whole = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), _identity().alias("id"))
    return whole.join(stay, "id").select(*(F.col("row")[c].alias(c) for c in docs.columns))


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``id``, ``n`` (size of the set) and ``component`` of each row."""
    stages = plan(percent)
    texts = docs.select(_identity().alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    sketches = cut(texts.mapInArrow(_sketch(width), "id long, n long, c1 long, c2 long, sig binary"))
    # Equal sets first: a class of copies goes on as its smallest id. An empty set is alone.
    alone = F.when(F.col("n") == 0, F.col("id")).otherwise(F.lit(0))
    keyed = sketches.withColumn("c3", alone)
    classes = keyed.groupBy("c1", "c2", "c3").agg(F.min("id").alias("rep"))
    labelled = keyed.join(classes, ["c1", "c2", "c3"])
    member = cut(labelled.select("id", "n", "rep"))
    reps = cut(labelled.filter("id = rep and n > 0").select("id", "n", "sig"))

    shared = cut(_shared_nodes(reps.mapInArrow(_walk(0, *stages[0]), "node long, id long, n long")))
    sets = cut(texts.join(shared.select("id").distinct(), "id").mapInArrow(_sets(width), "id long, n long, s array<long>"))

    votes = shared.filter("pivot < id").groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("votes"))
    nearest = votes.groupBy("id").agg(F.max(F.struct("votes", (-F.col("pivot")).alias("p"))).alias("best"))
    measured = cut(_measured(nearest.select((-F.col("best.p")).alias("a"), F.col("id").alias("b")), sets))
    links = _linked(measured, percent)
    root = cut(stars(links))

    def rooted(nodes: DataFrame) -> DataFrame:
        return cut(nodes.select("node", "id", "n").join(root, "id", "left").select("node", "id", "n", F.coalesce("root", "id").alias("root")))

    parts, open_nodes = [], rooted(shared)
    for stage in range(1, len(stages) + 1):
        members = cut(open_nodes.join(_divided(open_nodes), "node"))
        large = members.filter(F.col("m") > SMALL)
        if stage == len(stages) or large.isEmpty():
            parts.append(members)
            break
        parts.append(members.filter(F.col("m") <= SMALL))
        again = reps.join(large.select("id").distinct(), "id").select("id", "n", "sig")
        open_nodes = rooted(again.mapInArrow(_walk(stage, *stages[stage]), "node long, id long, n long"))
    compared = parts[0]
    for p in parts[1:]:
        compared = compared.unionByName(p)
    distance = (F.lit(1.0) - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("far")
    known = measured.select(F.col("b").alias("id"), F.col("a").alias("pivot"), distance)
    # A document that was compared with none is at distance 0 from itself.
    about = reps.join(known, "id", "left").select(
        "id", "sig", F.coalesce("pivot", "id").alias("pivot"), F.coalesce("far", F.lit(0.0)).alias("far"))
    more = cut(_candidates(compared, about, percent))
    if not more.isEmpty():
        root = stars(links.unionByName(_linked(_measured(more, sets), percent)))
    by_class = member.join(root.withColumnRenamed("id", "rep"), "rep", "left")
    return by_class.select("id", "n", F.coalesce("root", "rep").alias("component"))
