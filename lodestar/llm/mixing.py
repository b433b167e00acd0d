"""Mixing sources to target weights by temperature.

The token share of each source is raised to an exponent, found by bisection: the weights keep to a
target entropy and to a limit on how often a source is repeated. The weights are realised as
budgeted block permutations: a source's documents are dealt into blocks, each epoch takes the blocks in a
new order, and the last one stops at the source's budget. Blocks number about the root of the source's
documents, and so do the documents of a block, so a source of any size is ordered in small pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.text import flat, slices, word_bounds
from lodestar.session import cut

#: Parts the exponent's interval is cut into by each pass over the sources, and passes.
PARTS, PASSES = 64, 6


@dataclass(frozen=True)
class Temperature:
    exponent: float
    budget: float  # tokens
    normaliser: float  # sum of share ** exponent
    tokens: float  # of all sources

    def weight(self, tokens: Column) -> Column:
        return F.pow(tokens / self.tokens, F.lit(self.exponent)) / self.normaliser


def _unit(docs: DataFrame) -> list[Column]:
    """What names a document: its id, a hash of id and text, and its source."""
    plain = F.coalesce("text", F.lit(""))
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", plain).alias("tie"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")]


def count_tokens(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` (null as ``''``) and ``tokens`` (words between ASCII white space) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, _, row = word_bounds(*flat(batch.column("text")))
            n = np.bincount(row, minlength=len(batch)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(n), batch.column("tie")],
                                             names=["doc_id", "source", "tokens", "tie"])

    rows = docs.select(*_unit(docs), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, source string, tokens long, tie long")


def _entropies(sources: DataFrame, total: float, exponents: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent: entropy of the weights, the normaliser, and the largest weight over share."""
    each = sources.select((F.col("tokens") / total).alias("s"), F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    power = F.pow("s", "a")
    rows = each.groupBy("a").agg(
        F.sum(power).alias("z"), F.sum(power * F.col("a") * F.log("s")).alias("d"), F.max(power / F.col("s")).alias("r")).collect()
    found = {r["a"]: (np.log(r["z"]) - r["d"] / r["z"], r["z"], r["r"] / r["z"]) for r in rows}
    return [found[a] for a in exponents]


def find_exponent(sources: DataFrame, budget: float, flatten: float, max_epochs: float | None) -> Temperature | None:
    """The least exponent in [0, 1] whose weights are no flatter than asked and repeat no source too often.

    ``flatten`` places the target entropy between that of the token shares (0) and of equal weights (1).
    Each pass evaluates ``PARTS`` exponents over the table of sources and keeps the part in which the
    answer lies. None without tokens.
    """
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return None
    (flat_entropy, *_), (own, one, _) = _entropies(sources, total, [0.0, 1.0])
    target = own + flatten * (flat_entropy - own)

    def holds(found: tuple[float, float, float]) -> bool:
        entropy, _, repeated = found
        return entropy <= target + 1e-12 and (max_epochs is None or repeated * budget / total <= max_epochs + 1e-12)

    low, high, norm = 0.0, 1.0, one
    for _ in range(PASSES):
        grid = [low + (high - low) * i / PARTS for i in range(PARTS + 1)]
        values = _entropies(sources, total, grid)
        k = next((i for i, v in enumerate(values) if holds(v)), PARTS)
        low, high, norm = grid[max(k - 1, 0)], grid[k], values[k][1]
        if k == 0:
            break
    return Temperature(high, budget, norm, float(total))


def plan(docs: DataFrame, flatten: float = 0.5, max_epochs: float | None = 4.0, budget: float | None = None,
         out_blocks: int = 64, seed: int = 1) -> DataFrame:
    """The mixture: one row for each time a document is taken.

    ``doc_id``, ``tie`` (hash of id and text, for joining), ``source``, ``tokens``, ``weight`` of the source, ``epoch`` from 0,
    ``position`` in [0, 1) and ``out_block``. Sorted by position, every stretch of the mixture holds the
    sources in their weights. ``budget`` is in tokens (all of them by default). A source gets its weight's share of it, up to the one
    document that crosses the line. A null source counts as ``''``; a source without any token has weight 0 and is not
    taken; an empty text is taken with the documents around it. Rows that repeat id, source and text are one document of
    all their tokens, taken together. Where even the token shares repeat a
    source more often than ``max_epochs`` (a budget above so many times all tokens) the shares are kept.
    """
    units = count_tokens(docs).groupBy("doc_id", "tie", "source").agg(F.sum("tokens").alias("tokens"))
    rows = cut(units)
    sources = cut(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).filter("tokens > 0"))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    found = find_exponent(sources, float(total if budget is None else budget), flatten, max_epochs)
    if found is None:
        found = Temperature(1.0, 0.0, 1.0, 1.0)
    weight = found.weight(F.col("tokens"))
    quotas = sources.select("source", F.col("tokens").alias("of_source"), weight.alias("weight"), (weight * found.budget).alias("quota"),
                            F.ceil(F.sqrt("docs")).cast("int").alias("blocks"))
    # Hot sources: the table of sources is small beside the rows, and what follows is keyed by block too.
    dealt = rows.join(quotas, "source").withColumn("block", F.pmod("tie", F.col("blocks")).cast("int"))
    last = F.ceil(F.col("quota") / F.col("of_source")).cast("int") - 1
    taken = dealt.withColumn("epoch", F.explode(F.when(F.col("quota") > 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))))
    key = ["source", "epoch", "block"]
    by_block = Window.partitionBy("source", "epoch").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = taken.groupBy(*key).agg(F.sum("tokens").alias("t")).withColumn("turn", F.xxhash64("block", "epoch", F.lit(seed)))
    blocks = blocks.select(*key, F.coalesce(F.sum("t").over(by_block), F.lit(0)).alias("before"))
    in_block = Window.partitionBy(*key).orderBy(F.xxhash64("tie", "epoch", F.lit(seed)), "tie", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = taken.withColumn("inside", F.coalesce(F.sum("tokens").over(in_block), F.lit(0))).join(blocks, key)
    start = F.col("epoch") * F.col("of_source") + F.col("before") + F.col("inside")
    position = (start / F.col("quota")).alias("position")
    return placed.filter(start < F.col("quota")).select(
        "doc_id", "tie", "source", "tokens", "weight", "epoch", position, F.floor(position * out_blocks).cast("int").alias("out_block"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The taken documents with all columns of ``docs``, a row for each time (see ``plan`` for the options)."""
    times = plan(docs, **options).groupBy("doc_id", "tie", "source").agg(F.count(F.lit(1)).cast("int").alias("times"))
    whole = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), *_unit(docs))
    same = (F.col("w.tie") == F.col("t.tie")) & (F.col("w.source") == F.col("t.source")) & F.col("w.doc_id").eqNullSafe(F.col("t.doc_id"))
    drawn = whole.alias("w").join(times.alias("t"), same).select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return drawn.select(*(F.col("row")[c].alias(c) for c in docs.columns))
