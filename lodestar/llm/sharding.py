"""Sharding by histogram sort: shards of nearly equal bytes, found without sorting.

Documents are ordered by (hash of the text, hash of id and text). The exact bytes below candidate
boundaries of that order are counted over all partitions; only the parts that hold a target are
probed further, until each boundary is within the tolerance. Equal texts share the first half of the key, so they
stay together unless their group is larger than the tolerance and a boundary falls into it: then
the second half cuts it. The driver sees one sum per probe, never a key of a document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.ranks import cuts_at_or_below
from lodestar.session import cut

#: Bits of the key that a round of probes refines: 1024 probes for each boundary that is open.
PROBE_BITS = 10
_KEY_BITS = 128
_LEAST = -(1 << 63)


@dataclass(frozen=True)
class Splitters:
    """Ascending boundaries (both halves of the key); shard s starts at boundary s - 1."""

    keys: list[tuple[int, int]]

    def shard(self) -> Column:
        literal = [F.struct(F.lit(a).alias("key1"), F.lit(b).alias("key2")) for a, b in self.keys]
        return cuts_at_or_below(F.struct("key1", "key2"), literal)


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (bytes plus 1), ``text_crc32`` and the key of each row; a null text is empty."""
    plain = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(plain) + 1).cast("long").alias("size"),
        F.crc32(plain).alias("text_crc32"),
        F.xxhash64(plain).alias("key1"),
        F.xxhash64("doc_id", plain).alias("key2"),
    )


def _prefix(depth: int) -> list[Column]:
    """The first ``depth`` bits of the key, as one number or as first half and a number."""
    if depth <= 64:
        return [F.shiftright("key1", 64 - depth).alias("p1"), F.lit(0).cast("long").alias("p2")]
    return [F.col("key1").alias("p1"), F.shiftright("key2", _KEY_BITS - depth).alias("p2")]


def _start(depth: int, p1: int, p2: int) -> tuple[int, int]:
    """The smallest key with this prefix."""
    return (p1 << (64 - depth), _LEAST) if depth <= 64 else (p1, p2 << (_KEY_BITS - depth))


def find_splitters(keys: DataFrame, shards: int, tolerance: float) -> Splitters:
    """Boundaries whose exact bytes below are within ``tolerance`` (share of a shard) of j/shards of all.

    A boundary is also settled when a single row is left to choose from, or rows that are the same in id and text.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / shards
    # Target number -> bytes below its open block; all open blocks are probed to the same depth.
    open_blocks: dict[tuple[int, int] | None, list[tuple[int, int]]] = {None: [(j, 0) for j in range(1, shards)]} if total else {}
    found: dict[int, tuple[int, int]] = {}
    depth = 0
    while open_blocks:
        before, depth = depth, min(depth + PROBE_BITS, 64 if depth < 64 else _KEY_BITS)
        rows = keys
        if before:
            inside = [(F.col("p1") == a) & (F.col("p2") == b) for a, b in open_blocks]
            rows = keys.select("*", *_prefix(before)).filter(_any(inside)).drop("p1", "p2")
        sums = rows.groupBy(*_prefix(depth)).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
        parts: dict[tuple[int, int] | None, list] = {}
        for row in sorted(sums, key=lambda r: (r["p1"], r["p2"])):
            parts.setdefault(_parent((row["p1"], row["p2"]), before, depth), []).append(row)
        still: dict = {}
        for block, targets in open_blocks.items():
            for j, below in targets:
                goal = total * j / shards
                for row in parts[block]:
                    here = (row["p1"], row["p2"])
                    if below + row["size"] >= goal or row is parts[block][-1]:
                        left, right = goal - below, below + row["size"] - goal
                        if min(abs(left), abs(right)) <= allowed or row["n"] == 1 or depth == _KEY_BITS:
                            key = _start(depth, *here)
                            found[j] = key if abs(left) <= abs(right) else _after(depth, *here)
                        else:
                            still.setdefault(here, []).append((j, below))
                        break
                    below += row["size"]
        open_blocks = still
    return Splitters([found[j] for j in sorted(found)])


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _parent(prefix: tuple[int, int], before: int, depth: int) -> tuple[int, int] | None:
    p1, p2 = prefix
    if not before:
        return None
    if depth <= 64:
        return p1 >> (depth - before), 0
    return (p1, 0) if before == 64 else (p1, p2 >> (depth - before))


def _after(depth: int, p1: int, p2: int) -> tuple[int, int]:
    """The smallest key above all keys with this prefix."""
    high = (1 << 63) - 1
    if depth <= 64:
        a = (p1 + 1) << (64 - depth)
        return (a, _LEAST) if a <= high else (high, high)
    b = (p2 + 1) << (_KEY_BITS - depth)
    return (p1, b) if b <= high else ((p1 + 1, _LEAST) if p1 < high else (high, high))


def shard_bytes(docs: DataFrame, shards: int = 16, tolerance: float = 0.001) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` for each row.

    The law is ``bytes``: every boundary is within ``tolerance`` of a shard's share, or as near as
    whole documents allow. Slots number the rows of a shard from 0 without gaps; they are counted in pieces of about the root of
    a shard's rows, so no task sees a whole shard. ``grown_shard`` is null, as it has no meaning
    under this law. A null text has size 1; null or repeated ids are rows like others; an empty table gives an
    empty table.
    """
    keys = cut(keyed(docs))
    rows = keys.count()
    placed = keys.withColumn("shard", find_splitters(keys, shards, tolerance).shard())
    pieces = max(1, math.isqrt(rows // shards))
    placed = placed.withColumn("piece", F.pmod("key2", F.lit(pieces)).cast("int"))
    counts = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "piece").orderBy("key2", "key1", "doc_id")
    numbered = placed.withColumn("nth", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, tolerance: float = 0.001, files: int = 1) -> None:
    """Write whole rows into ``shard=0`` ... below ``path``: one exchange, ``files`` files a shard."""
    keys = cut(keyed(docs).select("key1", "key2", "size"))
    shard = find_splitters(keys, shards, tolerance).shard()
    plain = F.coalesce("text", F.lit(""))
    keyed_rows = docs.select("*", F.xxhash64(plain).alias("key1"), F.xxhash64("doc_id", plain).alias("key2"))
    rows = keyed_rows.withColumn("shard", shard).withColumn("piece", F.pmod("key2", F.lit(files)).cast("int"))
    placed = rows.repartitionById(shards * files, F.col("shard") * files + F.col("piece"))
    placed.drop("key1", "key2", "piece").write.partitionBy("shard").parquet(path)
