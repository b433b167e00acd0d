"""Substring deduplication by recompression.

Every round names runs of equal symbols, then pairs of a left and a right symbol, where the side
of a symbol is a bit of its name. A name is a hash of what it stands for, so it is the same in
all documents and no table of names is needed; equal passages carry equal symbols, except near
their ends. For every symbol the interval of words that its making depends on is kept. A window
of words is represented by the symbol of least priority whose interval lies inside it, so equal
windows have equal representatives at equal places.

1. Count representatives over the corpus. A window whose representative occurs once is unique.
2. Windows of representatives that occur again are compared by a further fingerprint, next to
   the 64 bits of the representative's words: 128 bits in all.

Within a slice of documents copies are found at once, and a key leaves a slice only once, so the
rows of the most frequent passage grow with the number of slices, not of its copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.text import Ranges, chain, flat, mix, names, seeded, signed, slices, word_bounds

#: Rounds of naming. After three a symbol stands for 2.4 words on average, its interval for about 12.
ROUNDS = 3

_SPOT = "key long, k1 long, k2 long, at int, seen long, rel array<int>, fps array<long>"
_SPOT_ARROW = pa.schema([("key", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int32()),
                         ("seen", pa.int64()), ("rel", pa.list_(pa.int32())), ("fps", pa.list_(pa.int64()))])


def _name_runs(symbols: dict, number: int) -> dict:
    """Replace maximal runs of one symbol by a symbol. Being alone depends on both neighbours."""
    name, n = symbols["name"], len(symbols["name"])
    first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    length = np.diff(np.append(first, n))
    base = name[first]
    return {
        "name": np.where(length > 1, chain(seeded(base, 2 * number), length.astype(np.uint64)), base),
        "lo": symbols["lo"][np.maximum(first - 1, 0)],
        "hi": symbols["hi"][np.minimum(first + length, n - 1)],
        "wall": symbols["wall"][first],
    }


def _name_pairs(symbols: dict, number: int) -> dict:
    """Replace each left symbol followed by a right one by a symbol. Staying alone depends on one neighbour."""
    name, lo, hi, wall = (symbols[k] for k in ("name", "lo", "hi", "wall"))
    left = seeded(name, 2 * number + 1) < np.uint64(1 << 63)
    pair = np.zeros(len(name), bool)
    pair[:-1] = left[:-1] & ~left[1:] & ~wall[:-1] & ~wall[1:]
    second = np.zeros(len(name), bool)
    second[1:] = pair[:-1]
    before, after = np.roll(lo, 1), np.roll(hi, -1)
    before[0], after[-1] = lo[0], hi[-1]
    kept = ~second
    return {
        "name": np.where(pair, chain(name, np.roll(name, -1)), name)[kept],
        "lo": np.where(left, lo, before)[kept],
        "hi": np.where(left, after, hi)[kept],
        "wall": wall[kept],
    }


def parse(word_names: np.ndarray, walls: np.ndarray, rounds: int = ROUNDS) -> dict:
    """Symbols of a slice after some rounds, in order: name, interval ``[lo, hi)`` it depends on, wall."""
    place = np.arange(len(word_names))
    symbols = {"name": word_names, "lo": place, "hi": place + 1, "wall": walls}
    for number in range(rounds):
        symbols = _name_pairs(_name_runs(symbols, number), number)
    return symbols


def _representatives(symbols: dict, starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """For each window the index of its symbol of least priority, or -1 where no interval fits inside."""
    lo, hi = symbols["lo"], symbols["hi"]
    first = np.concatenate([[0], np.cumsum(np.bincount(lo, minlength=size))])[starts]
    last = np.cumsum(np.bincount(hi, minlength=size + 1))[starts + width]
    count = last - first
    bits = np.uint64(max(1, len(lo).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    level = [(seeded(symbols["name"], 99) & ~low) | np.arange(len(lo), dtype=np.uint64)]
    while 2 << (len(level) - 1) <= max(1, int(count.max(initial=0))):
        half = 1 << (len(level) - 1)
        level.append(np.minimum(level[-1][:-half], level[-1][half:]))
    best = np.full(len(starts), np.iinfo(np.uint64).max, np.uint64)
    for k, least in enumerate(level):
        pick = np.flatnonzero((count >> k > 0) & (count >> (k + 1) == 0) if k < len(level) - 1 else count >> k > 0)
        best[pick] = np.minimum(least[first[pick]], least[last[pick] - (1 << k)])
    return np.where(count > 0, (best & low).astype(np.int64), -1)


class _Slice:
    """Windows of a slice of documents, grouped into spots: consecutive windows of one representative."""

    def __init__(self, column: pa.Array, width: int) -> None:
        data, offsets = flat(column)
        starts, ends, row = word_bounds(data, offsets)
        rows = len(offsets) - 1
        counts = np.bincount(row, minlength=rows)
        # A wall with a name of its own stands before each document and after the last.
        size = len(starts) + rows + 1
        walls = np.zeros(size, bool)
        first = np.concatenate([[0], np.cumsum(counts + 1)])
        walls[first] = True
        word_names = np.empty(size, np.uint64)
        word_names[walls] = seeded(np.arange(rows + 1, dtype=np.uint64), 7)
        word_names[~walls] = names(data, starts, ends)
        self.width = width
        fits = np.maximum(counts - width + 1, 0)
        self.row = np.repeat(np.arange(rows), fits)
        in_row = np.arange(len(self.row)) - np.repeat(np.cumsum(fits) - fits, fits)
        self.start = first[self.row] + 1 + in_row
        self._ranges = Ranges(word_names)
        symbols = parse(word_names, walls)
        stand = _representatives(symbols, self.start, width, size)
        change = np.ones(len(stand), bool)
        change[1:] = (stand[1:] != stand[:-1]) | (stand[1:] < 0) | (self.row[1:] != self.row[:-1])
        self.spot = np.flatnonzero(change)  # first window of each spot
        self.at = in_row[self.spot].astype(np.int32)
        self.length = np.diff(np.append(self.spot, len(stand)))
        own = stand[self.spot] < 0
        lo = np.where(own, self.start[self.spot], symbols["lo"][stand[self.spot]])
        hi = np.where(own, self.start[self.spot] + width, symbols["hi"][stand[self.spot]])
        self.key = mix(self._ranges(lo, hi) + own.astype(np.uint64))

    def fingerprints(self, window: np.ndarray) -> np.ndarray:
        return seeded(self._ranges(self.start[window], self.start[window] + self.width), 5)


def _first_seen(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is the first of its kind, and whether its kind occurs again."""
    _, index, inverse, count = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
    first = np.zeros(len(values), bool)
    first[index] = True
    return first, count[inverse] > 1


def _spots(key, k1, k2, at, seen, rel, fps, cuts) -> pa.RecordBatch:
    """Rows for the count; a spot that asks nothing goes anywhere rather than to its key."""
    asks = np.diff(cuts) > 0
    key = np.where(asks, key, chain(chain(k1.view(np.uint64), k2.view(np.uint64)), at.astype(np.uint64)))
    cuts = pa.array(cuts.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(key)), pa.array(k1), pa.array(k2), pa.array(at), pa.array(seen),
         pa.ListArray.from_arrays(cuts, pa.array(rel)), pa.ListArray.from_arrays(cuts, pa.array(signed(fps)))],
        schema=_SPOT_ARROW)


def _ask_representatives(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            part = _Slice(batch.column("text"), width)
            if not len(part.spot):
                continue
            row = part.row[part.spot]
            k1, k2 = (batch.column(k).to_numpy()[row] for k in ("k1", "k2"))
            first, again = _first_seen(part.key)
            keep = first | again
            asks = first[keep]
            cuts = np.concatenate([[0], np.cumsum(asks)])
            yield _spots(part.key[keep], k1[keep], k2[keep], part.at[keep], again[keep].astype(np.int64),
                         np.zeros(cuts[-1], np.int32), np.zeros(cuts[-1], np.uint64), cuts)

    return run


def _ask_windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = batch.column("spots")
            wanted = np.diff(np.append(lists.offsets.to_numpy(), 0)[: len(batch) + 1]) > 0
            if not wanted.any():
                continue
            chosen = batch.filter(pa.array(wanted))
            part = _Slice(chosen.column("text"), width)
            lists = chosen.column("spots")
            row = np.repeat(np.arange(len(chosen)), np.diff(lists.offsets.to_numpy()))
            ask = np.unique((row.astype(np.int64) << 32) | lists.flatten().field("at").to_numpy())
            spot = np.flatnonzero(np.isin((part.row[part.spot].astype(np.int64) << 32) | part.at, ask))
            length = part.length[spot]
            of = np.repeat(np.arange(len(spot)), length)
            rel = np.arange(len(of)) - np.repeat(np.cumsum(length) - length, length)
            fps = part.fingerprints(part.spot[spot][of] + rel)
            first, again = _first_seen(chain(part.key[spot][of], fps))
            seen = np.zeros(len(spot), np.int64)
            np.bitwise_or.at(seen, of[again], np.int64(1) << rel[again])
            cuts = np.concatenate([[0], np.cumsum(np.bincount(of[first], minlength=len(spot)))])
            at_row = part.row[part.spot[spot]]
            k1, k2 = (chosen.column(k).to_numpy()[at_row] for k in ("k1", "k2"))
            yield _spots(part.key[spot], k1, k2, part.at[spot], seen, rel[first].astype(np.int32), fps[first], cuts)

    return run


def _repeated(asked: DataFrame) -> DataFrame:
    """Spots by document, with a bit for each window (or representative) that occurs again."""
    total = Window.partitionBy("key", "fp")
    known: Column = F.expr("shiftright(seen, rel) & 1L")
    counted = (
        asked.repartition("key")
        .select("key", "k1", "k2", "at", "seen", F.expr("inline_outer(arrays_zip(rel, fps))").alias("rel", "fp"))
        .withColumn("n", F.sum(1 + known).over(total))
    )
    bits = F.bit_or(F.expr("if(fp is not null and n >= 2, shiftleft(1L, rel), 0L)")).bitwiseOR(F.max("seen"))
    by_spot = counted.groupBy("key", "k1", "k2", "at").agg(bits.alias("bits")).filter("bits <> 0")
    return by_spot.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "bits")).alias("spots"))


def _rewrite(width: int, with_text: bool):
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("kept_text", pa.string())] * with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n_words, n_removed, digest, kept_text = [], [], [], []
            for text, spots in zip(batch.column("text").cast(pa.binary()), batch.column("spots")):
                words = text.as_py().split()  # bytes split on exactly the white space meant
                total, spots = len(words), spots.values if spots.is_valid else None
                if spots is not None and len(spots):
                    at, bits = (spots.field(k).to_numpy() for k in ("at", "bits"))
                    which, rel = np.nonzero((bits[:, None] >> np.arange(width)) & 1)
                    step = np.zeros(total + width + 1, np.int32)
                    np.add.at(step, at[which] + rel, 1)
                    np.add.at(step, at[which] + rel + width, -1)
                    words = list(compress(words, np.cumsum(step)[:total] == 0))
                joined = b" ".join(words)
                n_words.append(total)
                n_removed.append(total - len(words))
                digest.append(hashlib.sha256(joined).hexdigest())
                if with_text:
                    kept_text.append(joined.decode())
            columns = [batch.column("doc_id"), n_words, n_removed, digest] + [kept_text] * with_text
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def remove_repeats(docs: DataFrame, width: int = 35, with_text: bool = False) -> DataFrame:
    """Remove every word covered by a window of ``width`` words that also starts anywhere else.

    Reads ``doc_id`` and ``text`` (other columns are ignored) and returns per row ``doc_id``,
    ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by one space) and, if
    asked for, ``kept_text``. A null text has no words; texts shorter than the window are kept
    whole; a null or repeated ``doc_id`` is returned as it is, and each row counts as a document
    of its own. An empty table gives an empty table.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("k1"),
        F.xxhash64("text").alias("k2"),
    )
    candidates = _repeated(texts.select("k1", "k2", "text").mapInArrow(_ask_representatives(width), _SPOT))
    # Both joins read the same columns, so the texts are shuffled once.
    columns = ["doc_id", "k1", "k2", "text", "spots"]
    with_spots = texts.join(candidates, ["k1", "k2"], "inner").select(*columns)
    confirmed = _repeated(with_spots.mapInArrow(_ask_windows(width), _SPOT))
    result = texts.join(confirmed, ["k1", "k2"], "left").select(*columns)
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return result.mapInArrow(_rewrite(width, with_text), out)
