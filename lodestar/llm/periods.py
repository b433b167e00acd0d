"""Periodic runs: stretches of words that repeat with a period, found by splitting texts at words too rare for any run.

A run of period q has at least ``4 * q`` words, so each of its words occurs in it at least four
times. A word that occurs less often within a segment lies in no run of it and splits it. What
is left is split again by its own counts until no segment changes: prose falls apart in a few
rounds, and only repetitive stretches survive. These are scanned by lag: at lag q a run is a
maximal stretch of words that equal the word q places on.

Not every lag is tried at every word. For lags from Q to 2Q - 1 a run holds a checkpoint (a
multiple of Q) within its first Q words, followed by 2Q words of the run. Where these 2Q words start
again for the first time is the period: an earlier start would give the run a smaller one. So one
comparison per word and power of two names all lags worth scanning, and long texts cost n log n.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.text import flat, names, slices, word_bounds

#: A run has at least so many periods and so many words.
PERIODS, SHORTEST = 4, 6

#: A round of splitting that takes less than this share of the words it looks at ends the recursion: scanning costs
#: less than another round then. Splitting only ever removes words of no run, so results do not depend on it.
WORTH = 1 / 64


def surviving(words: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that recursive splitting leaves, and the segment of each; ``segment`` ascends along ``words``."""
    done_at, done_of = [], []
    at, of, fresh = np.arange(len(words)), segment, 0
    _, word = np.unique(words, return_inverse=True)
    kinds = int(word.max(initial=0)) + 1
    while len(at):
        # Segments that are too short, then words too rare within their segment.
        begin = np.concatenate([[True], of[1:] != of[:-1]])
        number = np.cumsum(begin) - 1
        size = np.bincount(number)
        _, pair, count = np.unique(number * kinds + word[at], return_inverse=True, return_counts=True)
        stay = (count[pair] >= PERIODS) & (size[number] >= SHORTEST)
        whole = np.bincount(number, stay, len(size)) == size
        settled = whole[number]
        taken = len(at) - int(stay.sum())
        if taken < WORTH * len(at):
            settled = stay
        # What remains of a changed segment is cut where positions are no longer consecutive.
        gap = np.ones(len(at), bool)
        gap[1:] = begin[1:] | ~stay[:-1]
        own = np.cumsum(gap) - 1 + fresh
        fresh = int(own[-1]) + 1
        done_at.append(at[settled])
        done_of.append(own[settled])
        go = stay & ~settled
        at, of = at[go], own[go]
    if not done_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, of = np.concatenate(done_at), np.concatenate(done_of)
    order = np.argsort(at, kind="stable")
    at, of = at[order], of[order]
    return at, np.cumsum(np.concatenate([[True], of[1:] != of[:-1]])) - 1 if len(of) else of


class Blocks:
    """Exact numbers for all blocks of 1, 2, 4, ... words: equal blocks of a length have the same number."""

    def __init__(self, words: np.ndarray, longest: int) -> None:
        self.level = [np.unique(words, return_inverse=True)[1].astype(np.int32)]
        while 1 << len(self.level) <= longest:
            half, below = 1 << (len(self.level) - 1), self.level[-1]
            pair = below[:-half].astype(np.int64) * (int(below.max()) + 1) + below[half:]
            self.level.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words, ``limit`` at most, agree from ``a`` and ``b`` on (or before them)."""
        length = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.level))):
            some = np.arange(len(a))
            while len(some):
                some = some[length[some] + (1 << k) <= limit[some]]
                step = -length[some] - (1 << k) if back else length[some]
                some = some[self.level[k][a[some] + step] == self.level[k][b[some] + step]]
                length[some] += 1 << k
                if k < len(self.level) - 1:
                    break
        return length


def runs_of(words: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs, by start and period. Runs do not leave their segment.

    ``words`` are 64-bit names, ``segment`` numbers the documents (or parts) they belong to, ascending.
    A run that reaches the edge of a surviving segment ends there: the next word occurs too rarely to be in it.
    """
    at, of = surviving(words, segment)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    last = np.append(first[1:], len(at))[of]  # for each place the end of its segment
    inner = np.arange(len(at)) - first[of]
    longest = int((last - first[of]).max())
    blocks = Blocks(words[at], longest // 2)
    found = []
    size = 1
    while PERIODS * size <= longest:
        check = np.flatnonzero((inner % size == 0) & (last - np.arange(len(at)) >= (PERIODS - 1) * size))
        begin, lag = _next_starts(blocks.level[size.bit_length()], check, last[check] - 2 * size, size)
        # Scan the lag both ways from the checkpoint.
        ahead = blocks.common(begin, begin + lag, last[begin] - begin - lag)
        before = blocks.common(begin, begin + lag, inner[begin], back=True)
        s, e = begin - before, begin + ahead + lag
        good = e - s >= np.maximum(SHORTEST, PERIODS * lag)
        found.append((s[good], e[good], lag[good]))
        size *= 2
    s, e, q = (np.concatenate(x) for x in zip(*found))
    # One stretch may show at several checkpoints, and at multiples of its period: the smallest lag is the period.
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[new], e[new], q[new]
    order = np.lexsort((q, s))
    return at[s[order]], (e - s)[order], q[order]


def _next_starts(block: np.ndarray, check: np.ndarray, final: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Checkpoints whose block of ``2 * size`` words next starts ``size`` to ``2 * size - 1`` words on, and that lag."""
    lag = np.zeros(len(check), np.int64)
    todo = np.arange(len(check))
    if size <= 32:  # many short searches: all checkpoints together, lag by lag
        for step in range(1, 2 * size):
            todo = todo[check[todo] + step <= final[todo]]
            hit = block[check[todo] + step] == block[check[todo]]
            lag[todo[hit]] = step
            todo = todo[~hit]
    else:  # few long ones: all lags together, checkpoint by checkpoint
        for i in todo:
            c = check[i]
            hits = np.flatnonzero(block[c + 1 : min(c + 2 * size, final[i] + 1)] == block[c])
            lag[i] = hits[0] + 1 if len(hits) else 0
    keep = lag >= size
    return check[keep], lag[keep]


def repeat_tails(doc_ids: list, counts: np.ndarray) -> np.ndarray:
    """For each word of a slice the place of the word that takes its place within its text.

    Of one text in ten, drawn by the CRC-32 h of the decimal id, the words from ``a`` on repeat the first ``p`` of
    them: g = h // 10, a = g % n, p = 1 + (n - a) // (3 + g % 8). A null id is never drawn.
    """
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.cumsum(counts) - counts
    for row, (doc_id, n) in enumerate(zip(doc_ids, counts)):
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n > 0:
            g = h // 10
            a = g % int(n)
            p = 1 + (int(n) - a) // (3 + g % 8)
            place[begin[row] + a : begin[row] + n] = a + np.arange(int(n) - a) % p
    return place


def _dropped(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Marks the words that a run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step[:-1]) > 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Words joined by one space."""
    if not len(starts):
        return b""
    size = ends - starts + 1
    stop = np.cumsum(size)
    index = np.arange(int(stop[-1])) + np.repeat(starts - (stop - size), size)
    out = data[index]
    out[stop - 1] = 32
    return out[:-1].tobytes()


_FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_dropped", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()),
           ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
           ("collapsed_sha256", pa.string())]


def collapse_runs(docs: DataFrame, repeated_tails: bool = False, with_text: bool = False) -> DataFrame:
    """Find the runs of each text and drop the words that repeat a run's first period.

    A run is a stretch of words ``[^\\x20\\x09-\\x0D]+`` with smallest period q, at least ``max(6, 4 * q)`` long, that no
    neighbouring word extends keeping its period. Returns per row ``doc_id``, ``n_words``, ``n_dropped``, ``n_runs``,
    of the longest run (ties: smallest start, then period; without a run four nulls) ``start``, ``length``, ``period``,
    ``exponent_milli``, the SHA-256 of all runs and of the kept words joined by one space, and with ``with_text`` the runs
    (``runs``, structs) and ``collapsed`` text. ``repeated_tails`` first plants a repetition into one text in ten
    (see ``repeat_tails``). A null text has no words; a null or repeated ``doc_id`` is returned as it is; other columns are ignored;
    an empty table gives an empty table. Words are told apart by 64-bit names.
    """
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema(_FIELDS + [("runs", run_type), ("collapsed", pa.string())] * with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            starts, ends, row = word_bounds(data, offsets)
            counts = np.bincount(row, minlength=len(batch))
            ids = batch.column("doc_id").to_pylist()
            if repeated_tails:
                place = repeat_tails(ids, counts) + np.repeat(np.cumsum(counts) - counts, counts)
                starts, ends = starts[place], ends[place]
            start, length, period = runs_of(names(data, starts, ends), row)
            of = row[start]
            cut, begin = np.searchsorted(of, np.arange(len(batch) + 1)), np.cumsum(counts) - counts
            out = []
            for i, n in enumerate(counts):
                b, own = int(begin[i]), slice(cut[i], cut[i + 1])
                s, size, q = start[own] - b, length[own], period[own]
                words = slice(b, b + int(n))
                w0, w1 = starts[words], ends[words]
                if len(s):
                    kept = ~_dropped(int(n), s, size, q)
                    w0, w1 = w0[kept], w1[kept]
                listed = list(zip(s.tolist(), size.tolist(), q.tolist()))
                best = min(listed, key=lambda r: (-r[1], r[0], r[2])) if listed else (None, None, None)
                text = _joined(data, w0, w1)
                digest = hashlib.sha256("".join(f"{a},{m},{p}\n" for a, m, p in listed).encode()).hexdigest()
                values = [ids[i], int(n), int(n) - len(w0), len(listed), *best, 1000 * best[1] // best[2] if listed else None,
                          digest, hashlib.sha256(text).hexdigest()]
                if with_text:
                    values += [[dict(zip(("start", "length", "period"), r)) for r in listed], text.decode()]
                out.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    types = ", ".join(f"{name} {'string' if kind == pa.string() else 'long'}" for name, kind in _FIELDS)
    types += ", runs array<struct<start: long, length: long, period: long>>, collapsed string" * with_text
    return texts.mapInArrow(run, types)
