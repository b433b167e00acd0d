"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Every paragraph is hashed to a wide vector. ``WIDE`` lanes of 64 bits, each a hash of the paragraph's bytes with a key
of its own, are added modulo 2^64, for equality. ``THIN`` lanes are added modulo 2^16, for likeness: the sum of the
paragraph's pieces, each of them +1 or -1 in every lane. A piece ends after a word that one in ``PIECE`` words is like, so
pieces do not depend on what stands elsewhere, and texts of a single sentence have some too. A fingerprint is
the sum over paragraphs, so order does not matter, and paragraphs are added or taken away by
adding or subtracting their vectors. The squared length of a difference of thin lanes, divided by
their number, estimates the size of the difference of two multisets of pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.ranks import cuts_at_or_below
from lodestar.llm.text import flat, names, seeded, slices

WIDE, THIN = 4, 128
#: Words of a piece on average.
PIECE = 3
#: Key of each wide lane's hash, and of the hashes of words and pieces.
KEYS, WORD_KEY, PIECE_KEY = [101, 211, 307, 401], 503, 601


def signs(piece_names: np.ndarray) -> np.ndarray:
    """Thin vectors of pieces: +1 or -1 in every lane."""
    bits = np.stack([seeded(piece_names, 31 + k) for k in range(THIN // 64)], 1)
    return np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little").view(np.int8) * np.int8(2) - np.int8(1)


def _bounds(inside: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches inside, which also end at edges; nothing is inside at the last place."""
    before = np.concatenate([[False], inside[:-1]])
    return np.flatnonzero(inside & (~before | edge)), np.flatnonzero(before & (~inside | edge))


def units(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``WIDE`` names of each paragraph of all rows, its row, names of all pieces, their rows.

    A paragraph ends at a line end or after a full stop, question or exclamation mark before white space; empty
    ones do not count. A paragraph of spaces alone has no piece.
    """
    data, offsets = flat(column)
    body = data[: int(offsets[-1])]
    line = (body == 10) | (body == 13)
    stop = np.zeros(len(body), bool)
    if len(body):
        stop[1:] = ((body[:-1] == 46) | (body[:-1] == 33) | (body[:-1] == 63)) & ((body[1:] == 32) | (body[1:] == 9))
        stop[offsets[:-1][offsets[:-1] < len(body)]] = False  # the row before does not matter
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    starts, ends = _bounds(np.append(~(line | stop), False), edge)
    own = np.stack([names(data, starts, ends, key) for key in KEYS], 1)
    word, word_end = _bounds(np.append(~(line | stop | (body == 32) | (body == 9)), False), edge)
    # A piece's last word: a chosen one, or the last of its paragraph.
    of = np.searchsorted(starts, word, "right")
    last = names(data, word, word_end, WORD_KEY) % np.uint64(PIECE) == 0
    last |= np.append(of[1:] != of[:-1], True)[: len(last)]
    first = np.concatenate([[True], last[:-1]])[: len(last)]
    piece, piece_end = word[first], word_end[last]
    row = lambda at: np.searchsorted(offsets, at, "right") - 1
    return own, row(starts), names(data, piece, piece_end, PIECE_KEY), row(piece)


def sums(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all rows: wide lanes (uint64) and thin lanes (int16)."""
    own, row, pieces, piece_row = units(column)
    wide, thin = np.zeros((len(column), WIDE), np.uint64), np.zeros((len(column), THIN), np.int16)
    first = np.flatnonzero(np.diff(row, prepend=-1))
    if len(first):
        wide[row[first]] = np.add.reduceat(own, first, axis=0)
    for start in range(0, len(pieces), 1 << 16):  # so many vectors at a time bound the memory, also within a long text
        at = piece_row[start : start + (1 << 16)]
        some = np.flatnonzero(np.diff(at, prepend=-1))
        thin[at[some]] += np.add.reduceat(signs(pieces[start : start + (1 << 16)]), some, axis=0, dtype=np.int16)
    return wide, thin


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 from thin lanes: one less the share of pieces that only one side has; 1 if both are empty."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    apart = (a - b).astype(np.int16).astype(np.int64)  # modulo 2^16, nearest to zero
    size = (a * a).sum(1) + (b * b).sum(1)
    return np.where(size > 0, np.clip(1 - (apart * apart).sum(1) / np.maximum(size, 1), 0, 1), 1.0)


def as_text(wide: np.ndarray, thin: np.ndarray) -> list[str]:
    packed = np.concatenate([wide.astype(">u8").view(np.uint8), thin.astype(">i2").view(np.uint8)], 1)
    return [row.tobytes().hex() for row in packed]


def from_text(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(text)
    return np.frombuffer(raw, ">u8", WIDE).astype(np.uint64), np.frombuffer(raw, ">i2", THIN, WIDE * 8).astype(np.int16)


def add(a: str, b: str) -> str:
    """Fingerprint of both multisets together."""
    (wa, ta), (wb, tb) = from_text(a), from_text(b)
    return as_text((wa + wb)[None], (ta + tb)[None])[0]


def subtract(a: str, b: str) -> str:
    """Fingerprint of ``a`` without the paragraphs of ``b``."""
    (wa, ta), (wb, tb) = from_text(a), from_text(b)
    return as_text((wa - wb)[None], (ta - tb)[None])[0]


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars`` (code points) and ``fingerprint`` of each row; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            size = [len(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_chars": size, "fingerprint": as_text(*sums(batch.column("text")))})

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string")


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows in descending id order within ranges of ids, each range followed by the first row of the next.

    ``range``, ``doc_id``, ``text``, ``peek``: rows marked ``peek`` only serve as the successor of
    the row before. After the last range comes the first again. Ids are cut at approximate
    quantiles, so every range is a bounded share of the rows; only ids are read for that.
    """
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("o"))
    ranges = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = ids.agg(F.percentile_approx("o", [i / ranges for i in range(1, ranges)] or [0.5], 10000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True) if ranges > 1 else []
    # Ids descend (and their complements ascend), so the range is the number of cuts above the id.
    place = cuts_at_or_below(F.bitwise_not("o"), [F.lit(~c) for c in cuts])
    heads = {r["r"]: r["h"] for r in ids.groupBy(place.alias("r")).agg(F.max("o").alias("h")).collect()}
    order = sorted(heads)
    before = {heads[r]: order[i - 1] for i, r in enumerate(order)}  # the first one's is the last range
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("o", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("range", place)
    peeks = F.create_map(*(F.lit(v) for pair in before.items() for v in pair)) if before else F.lit(None).cast("map<bigint,int>")
    own = F.struct("range", F.lit(False).alias("peek"))
    ahead = F.struct(peeks[F.col("o")].alias("range"), F.lit(True).alias("peek"))
    copies = F.when(peeks[F.col("o")].isNull(), F.array(own)).otherwise(F.array(own, ahead))
    return texts.withColumn("to", F.explode(copies)).select(F.col("to.range").alias("range"), F.col("to.peek").alias("peek"), "o", "doc_id", "text")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range, peek last, id descending; each is compared with the one after it."""
    held: tuple | None = None  # range, id and text of the row that waits for its successor

    def out(pending: list) -> pa.RecordBatch:
        ids, texts, following = (list(x) for x in zip(*pending))
        edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, following)]
        # The text after a row is mostly the next row's own.
        strange = [i for i in range(len(texts)) if i + 1 == len(texts) or following[i] is not texts[i + 1]]
        wide, thin = sums(pa.array(texts + [following[i] for i in strange], pa.large_string()))
        place = np.arange(1, len(texts) + 1)
        place[strange] = len(texts) + np.arange(len(strange))
        changed = sums(pa.array(edited, pa.large_string()))
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array(map(len, texts), pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            "fingerprint": as_text(wide[: len(texts)], thin[: len(texts)]), "edited_fingerprint": as_text(*changed),
            "near_edited": likeness(thin[: len(texts)], changed[1]), "near_next": likeness(thin[: len(texts)], thin[place])})

    for batch in slices(batches, limit=1 << 20):
        pending = []
        for where, peek, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("range", "peek", "doc_id", "text"))):
            if held is not None and held[0] == where:
                pending.append((held[1], held[2], text))
            held = None if peek else (where, doc_id, text)
        if pending:
            yield out(pending)


def edited_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of the text with its last third replaced by the next document's start.

    The next document is the one with the next smaller id, after the last the first; ties are
    ordered by a hash of the text, null ids come last. Texts are shuffled once. ``near_edited`` and ``near_next``
    are the likeness of the fingerprint to the edited text's and to the next document's. A null
    text is empty; a single document follows itself; an empty table gives an empty table.
    """
    placed = with_next(docs, ranges).withColumn("tie", F.xxhash64("text"))
    n = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionById(n, "range").sortWithinPartitions("range", "peek", F.desc("o"), "tie")
    return ordered.select("range", "peek", "doc_id", "text").mapInArrow(
        _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
