"""SentencePiece encoding and decoding with a unigram model: Viterbi over a double-array trie.

The vocabulary is read from a public model file and never trained. A piece's log score is that of
its place in the file (``-ln(place + 2)``, Zipf's law) or the score the file states. Text is encoded with a
space in front and every space as the marker; bytes that no piece covers become byte pieces. Decoding
gives back the very text. No piece holds a marker after other characters, so the best way through a text is
the best way through each of its words with the spaces before it. Words of more than ``LONG`` bytes (languages without spaces,
encoded data) are taken apart further, where no piece reaches across: every way passes there. Distinct
stretches of a slice are solved together, one position at a time; the rare stretch above ``LONGEST`` bytes that
nothing takes apart is solved alone, in blocks that hand on the scores of the last few positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.text import flat, names, slices

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
_MARKER = "▁"
_SPACE = 32
#: Bytes of a word above which it is taken apart, and of a stretch above which it is solved alone.
LONG, LONGEST = 48, 512
#: Positions whose pieces are looked up at once.
_BLOCK = 1 << 18


@dataclass
class Trie:
    """Double array: the child of state s over byte b is ``base[s] + b`` if ``check`` there names s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # number of the piece that ends here, or -1

    @staticmethod
    def build(keys: dict[bytes, int]) -> Trie:
        root: dict = {}
        for key, number in keys.items():
            node = root
            for byte in key:
                node = node.setdefault(byte, {})
            node[-1] = number
        size = 1 << 12
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0], low, top, todo = 0, 1, 0, [(0, root)]
        while todo:
            state, node = todo.pop()
            value[state] = node.get(-1, -1)
            codes = sorted(c for c in node if c >= 0)
            if not codes:
                continue
            while check[low] >= 0:
                low += 1
            slot, tries = low, 0
            while True:  # a place where all children fit: among the first free ones, else behind all
                tries += 1
                if tries == 64:
                    slot = max(top + 1, slot)
                if slot + 512 > len(check):
                    grow = len(check)
                    base += [0] * grow
                    check += [-1] * grow
                    value += [-1] * grow
                at = slot - codes[0]
                if at > 0 and check[slot] < 0 and all(check[at + c] < 0 for c in codes):
                    break
                slot += 1
            base[state] = at
            for c in codes:
                check[at + c] = state
                top = max(top, at + c)
                todo.append((at + c, node[c]))
        pad = [0] * 256, [-1] * 256, [-1] * 256
        return Trie(*(np.array(a + p, np.int32) for a, p in zip((base, check, value), pad)))


@dataclass
class Vocabulary:
    trie: Trie
    score: np.ndarray  # of each piece number
    byte: np.ndarray  # piece number of each byte
    text: np.ndarray  # bytes of all pieces, one after the other
    start: np.ndarray
    longest: int
    whole: bool  # a piece may hold a marker inside, so texts cannot be taken apart at spaces

    @staticmethod
    def of(pieces: list[tuple[str, float]], byte_pieces: dict[int, int], plain: list[int]) -> Vocabulary:
        """``pieces``: text and score by number; ``plain``: numbers of ordinary pieces."""
        as_bytes = [b""] * len(pieces)
        for number in plain:
            as_bytes[number] = pieces[number][0].replace(_MARKER, " ").encode()
        keys = {as_bytes[n]: n for n in reversed(plain) if as_bytes[n]}
        score = np.array([s for _, s in pieces], np.float64)
        least = min((score[n] for n in plain), default=0.0)
        byte = np.full(256, -1, np.int64)
        for value, number in byte_pieces.items():
            byte[value], as_bytes[number] = number, bytes([value])
            score[number] = least - 10
        lengths = [len(b) for b in as_bytes]
        inside = any(" " in pieces[n][0].replace(_MARKER, " ").lstrip(" ") for n in plain)
        return Vocabulary(Trie.build(keys), score, byte, np.frombuffer(b"".join(as_bytes), np.uint8),
                          np.concatenate([[0], np.cumsum(lengths)]), max(map(len, keys), default=1), inside)

    @staticmethod
    def load(path: str = MODEL_FILE, file_scores: bool = False) -> Vocabulary:
        """Read a model file (on the driver; tasks get the arrays, whose size is the vocabulary's)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(model.get_piece_size())
        bytes_ = {int(model.id_to_piece(n)[3:5], 16): n for n in numbers if model.is_byte(n)}
        plain = [n for n in numbers if not (model.is_byte(n) or model.is_control(n) or model.is_unknown(n) or model.is_unused(n))]
        if len(bytes_) < 256:
            raise ValueError("the vocabulary has no piece for some bytes, so not every text could be encoded")
        score = [model.get_score(n) if file_scores else -np.log(n + 2.0) for n in numbers]
        return Vocabulary.of([(model.id_to_piece(n), score[n]) for n in numbers], bytes_, plain)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all rows, one after the other, and where each row begins."""
        data, offsets = flat(column)
        sizes = np.diff(offsets)
        rows = np.flatnonzero(sizes)  # an empty text has no pieces
        # A space before each text.
        begin = offsets[rows] + np.arange(len(rows))
        marked = np.full(int(offsets[-1]) + len(rows) + 16, _SPACE, np.uint8)
        marked[-16:] = 0
        keep = np.ones(len(marked) - 16, bool)
        keep[begin] = False
        marked[:-16][keep] = data[: int(offsets[-1])]
        if self.whole:
            starts = begin
        else:
            space = marked[:-16] == _SPACE
            first = space.copy()
            first[1:] &= ~space[:-1]
            first[begin] = True
            starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(marked) - 16)
        starts = np.union1d(starts, self._crossed(marked, starts, ends))
        ends = np.append(starts[1:], len(marked) - 16)
        _, index, inverse = np.unique(names(marked, starts, ends, 41), return_index=True, return_inverse=True)
        found, cuts = self._solved(marked, starts[index], ends[index])
        count = np.diff(cuts)[inverse]
        at = np.cumsum(count) - count
        ids = found[np.arange(int(count.sum())) + np.repeat(cuts[inverse] - at, count)]
        per_row = np.zeros(len(sizes), np.int64)
        per_row[rows] = np.add.reduceat(count, np.searchsorted(starts, begin)) if len(rows) else 0
        return ids, np.concatenate([[0], np.cumsum(per_row)])

    def _matches(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """By length: the places in ``at`` where a piece of that length starts that ends by ``end``, and its number."""
        which, state = np.arange(len(at)), np.zeros(len(at), np.int64)
        for length in range(1, self.longest + 1):
            inside = at[which] + length <= end[which]
            which, state = which[inside], state[inside]
            nxt = self.trie.base[state] + data[at[which] + length - 1]
            good = (self.trie.check[nxt] == state) & (self.trie.base[state] > 0)
            which, state = which[good], nxt[good].astype(np.int64)
            if not len(which):
                return
            number = self.trie.value[state]
            piece = number >= 0
            yield length, which[piece], number[piece]

    def _crossed(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Positions inside long ranges that no piece reaches across."""
        long = np.flatnonzero(ends - starts > LONG)
        blocks = -(-(ends[long] - starts[long]) // _BLOCK)
        begin = np.repeat(starts[long], blocks) + _BLOCK * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        end = np.repeat(ends[long], blocks)
        size = np.minimum(end - begin, _BLOCK)
        group = (np.cumsum(size) - 1) // _BLOCK
        found, reached = [np.zeros(0, np.int64)], 0
        for some in np.split(np.arange(len(begin)), np.flatnonzero(np.diff(group)) + 1):
            if not len(some):
                continue
            at = np.repeat(begin[some], size[some]) + np.arange(size[some].sum()) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
            reach = at + 1  # a byte piece
            for length, which, _ in self._matches(data, at, np.repeat(end[some], size[some])):
                reach[which] = at[which] + length
            reach = np.maximum.accumulate(np.append(reached, reach))
            found.append(at[reach[:-1] <= at])
            reached = reach[-1]
        return np.concatenate(found)

    def _solved(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all ranges, one after the other, and where each range's begin."""
        alone = np.flatnonzero(ends - starts > LONGEST)
        if not len(alone):
            return self._best(data, starts, ends)
        rest = np.flatnonzero(ends - starts <= LONGEST)
        found, cuts = self._best(data, starts[rest], ends[rest])
        count = np.zeros(len(starts), np.int64)
        count[rest] = np.diff(cuts)
        single = [self._alone(data, starts[i], ends[i]) for i in alone]
        count[alone] = [len(x) for x in single]
        at = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(at[-1], np.int32)
        out[np.arange(len(found)) + np.repeat(at[rest] - cuts[:-1], np.diff(cuts))] = found
        for i, pieces in zip(alone, single):
            out[at[i] : at[i + 1]] = pieces
        return out, at

    def _alone(self, data: np.ndarray, start: int, end: int) -> np.ndarray:
        """Pieces of one long range; the same choice as :meth:`_best`."""
        size, tail = int(end - start), self.longest + 1
        piece, back = np.zeros(size + 1, np.int32), np.zeros(size + 1, np.int32)
        best, last, step = [0.0] + [-np.inf] * self.longest, [0] * tail, [0] * tail
        block = _BLOCK // 8
        for a in range(0, size, block):
            n = min(block, size - a)
            best, last, step = best + [-np.inf] * n, last + [0] * n, step + [0] * n
            at = np.arange(start + a, start + a + n)
            byte = self.byte[data[at]]
            offers = [(np.arange(n), np.zeros(n, np.int64), np.ones(n, np.int64), byte)]
            for length, which, number in self._matches(data, at, np.full(n, end)):
                offers.append((which, np.full(len(which), length), np.full(len(which), length), number))
            where, rank, length, number = (np.concatenate(x) for x in zip(*offers))
            order = np.lexsort((rank, where))
            where, length, number = where[order], length[order], number[order]
            for i, to, score, which, long in zip(where.tolist(), (where + length).tolist(), self.score[number].tolist(), number.tolist(), length.tolist()):
                score += best[i]
                if score > best[to]:
                    best[to], last[to], step[to] = score, which, long
            piece[a : a + n], back[a : a + n] = last[:n], step[:n]
            best, last, step = best[n:], last[n:], step[n:]
        piece[size], back[size] = last[0], step[0]
        out, at = [], size
        while at:
            out.append(piece[at])
            at -= int(back[at])
        return np.array(out[::-1], np.int32)

    def _best(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of greatest total score of each range; of equal totals the one with the longer last piece."""
        size = ends - starts
        order = np.argsort(-size, kind="stable")
        size, begin = size[order], starts[order]
        cell = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        total = int((size + 1).sum())
        best = np.full(total, -np.inf)
        best[cell] = 0
        piece, back = np.zeros(total, np.int32), np.zeros(total, np.int32)
        active = len(size)
        trie = self.trie
        for place in range(int(size[0]) if len(size) else 0):
            while active and size[active - 1] <= place:
                active -= 1
            which = np.arange(active)
            here = best[cell[:active] + place]
            byte = data[begin[:active] + place]
            number = self.byte[byte]
            self._offer(best, piece, back, cell[:active] + place + 1, here + self.score[number], number, 1)
            state = np.zeros(active, np.int64)
            for length in range(1, self.longest + 1):
                nxt = trie.base[state] + data[begin[which] + place + length - 1]
                good = trie.check[nxt] == state
                good &= trie.base[state] > 0
                which, state = which[good], nxt[good].astype(np.int64)
                if not len(which):
                    break
                number = trie.value[state]
                ends_here = np.flatnonzero(number >= 0)
                at = which[ends_here]
                self._offer(best, piece, back, cell[at] + place + length, here[at] + self.score[number[ends_here]], number[ends_here], length)
                more = size[which] > place + length
                which, state = which[more], state[more]
        # Walk back from the ends, all ranges at once.
        at, which = size.copy(), np.arange(len(size))
        steps_of, steps_piece = [], []
        while len(which):
            where = cell[which] + at[which]
            steps_of.append(which)
            steps_piece.append(piece[where])
            at[which] -= back[where]
            which = which[at[which] > 0]
        if not steps_of:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        step = np.repeat(np.arange(len(steps_of)), [len(s) for s in steps_of])
        of = order[np.concatenate(steps_of)]
        sequence = np.lexsort((-step, of))
        return np.concatenate(steps_piece)[sequence], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(size)))])

    @staticmethod
    def _offer(best, piece, back, cell, score, number, length) -> None:
        better = np.flatnonzero(score > best[cell])
        cell = cell[better]
        best[cell], piece[cell], back[cell] = score[better], number[better], length

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows, and where each begins; the space in front is taken away again."""
        size = (self.start[ids + 1] - self.start[ids]).astype(np.int64)
        at = np.cumsum(size) - size
        out = self.text[np.arange(int(size.sum())) + np.repeat(self.start[ids] - at, size)]
        ends = np.concatenate([[0], np.cumsum(size)])[cuts]
        full = np.flatnonzero(np.diff(ends))
        keep = np.ones(len(out), bool)
        keep[ends[full]] = False
        shift = np.zeros(len(ends), np.int64)
        shift[full + 1] = 1
        return out[keep], ends - np.cumsum(shift)


def _strings(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, buffers).cast(pa.large_string())


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row ``doc_id``, ``n_pieces``, ``n_bytes_pieces`` (byte fallbacks), ``ids`` and ``round_trip``.

    ``round_trip`` says that decoding ``ids`` gave the text back. A null text is encoded as the empty
    one, which has no pieces; other columns are ignored; repeated rows are encoded each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(vocabulary) | {"trie": vars(vocabulary.trie)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(**(sent.value | {"trie": Trie(**sent.value["trie"])}))
        fallback = np.zeros(len(own.score), bool)
        fallback[own.byte] = True
        for batch in slices(batches, limit=2 << 20):
            ids, cuts = own.encode(batch.column("text"))
            data, offsets = flat(batch.column("text"))
            back, ends = own.decode(ids, cuts)
            same = np.diff(ends) == np.diff(offsets)
            if not (same.all() and np.array_equal(back, data[: len(back)])):
                same = np.array([back[ends[i] : ends[i + 1]].tobytes() == data[offsets[i] : offsets[i + 1]].tobytes() for i in range(len(same))])
            bytes_ = np.concatenate([[0], np.cumsum(fallback[ids])])[cuts]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_pieces": np.diff(cuts), "n_byte_pieces": np.diff(bytes_),
                "ids": pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32))), "round_trip": same})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_pieces long, n_byte_pieces long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids``; null or empty ``ids`` give the empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(vars(vocabulary) | {"trie": vars(vocabulary.trie)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(**(sent.value | {"trie": Trie(**sent.value["trie"])}))
        for batch in batches:
            lists = batch.column("ids")
            cuts = lists.offsets.to_numpy().astype(np.int64)
            text = _strings(*own.decode(lists.values.to_numpy()[cuts[0] : cuts[-1]].astype(np.int64), cuts - cuts[0]))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": text.cast(pa.string())})

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")
