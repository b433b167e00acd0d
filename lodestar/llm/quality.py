"""Quality classifier: a convolutional network over bytes, in numpy.

A text is read in overlapping chunks that cover it whole. ``FILTERS`` learned filters of ``WIDTH`` bytes run
over each chunk (a filter is a table of byte weights for each of its places) and are max-pooled;
a small layer turns the pooled values and the chunk's length into a logit, and the mean over chunks, weighted by
length, gives one probability. Training runs on the driver on a bounded sample of labelled rows, scoring
in tasks on slices of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.labelled import held_out, sampled, training_labels
from lodestar.llm.text import flat, slices

WIDTH, FILTERS, HIDDEN = 6, 16, 16
#: Filter places per chunk, and between the starts of two chunks.
CHUNK, STRIDE = 512, 448
#: Labelled rows that training takes at most, each with its whole text.
SAMPLE_ROWS = 2500
#: Chunks whose filter values are held at once.
_BLOCK = 512


def chunk_bounds(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first place and number of places of every chunk; rows of ``sizes`` bytes have ``size - WIDTH + 1`` places, at least one."""
    places = np.maximum(sizes - WIDTH + 1, 1)
    count = 1 + np.maximum(-(-(places - CHUNK) // STRIDE), 0)
    row = np.repeat(np.arange(len(sizes)), count)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return row, start, np.minimum(CHUNK, places[row] - start)


def padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all rows with ``WIDTH`` zero bytes after each, starts and sizes of the rows."""
    data, offsets = flat(column)
    sizes = np.diff(offsets)
    starts = offsets[:-1] + WIDTH * np.arange(len(sizes))
    out = np.zeros(int(offsets[-1]) + WIDTH * (len(sizes) + 1), np.uint8)
    out[np.arange(int(offsets[-1])) + np.repeat(WIDTH * np.arange(len(sizes)), sizes)] = data[: int(offsets[-1])]
    return out, starts, sizes


@dataclass
class Network:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    inner: np.ndarray  # HIDDEN x (FILTERS + 1)
    inner_bias: np.ndarray
    outer: np.ndarray
    bias: np.ndarray

    @staticmethod
    def fresh(seed: int = 3) -> Network:
        r = np.random.default_rng(seed)
        f = np.float32
        return Network(r.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(f), r.normal(0, 0.3, (HIDDEN, FILTERS + 1)).astype(f),
                       np.full(HIDDEN, 0.1, f), r.normal(0, 0.3, HIDDEN).astype(f), np.zeros(1, f))

    def weights(self) -> list[np.ndarray]:
        return [self.tables, self.inner, self.inner_bias, self.outer, self.bias]

    def chunk_logits(self, pooled: np.ndarray, places: np.ndarray) -> np.ndarray:
        x = np.concatenate([pooled, _length(places)[:, None]], 1)
        return np.maximum(x @ self.inner.T + self.inner_bias, 0) @ self.outer + self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability that each row's text is of good quality."""
        data, starts, sizes = padded(column)
        row, start, places = chunk_bounds(sizes)
        first = starts[row] + start
        logits = np.empty(len(row))
        for a in range(0, len(row), 256):  # some hundred chunks at a time keep the filter values in cache
            lo, hi = first[a], (first[a : a + 256] + places[a : a + 256]).max()
            values = self.tables[0][data[lo:hi]]
            for j in range(1, WIDTH):
                values += self.tables[j][data[lo + j : hi + j]]
            ends = np.minimum(first[a : a + 256] + places[a : a + 256] - lo, hi - lo)
            pairs = np.stack([first[a : a + 256] - lo, ends], 1).ravel()
            pooled = np.maximum.reduceat(np.concatenate([values, values[-1:]]), pairs, axis=0)[::2]
            logits[a : a + 256] = self.chunk_logits(pooled, places[a : a + 256])
        total = np.bincount(row, logits * places, len(sizes)) / np.bincount(row, places, len(sizes))
        return 1 / (1 + np.exp(-total))


def _length(places: np.ndarray) -> np.ndarray:
    return (np.log1p(places) / 6).astype(np.float32)


def train(samples: list[tuple[int, list[bytes]]], epochs: int = 6, batch: int = 64, seed: int = 3) -> Network:
    """Adam on the logistic loss. ``samples``: label and chunks of each row; both classes weigh as they come."""
    net, r = Network.fresh(seed), np.random.default_rng(seed)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        order = r.permutation(len(samples))
        for a in range(0, len(order), batch):
            step += 1
            gradients = _gradients(net, [samples[i] for i in order[a : a + batch]])
            for w, g, (m, v) in zip(net.weights(), gradients, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, samples: list[tuple[int, list[bytes]]]) -> list[np.ndarray]:
    chunks = [c for _, texts in samples for c in texts]
    row = np.repeat(np.arange(len(samples)), [len(t) for _, t in samples])
    y = np.array([label for label, _ in samples], np.float32)
    places = np.array([max(len(c) - WIDTH + 1, 1) for c in chunks])
    x = np.zeros((len(chunks), places.max() + WIDTH), np.uint8)
    for i, c in enumerate(chunks):
        x[i, : len(c)] = np.frombuffer(c, np.uint8)
    n = x.shape[1] - WIDTH
    best, pooled = np.empty((len(chunks), FILTERS), np.int64), np.empty((len(chunks), FILTERS), np.float32)
    for a in range(0, len(chunks), _BLOCK):
        part = x[a : a + _BLOCK]
        values = net.tables[0][part[:, :n]]
        for j in range(1, WIDTH):
            values += net.tables[j][part[:, j : n + j]]
        values[np.arange(n)[None, :] >= places[a : a + _BLOCK, None]] = -np.inf
        best[a : a + _BLOCK] = values.argmax(1)
        pooled[a : a + _BLOCK] = np.take_along_axis(values, best[a : a + _BLOCK, None, :], 1)[:, 0, :]
    inputs = np.concatenate([pooled, _length(places)[:, None]], 1)
    before = inputs @ net.inner.T + net.inner_bias
    hidden = np.maximum(before, 0)
    share = (places / np.bincount(row, places)[row]).astype(np.float32)
    logit = np.bincount(row, (hidden @ net.outer + net.bias) * share, len(samples))
    slope = ((1 / (1 + np.exp(-logit)) - y) / len(samples)).astype(np.float32)
    d_chunk = slope[row] * share
    d_before = d_chunk[:, None] * net.outer * (before > 0)
    d_pooled = (d_before @ net.inner)[:, :FILTERS]
    d_tables = np.empty_like(net.tables)
    filters = np.arange(FILTERS)
    for j in range(WIDTH):
        cell = x[np.arange(len(chunks))[:, None], best + j].astype(np.int64) * FILTERS + filters
        d_tables[j] = np.bincount(cell.ravel(), d_pooled.ravel(), 256 * FILTERS).reshape(256, FILTERS)
    return [d_tables, d_before.T @ inputs, d_before.sum(0), d_chunk @ hidden, d_chunk.sum()[None]]


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, label: str = "quality", rows: int = SAMPLE_ROWS) -> Network:
    """Train on at most ``rows`` labelled documents, all chunks of each.

    The driver receives the whole texts of that many rows, however large the data; filter values are held for some hundred chunks
    at a time. Without a label of either kind the network stays as it starts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, starts, sizes = padded(batch.column("text"))
            row, start, places = chunk_bounds(sizes)
            texts = []
            for i in range(len(sizes)):
                own = range(*np.searchsorted(row, [i, i + 1]))
                texts.append([data[starts[i] + start[c] : starts[i] + min(start[c] + places[c] + WIDTH - 1, sizes[i])].tobytes() for c in own])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "y": batch.column("y"), "chunks": pa.array(texts, pa.list_(pa.binary()))})

    some = sampled(training_labels(labels, label, modulus, remainder), rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    taken = texts.join(F.broadcast(some), "doc_id").mapInArrow(run, "doc_id long, y int, chunks array<binary>").collect()
    samples = [(r["y"], [bytes(c) for c in r["chunks"]]) for r in sorted(taken, key=lambda r: (r["doc_id"], r["chunks"]))][:rows]
    return train(samples) if len({y for y, _ in samples}) == 2 else Network.fresh()


def score(docs: DataFrame, net: Network, threshold: float = 0.3) -> DataFrame:
    """All rows of ``docs`` with their columns, ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Only the text is an input; a null text counts as empty, and an empty one has a score like any other. Columns of
    the same names are replaced.
    """
    weights = docs.sparkSession.sparkContext.broadcast(net.weights())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(*weights.value)
        for batch in batches:
            parts = [model.scores(part.column("text")) for part in slices(iter([batch]))]
            scores = pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], schema=batch.schema.append(pa.field("score", pa.float64())))

    plain = docs.drop("score", "predicted")
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row; see ``fit`` and ``score``."""
    net = fit(docs, labels, modulus, remainder)
    rows = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), net, threshold)
    return rows.select("doc_id", held_out(modulus, remainder).alias("held_out"), "score", "predicted")
