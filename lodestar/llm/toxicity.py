"""Toxicity classifier with a counterfactual penalty, in numpy.

Features are hashed words and word beginnings. How often each occurs in toxic and in other
documents is counted over a bounded sample of the labels; that gives every feature a first weight, which is never
below 0. A document's logit is a smooth maximum over all its features, in which a weight of 0 counts nothing: words
that speak for neither label add nothing, however long the text. The
weights are then refined on the whole texts of a bounded sample: documents that name a group are paired with the same
text naming another group, and a change of the logit between the two is penalised, so the name itself comes to
weigh nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.labelled import held_out, sampled, training_labels
from lodestar.llm.text import flat, lower_ascii, names, seeded, slices

# Words that name groups of people; a word is exchanged for the others of its line.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["black", "white", "asian", "latino", "arab", "african", "european"],
    ["gay", "lesbian", "straight", "bisexual", "transgender"],
    ["immigrants", "refugees", "foreigners", "citizens"],
    ["disabled", "deaf", "blind", "autistic"],
    ["femmes", "hommes"], ["musulmans", "chrétiens", "juifs"],
    ["frauen", "männer"], ["muslime", "christen", "juden"],
    ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"],
]

#: Hashed features, lengths in bytes of the word beginnings.
BITS, BEGINNINGS = 21, (4, 5, 6, 7, 8)
#: Labelled rows that features are counted over at most, and rows of these (with all their features) that refinement takes.
SAMPLE_ROWS, REFINED_ROWS = 20000, 4000
#: Documents' worth of doubt in a feature's first weight.
_DOUBT = 10.0
_SHARP = 3.0


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words of all rows, and the row of each. Words are runs of letters, digits and non-ASCII bytes."""
    data, offsets = flat(column)
    data = lower_ascii(data)
    n = int(offsets[-1])
    inside = np.zeros(n + 1, bool)
    body = data[:n]
    inside[:n] = (body >= 128) | ((body >= 97) & (body <= 122)) | ((body >= 48) & (body <= 57))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    starts, ends = np.flatnonzero(inside & (~before | edge)), np.flatnonzero(before & (~inside | edge))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    found, rows = [names(data, starts, ends, 20)], [row]
    for size in BEGINNINGS:
        long = np.flatnonzero(ends - starts > size)
        found.append(names(data, starts[long], starts[long] + size, 20 + size))
        rows.append(row[long])
    return (seeded(np.concatenate(found), 9) >> np.uint64(64 - BITS)).astype(np.int32), np.concatenate(rows)


def _per_row(feature: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature), sorted."""
    both = np.unique((row.astype(np.int64) << BITS) | feature)
    return (both & ((1 << BITS) - 1)).astype(np.int32), both >> BITS


@dataclass
class Model:
    weight: np.ndarray  # of each feature
    bias: float

    def logits(self, feature: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Smooth maximum of 0 and the weights of each row's distinct features."""
        feature, row = _per_row(feature, row)
        return self.bias + np.log1p(np.bincount(row, np.expm1(_SHARP * self.weight[feature].astype(np.float64)), rows)) / _SHARP

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(*features(column), len(column))))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold each feature, summed over the task."""
    count = np.zeros((2, 1 << BITS), np.int32)
    for batch in slices(batches):
        y = batch.column("y").to_numpy()
        feature, row = _per_row(*features(batch.column("text")))
        for label in (0, 1):
            np.add.at(count[label], feature[y[row] == label], 1)
    seen = np.flatnonzero(count.any(0)).astype(np.int32)
    for a in range(0, len(seen), 1 << 16):
        part = seen[a : a + (1 << 16)]
        yield pa.RecordBatch.from_pydict({"feature": part, "other": count[0, part].astype(np.int64), "toxic": count[1, part].astype(np.int64)})


def first_weights(feature: np.ndarray, other: np.ndarray, toxic: np.ndarray, totals: tuple[int, int]) -> np.ndarray:
    """Log ratio of a feature's share in toxic and other documents, drawn to 0 as far as counts are small; never below 0."""
    share = totals[1] / sum(totals)
    ratio = np.log((toxic + _DOUBT * share) / (totals[1] + _DOUBT * share)) - np.log(
        (other + _DOUBT * (1 - share)) / (totals[0] + _DOUBT * (1 - share)))
    weight = np.zeros(1 << BITS, np.float32)
    weight[feature] = np.maximum(ratio, 0)
    return weight


def exchanged(text: str, terms: list[list[str]]) -> str | None:
    """The text with each group name (a run of letters, in any case) replaced by the next of its line, all else as it is; None without one."""
    following = {word: line[(i + 1) % len(line)] for line in terms for i, word in enumerate(line)}
    out = re.sub(r"\b[^\W\d_]+\b", lambda m: following.get(m[0].lower(), m[0]), text)
    return out if out != text else None


def _speaking(weight: np.ndarray, column: pa.Array) -> list[np.ndarray]:
    """The features of each row whose first weight is above 0."""
    feature, row = _per_row(*features(column))
    some = weight[feature] > 0
    return np.split(feature[some], np.searchsorted(row[some], np.arange(1, len(column))))


def _joined(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """All lists in one array, and the list of each entry."""
    return np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64), np.repeat(np.arange(len(lists)), [len(x) for x in lists])


def refine(weight: np.ndarray, samples: list[tuple[int, list[int], list[int] | None]], penalty: float, steps: int = 150) -> Model:
    """Adam on logistic loss, plus ``penalty`` times the mean square of what exchanging group names changes.

    ``samples``: label, the features above 0, and those of the exchanged text where there is one. Weights
    stay at or above 0.
    """
    if not samples:
        return Model(weight, -3.0)
    y = np.array([s[0] for s in samples], np.float64)
    pairs = np.array([i for i, s in enumerate(samples) if s[2] is not None], np.int64)
    (own, at), (other, at_other) = _joined([s[1] for s in samples]), _joined([samples[i][2] for i in pairs])
    used, both = np.unique(np.concatenate([own, other]), return_inverse=True)
    own, other = both[: len(own)], both[len(own) :]
    w = weight[used].astype(np.float64)
    start = w.copy()
    bias = np.array([-3.0])
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0

    def forward(ids, rows, n, raised):
        total = 1 + np.bincount(rows, raised[ids] - 1, n)
        return np.log(total) / _SHARP, total

    for step in range(1, steps + 1):
        raised = np.exp(_SHARP * w)
        z, total = forward(own, at, len(y), raised)
        slope = (1 / (1 + np.exp(-(z + bias))) - y) / len(y)
        per_row = slope.copy()
        g = np.zeros_like(w)
        if len(pairs) and penalty:
            z2, total2 = forward(other, at_other, len(pairs), raised)
            gap = 2 * penalty * (z[pairs] - z2) / len(pairs)
            per_row[pairs] += gap
            g -= np.bincount(other, (gap / total2)[at_other], len(w))
        g += np.bincount(own, (per_row / total)[at], len(w))
        g = g * raised + 2e-5 * (w - start)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w = np.maximum(w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9), 0)
        mb += 0.1 * (slope.sum() - mb)
        vb += 0.01 * (slope.sum() ** 2 - vb)
        bias -= 0.05 * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-9)
    out = weight.copy()
    out[used] = w
    return Model(out, float(bias[0]))


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, label: str = "toxic",
        rows: int = SAMPLE_ROWS, refined: int = REFINED_ROWS, penalty: float = 1.0, terms: list[list[str]] | None = None) -> Model:
    """Count features over at most ``rows`` usable labels, then refine on at most ``refined`` of them.

    The driver receives three numbers for each of at most 2^BITS features, and of at most ``refined`` rows the distinct
    features that speak for the label, of the whole text. Without labels of both kinds all scores are near 0 (no toxic label) or 1.
    """
    terms = IDENTITY_TERMS if terms is None else terms
    usable = training_labels(labels, label, modulus, remainder)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counting = sampled(usable, rows)
    labelled = texts.join(F.broadcast(counting), "doc_id")
    totals = dict(counting.groupBy("y").count().collect())
    totals = totals.get(0, 0), totals.get(1, 0)
    if not all(totals):
        return Model(np.zeros(1 << BITS, np.float32), -3.0 if not totals[1] else 3.0)
    counted = labelled.mapInArrow(_counts, "feature int, other long, toxic long").groupBy("feature").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    # Only what is commoner in toxic documents has a weight above 0; compact columns, 2^BITS rows at most.
    speaking = counted.filter(F.col("toxic") * totals[0] > F.col("other") * totals[1]).toArrow()
    weight = first_weights(*(speaking.column(c).to_numpy() for c in ("feature", "other", "toxic")), totals)
    sent = docs.sparkSession.sparkContext.broadcast(weight)

    def speaking_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            swapped = [exchanged(t, terms) for t in batch.column("text").to_pylist()]
            other = _speaking(sent.value, pa.array([s or "" for s in swapped], pa.large_string()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "y": batch.column("y"),
                "own": pa.array(_speaking(sent.value, batch.column("text")), pa.list_(pa.int32())),
                "other": pa.array([o if s is not None else None for o, s in zip(other, swapped)], pa.list_(pa.int32()))})

    taken = texts.join(F.broadcast(sampled(usable, refined)), "doc_id").mapInArrow(speaking_features, "doc_id long, y int, own array<int>, other array<int>").collect()
    # The order of rows that sums are taken in must not depend on the cluster.
    taken = sorted(taken, key=lambda r: (r["doc_id"], r["y"], r["own"]))[:refined]
    return refine(weight, [(r["y"], r["own"], r["other"]) for r in taken], penalty)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """All rows with their columns, ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    A null text is empty, and an empty text has the score of the bias alone. Repeated rows are scored each, an empty table
    stays empty, own columns ``score`` and ``predicted`` are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            parts = [own.scores(part.column("text")) for part in slices(iter([batch]), limit=1 << 20)]
            scores = pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], schema=batch.schema.append(pa.field("score", pa.float64())))

    plain = docs.drop("score", "predicted")
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row; see ``fit`` and ``score``."""
    model = fit(docs, labels, modulus, remainder)
    rows = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, threshold)
    return rows.select("doc_id", held_out(modulus, remainder).alias("held_out"), "score", "predicted")
