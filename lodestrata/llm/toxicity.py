"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.store import Steps, bounded_batches, tidy, trim

# The classifier is fitted on so many labelled documents, with so many features in all, at most, taken in order of
# the hash of their ids.
SAMPLE, FEATURES = 16384, 1 << 25
# Cells in which the fitting task counts features before it keeps them.
CELLS = 1 << 24
# FTRL-proximal: rate, smoothing, L1, L2; passes over the sample; documents that a feature must occur in. Rate, L1 and
# passes are the choice of a four-fold cross-validation among the rows that labels may be learned from.
ALPHA, BETA, L1, L2, PASSES, LEAST = 2.0, 1.0, 15.0, 0.02, 6, 4
# Bytes of text that are hashed at a time.
PIECE = 1 << 18

# Odd multipliers of the word hash (a polynomial modulo 2^64) and its inverse, and of the mixing step.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
# Letters, digits and all bytes of other scripts are parts of words.
IN_WORD = ((LOWER >= 97) & (LOWER <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57)) | (_BYTES >= 128)
CODE = (LOWER + 1).astype(np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = powers(BASE, PIECE + 1), powers(INVERSE, PIECE + 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """64 bits to well mixed 32-bit buckets."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(MIX[0])
    h = (h ^ h >> np.uint64(27)) * np.uint64(MIX[1])
    return (h >> np.uint64(32)).astype(np.uint32)


def words(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text's bytes, in order. The longest words are cut at ``PIECE`` bytes."""
    found, at = [], 0
    while at < len(data):
        piece = data[at:at + PIECE]
        part = IN_WORD[piece]
        if at + len(piece) < len(data) and part[-1]:  # up to the last whole word
            gap = np.flatnonzero(~part)
            if len(gap):
                piece, part = piece[:gap[-1] + 1], part[:gap[-1] + 1]
        edge = np.diff(np.r_[False, part, False].astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.r_[np.uint64(0), np.cumsum(CODE[piece] * _UP[:len(piece)], dtype=np.uint64)]
        found.append((total[end] - total[start]) * _DOWN[start])
        at += len(piece)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def features(h: np.ndarray) -> np.ndarray:
    """Buckets of words, word pairs, and pairs with one word left out between them."""
    a = h * np.uint64(MIX[0])
    return np.concatenate([mixed(h), mixed(a[:-1] + h[1:] + np.uint64(1)), mixed(a[:-2] + h[2:] + np.uint64(2))])


def texts_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text; null is empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for valid, a, b in zip(column.is_valid().to_pylist(), offsets, offsets[1:]):
        yield data[a:b] if valid else data[:0]


@dataclass
class Model:
    """Weights that are not zero, by bucket in ascending order, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.seen = np.zeros(1 << 16, bool)  # by the low bits: nearly all features end here
        self.seen[self.buckets & 0xFFFF] = True

    def score(self, data: np.ndarray) -> float:
        found = features(words(data))
        found = np.unique(found[self.seen[found & 0xFFFF]])
        at = np.minimum(np.searchsorted(self.buckets, found), max(0, len(self.buckets) - 1))
        margin = self.bias + (self.weights[at] * (self.buckets[at] == found)).sum() if len(self.buckets) and len(found) else self.bias
        return float(1 / (1 + np.exp(-margin)))


def fit(rows: list[tuple[np.ndarray, int]]) -> Model:
    """FTRL-proximal over (distinct buckets, label) in several passes, in an order fixed by a seed.

    Every coordinate has a rate of its own, which falls with the squares of its gradients; L1 keeps a weight
    at zero until its evidence is strong enough, so few are left. Without a positive row nothing is toxic.
    """
    positive = sum(y for _, y in rows)
    if not positive:
        return Model(np.zeros(0, np.uint32), np.zeros(0), -30.0)
    every = np.concatenate([x for x, _ in rows])
    every.sort()
    edge = np.flatnonzero(np.r_[True, every[1:] != every[:-1], True])
    buckets = every[edge[:-1][np.diff(edge) >= LEAST]]
    del every, edge
    data = [((np.flatnonzero(np.isin(buckets, x, assume_unique=True)) if len(x) > len(buckets) else _places(buckets, x)).astype(np.int32), y) for x, y in rows]
    z, n = np.zeros(len(buckets)), np.zeros(len(buckets))
    bias, bias_n = float(np.log((positive + 0.5) / (len(rows) - positive + 0.5))), 1.0

    def weight(at):
        return np.where(np.abs(z[at]) <= L1, 0.0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(0)
    for _ in range(PASSES):
        for i in order.permutation(len(data)):
            at, y = data[i]
            w = weight(at)
            g = 1 / (1 + np.exp(-max(-35.0, min(35.0, bias + w.sum())))) - y
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
            bias_n += g * g
            bias -= 0.1 / np.sqrt(bias_n) * g
    w = weight(slice(None))
    return Model(buckets[w != 0], w[w != 0], bias)


def _places(buckets: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(buckets, x), max(0, len(buckets) - 1))
    return at[buckets[at] == x] if len(buckets) else at[:0]


def listed(batch: pa.RecordBatch, x: list[np.ndarray]) -> pa.RecordBatch:
    """id and y of the batch with other features."""
    bounds = np.cumsum([0, *map(len, x)]).astype(np.int32)
    values = pa.array(np.concatenate([*x, np.zeros(0, np.uint32)]).view(np.int32))
    return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.ListArray.from_arrays(pa.array(bounds), values)], names=["id", "y", "x"])


def learn(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from the labelled documents whose crc32(id as text) mod 5 is not 0: a sample of ``SAMPLE``,
    and of those whose features are ``FEATURES`` in all.

    Only texts are features. Documents are turned into buckets where they lie; one task fits the bounded
    sample, and what comes back is the few weights. An id labelled twice is toxic if either says so; null
    labels and ids say nothing, and documents of equal ids are all used.
    """
    steps = Steps(docs.sparkSession)
    bounded_batches(docs.sparkSession, 1 << 22)
    known = (labels.where(F.col(label).isNotNull() & F.col(doc).isNotNull()).groupBy(F.col(doc).alias("_id")).agg(F.max(label).cast("int").alias("y"))
             .where(F.crc32(F.col("_id").cast("string")) % 5 != 0).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE))
    rows = docs.select(F.col(doc).alias("_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(known), "_id").select("_id", "y", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield listed(batch, [np.unique(features(words(t))) for t in texts_of(batch.column(2))])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, seen = [], np.zeros(CELLS, np.uint8)  # documents that a cell of buckets occurs in, up to LEAST
        for b in batches:
            for i, y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                x = x.values.to_numpy().view(np.uint32).copy()
                rows.append((i, len(x), x, y))
                seen[x & CELLS - 1] += seen[x & CELLS - 1] < LEAST
        # Features of fewer than LEAST documents are never used; most of them go here.
        for k, (i, size, x, y) in enumerate(rows):
            rows[k] = (i, size, x[seen[x & CELLS - 1] >= LEAST], y)
        del seen
        trim()
        rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
        model = fit([(x, y) for _, _, x, y in rows])
        yield pa.RecordBatch.from_pydict({"bucket": [*model.buckets.tolist(), -1], "weight": [*model.weights.tolist(), model.bias]})

    shape = "id string, y int, x array<int>"
    sample = steps.saved(rows.mapInArrow(tidy("toxicity", hashed), shape), "sample")
    upto = Window.orderBy(F.xxhash64("id"), "id")  # of the ids, SAMPLE at most
    sizes = sample.groupBy("id").agg(F.sum(F.size("x") + 1).alias("n")).withColumn("upto", F.sum("n").over(upto))
    sample = sample.join(F.broadcast(sizes.where(F.col("upto") <= FEATURES).select("id")), "id", "left_semi")
    got = sample.select("id", "y", "x").repartition(1).mapInArrow(tidy("toxicity", fitted), "bucket bigint, weight double").collect()
    steps.remove()
    got = sorted((r["bucket"], r["weight"]) for r in got) or [(-1, -30.0)]
    return Model(np.array([b for b, _ in got[1:]], np.uint32), np.array([w for _, w in got[1:]]), got[0][1])


def score(model: Model, text: str | Column) -> Column:
    """The probability that a text is toxic, 0 to 1; an empty or null one has the bias alone."""
    @F.arrow_udf("double")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([model.score(t) for t in texts_of(column)], pa.float64())
    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc, held_out, score and predicted of every row. ``held_out`` rows are those no label was learned from;
    it is null for a null id."""
    model = learn(docs, labels, doc, text, label)
    return (docs.select(F.col(doc).alias("doc"), score(model, F.col(text).cast("string")).alias("score"))
            .select("doc", (F.crc32(F.col("doc").cast("string")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
