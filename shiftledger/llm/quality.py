"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

A text's features are its words, their shapes (runs of capitals, small letters, digits and
each mark), and the pairs of neighbours of both, hashed into 2**18 places; a repeated word
makes one fixed pair. Values are counts divided by the number of words. Training walks a
bounded sample of labelled texts (`sample`, smallest hashes of doc_id) in a few parallel
parts with FTRL-proximal steps and averages the weights; scoring is one sparse dot product
per whole text. Of several rows with one doc_id the one with the smallest text hash is
learned from (an empty text only if there is no other), so `sample` bounds the texts.

Null or empty text: no features, so the score is that of the bias. Labels that are null or
other than 0 and 1 are ignored; several for one doc_id count as the highest. Equal rows get
equal scores. No usable labels: every score is 0.5. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.llm import textbytes as tb

BITS = 18
SAMPLE = 8000
PARTS = 16
EPOCHS = 8
SCALE = 10.0

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = ord("0")
_SHAPE[65:91] = ord("A")
_SHAPE[97:123] = ord("a")
_SHAPE[128:] = ord("a")


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and of its shape."""
    shape = _SHAPE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[start] = True
    place = np.append(0, np.cumsum(keep))
    word = tb.substring_hash(tb.prefix_sums(data), start, end)
    return word, tb.substring_hash(tb.prefix_sums(shape[keep]), place[start], place[end])


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature places of all texts, the row of each, and words per row."""
    start, end, counts = tb.words(data, bounds)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    row = np.repeat(np.arange(len(counts)), counts)
    word, shape = _hashes(data, start, end)
    near = row[1:] == row[:-1]
    seeds = [np.uint64(x) for x in (1, 2, 3, 4)]
    found = [tb.mixed(word ^ seeds[0]), tb.mixed(shape ^ seeds[1])]
    for h, seed in ((word, seeds[2]), (shape, seeds[3])):
        pair = tb.mixed(h[:-1] * np.uint64(3) + h[1:] + seed)
        if seed == seeds[2]:
            pair[h[:-1] == h[1:]] = np.uint64(0)
        found.append(pair[near])
    rows = [row, row, row[:-1][near], row[:-1][near]]
    places = np.concatenate(found) >> np.uint64(64 - BITS)
    return places.astype(np.int64), np.concatenate(rows), counts


class FollowTheLeader:
    """FTRL-proximal for logistic loss; the last place is the bias."""

    def __init__(self, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.005, l2: float = 0.05) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def step(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        """at: distinct places."""
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * value
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def held_out(doc_id: Column) -> Column:
    """The rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, parts: int = PARTS) -> np.ndarray:
    """The averaged weights, of fixed size."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # one text per doc_id, the least being kept before the shuffle
    by_hash = F.struct(F.coalesce(F.col("text"), F.lit("")) == "", F.xxhash64("text"), F.col("text").alias("text"))
    # at most `sample` rows of two numbers
    labelled = rows.join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min(by_hash).alias("least"))
    chosen = labelled.select("doc_id", F.col("least.text").alias("text"), "y").withColumn(
        "part", F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(parts))
    )

    def learn(group: pa.Table) -> pa.Table:
        order = group.append_column("order", pa.array([zlib.crc32(b"%d" % d) for d in group.column("doc_id").to_pylist()]))
        group = order.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
        texts = []
        data, bounds = tb.bytes_of(group.column("text"))
        label = group.column("y").to_numpy()
        for first, _, part, at in tb.pieces(data, bounds):
            places, row, counts = features(part, at)
            by_row = np.argsort(row, kind="stable")
            cut = np.append(0, np.cumsum(np.bincount(row, minlength=len(counts))))
            for i, n in enumerate(counts):
                place, times = np.unique(places[by_row[cut[i] : cut[i + 1]]], return_counts=True)
                texts.append((
                    np.append(place, 1 << BITS).astype(np.int32),
                    np.append(SCALE * times / max(n, 1), 1.0).astype(np.float32),
                    float(label[first + i]),
                ))
        model = FollowTheLeader()
        for _ in range(EPOCHS):
            for text in texts:
                model.step(*text)
        return pa.table({
            "texts": pa.array([len(texts)], pa.int64()),
            "weights": pa.array([model.weights().astype("<f8").tobytes()], pa.binary()),
        })

    models = chosen.groupBy("part").applyInArrow(learn, "texts long, weights binary").collect()  # `parts` vectors of fixed size
    total = np.zeros((1 << BITS) + 1)
    for m in sorted(models, key=lambda m: (m["texts"], m["weights"])):
        total += m["texts"] * np.frombuffer(m["weights"], "<f8")
    return total / max(sum(m["texts"] for m in models), 1)


def score_column(batches: Iterator[pa.RecordBatch], weights: np.ndarray, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    gram = weights[:-1]
    for batch in batches:
        data, bounds = tb.bytes_of(batch.column(column))
        out = []
        for _, _, part, at in tb.pieces(data, bounds):
            places, row, counts = features(part, at)
            dot = np.bincount(row, weights=gram[places], minlength=len(counts))
            z = weights[-1] + SCALE * dot / np.maximum(counts, 1)
            out.append(1 / (1 + np.exp(-np.clip(z, -35, 35))))
        yield batch, np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 MB whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, p in score_column(batches, shared.value, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """The rows that score at least the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, p in score_column(batches, shared.value, at):
            yield batch.filter(pa.array(p >= threshold))

    return docs.mapInArrow(run, docs.schema)
