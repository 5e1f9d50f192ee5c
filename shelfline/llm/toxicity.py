"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are words, their stems (first letters, so that inflected forms share weight), pairs of neighbours and pairs
with one word between, each present or not, hashed to ``2 ** DIMENSION_BITS`` places. Every coordinate has its own rate; the L1 term leaves most weights at zero, so the model
is a short table that is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfline.llm.arrays import LOWER, chunks, hash_words, mix, split_words

DIMENSION_BITS = 20
BIAS = -1
#: labelled rows that are learned from, at most: those of smallest hash of doc_id
TRAIN_ROWS = 16_000
STEMS = (4, 5, 6)
ALPHA, BETA, L1, L2, EPOCHS = 0.15, 1.0, 1.0, 1.0, 4


def _place(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(64 - DIMENSION_BITS)).astype(np.int64)


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, place) arrays, one pair for words, stems, neighbours and skip-grams each; with repeats."""
    words = split_words(texts, LOWER)
    hashes = hash_words(words.vocab)[words.codes]
    owner = np.repeat(np.arange(len(texts)), np.diff(words.starts))
    yield owner, _place(hashes)
    letters = [w.decode("utf-8", "replace") for w in words.vocab.to_pylist()]
    for size in STEMS:
        long_enough = np.fromiter((len(w) > size for w in letters), bool, len(letters))
        stems = hash_words([w[:size] for w in letters]) + np.uint64(size)
        held = long_enough[words.codes]
        yield owner[held], _place(mix(stems)[words.codes[held]])
    for gap in (1, 2):
        left, right = hashes[:-gap], hashes[gap:]
        inside = owner[:-gap] == owner[gap:]
        yield owner[:-gap][inside], _place(mix(left + np.uint64(gap))[inside] + right[inside])


def fit(rows: list[tuple[int, np.ndarray]], epochs: int = EPOCHS) -> dict[int, float]:
    """FTRL-proximal over (label, places) rows in the given order; the weights that are not zero, the bias under BIAS."""
    size = 1 << DIMENSION_BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        own = z[at]
        shrunk = np.sign(own) * np.maximum(np.abs(own) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for label, places in rows:
            at = np.append(places, size)
            w = weights(at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[at] + gradient ** 2) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - sigma * w
            n[at] += gradient ** 2
    w = weights(np.arange(size + 1))
    out = {int(k): float(w[k]) for k in np.flatnonzero(w[:-1])}
    return out | {BIAS: float(w[-1])}


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[int, int, np.ndarray]] = []
    for batch in chunks(batches):
        parts = list(features(batch.column("text")))
        keys = np.unique(np.concatenate([(o << DIMENSION_BITS) | p for o, p in parts]))
        owner, places = keys >> DIMENSION_BITS, (keys & ((1 << DIMENSION_BITS) - 1)).astype(np.int32)
        cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        for k, (draw, label) in enumerate(zip(batch.column("draw").to_pylist(), batch.column("label").to_pylist(), strict=True)):
            rows.append((draw, label, places[cuts[k]:cuts[k + 1]]))
    rows.sort(key=lambda row: (row[0], row[1], row[2].tobytes()))
    model = fit([(label, places) for _, label, places in rows])
    yield pa.RecordBatch.from_arrays([pa.array(list(model), pa.int64()), pa.array(list(model.values()), pa.float64())],
                                     ["place", "weight"])


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> dict[int, float]:
    """Weights from the labelled texts: docs (doc_id, text) and labels (doc_id, label 0 or 1).

    At most ``most`` labelled rows are used, those of smallest hash of doc_id, so the work of the fit is bounded
    and does not follow the order of the table. Rows without a label, a doc_id or a text in ``docs`` are not used.
    Without any row the model is a score of one half for all.
    """
    draw = F.xxhash64("doc_id")
    drawn = (labels.where("doc_id is not null and label is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "label")
             .withColumn("draw", draw).orderBy("draw", "label").limit(most))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(drawn), "doc_id").select(  # at most ``most`` rows of three numbers
        "text", F.col("draw"), F.col("label").cast("int").alias("label"))
    return {BIAS: 0.0} | dict(rows.repartition(1).mapInArrow(_train, "place long, weight double").collect())


def _score(model: dict[int, float], names: list[str], text: str, out: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    places = np.array([k for k in model if k != BIAS], np.int64)
    values = np.array([model[int(k)] for k in places], np.float64)
    bias = model[BIAS]

    def run(batches):
        dense = np.zeros(1 << DIMENSION_BITS)
        dense[places] = values
        for batch in chunks(batches, text):
            total = np.full(batch.num_rows, bias)
            keys = [np.zeros(0, np.int64)]
            for owner, at in features(batch.column(text)):
                held = dense[at] != 0
                keys.append((owner[held] << DIMENSION_BITS) | at[held])
            own = np.unique(np.concatenate(keys))
            total += np.bincount(own >> DIMENSION_BITS, dense[own & ((1 << DIMENSION_BITS) - 1)], batch.num_rows)
            score = pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([score if n == out else batch.column(n) for n in names], names)
    return run


def score(docs: DataFrame, model: dict[int, float], text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of each whole text; a column named ``out`` is replaced.

    Null and empty texts get the score of the bias alone. A feature counts once however often it occurs.
    """
    schema = T.StructType([f for f in docs.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])
    return docs.mapInArrow(_score(model, schema.names, text, out), schema)
