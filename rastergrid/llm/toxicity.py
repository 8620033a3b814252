"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct single words, word pairs and pairs over one word of a text, hashed to 2^20
coordinates. Training is online with a learning rate for each coordinate and an L1 term that keeps
most weights at exactly zero, so the model is a short list of coordinates and weights.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import portions

BITS = 20
# Labelled rows to learn from, at most: those with the least hash of their doc_id.
TRAIN_ROWS = 14_000
# Features of the labelled rows together, at most (256 MiB); rows beyond are left out of the fit.
TRAIN_FEATURES = 1 << 26
EPOCHS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.001
THRESHOLD = 0.7
SEED = 5
_WORD = re.compile(r"\w+")
_CACHE_WORDS = 100_000


@dataclass
class Model:
    """Coordinates with a weight other than zero, their weights, and the bias."""

    places: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << self.bits, np.float32)
        table[self.places] = self.weights
        return table


class Features:
    """Coordinates of a text; words are hashed once while the cache lasts."""

    def __init__(self, bits: int = BITS):
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.uint64(64 - bits)
        self.cache: dict[str, int] = {}

    def _word(self, word: str) -> int:
        if len(self.cache) > _CACHE_WORDS:
            self.cache.clear()
        value = zlib.crc32(word.encode())
        self.cache[word] = value
        return value

    def of(self, text: str) -> np.ndarray:
        """With repeats: one place for each word, pair and skip pair."""
        found, cache = _WORD.findall(text.lower()), self.cache
        hashed = np.fromiter(
            (cache[w] if w in cache else self._word(w) for w in found), np.uint64, len(found)
        )
        single = hashed * np.uint64(0x9E3779B97F4A7C15)
        second = hashed * np.uint64(0xC2B2AE3D27D4EB4F)
        parts = [single]
        if len(found) > 1:
            parts.append((single[:-1] ^ second[1:]) * np.uint64(0x165667B19E3779F9))
        if len(found) > 2:
            parts.append((single[:-2] ^ second[2:]) * np.uint64(0xD6E8FEB86659FD93))
        return (np.concatenate(parts) >> self.shift).astype(np.int64)


def fit_ftrl(examples: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """FTRL-proximal over sets of coordinates, one example at a time; a coordinate of its own is the bias."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights_at(places: np.ndarray) -> np.ndarray:
        own_z, rate = z[places], (BETA + np.sqrt(n[places])) / ALPHA + L2
        return np.where(np.abs(own_z) <= L1, 0.0, (np.sign(own_z) * L1 - own_z) / rate)

    rng = np.random.default_rng(SEED)
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            places = np.append(examples[k], size - 1)
            weights = weights_at(places)
            error = 1.0 / (1.0 + np.exp(-np.clip(weights.sum(), -35, 35))) - labels[k]
            old = n[places]
            new = old + error * error
            z[places] += error - (np.sqrt(new) - np.sqrt(old)) / ALPHA * weights
            n[places] = new
    places = np.flatnonzero(np.abs(z[:-1]) > L1)
    return Model(places, weights_at(places).astype(np.float32), float(weights_at(np.array([size - 1]))[0]), bits)


def train(
    docs: DataFrame, labels: DataFrame, bits: int = BITS, rows: int = TRAIN_ROWS, features_held: int = TRAIN_FEATURES
) -> Model:
    """Fit on at most ``rows`` labelled rows (doc_id, label 0 or 1), those with the least hash of their id.

    Rows without a label, an id or a document are left out; rows that repeat count again. Without any
    labelled row the model has no weights and scores 0.5. Features come from tasks; the sample, of at
    most ``features_held`` features besides one text, is fitted by one task.
    """
    chosen = (
        labels.where("doc_id is not null and label in (0, 1)").select(F.col("doc_id").alias("__id"), "label")
        .orderBy(F.xxhash64("__id"), "__id", "label").limit(rows)
    )
    sample = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("__id")).select("__id", "label", "text")

    def features(batches):
        make = Features(bits)
        for batch in portions(batches):
            sets = [np.unique(make.of(t)).astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("label"), pa.array(sets, pa.binary())], names=["id", "label", "places"]
            )

    def fitted(batches):
        rows, held = [], 0
        for batch in batches:
            for key, label, places in zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), batch.column("places")):
                own = places.as_py()
                held += len(own) // 4
                if rows and held > features_held:
                    break
                rows.append((key, label, own))
            if held > features_held:
                break
        for _ in batches:
            pass
        rows.sort()
        values, truth = [np.frombuffer(own, "<i4") for _, _, own in rows], [label for _, label, _ in rows]
        model = fit_ftrl(values, np.array(truth, float), bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.places.astype("<i4").tobytes()]), pa.array([model.weights.astype("<f4").tobytes()]), pa.array([model.bias])],
            names=["places", "weights", "bias"],
        )

    sets = sample.select("__id", F.col("label").cast("int").alias("label"), "text").mapInArrow(features, "id bigint, label int, places binary")
    # One task fits the bounded sample; the driver gets the weights that are not zero.
    model = (
        sets.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id", "label", "places")
        .mapInArrow(fitted, "places binary, weights binary, bias double").first()
    )
    if model is None:  # no task at all
        return Model(np.empty(0, np.int32), np.empty(0, np.float32), 0.0, bits)
    return Model(np.frombuffer(model["places"], "<i4"), np.frombuffer(model["weights"], "<f4"), model["bias"], bits)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text added; null texts score as empty ones.

    Texts of any length are read whole, equal texts score alike, repeated rows stay, an empty table gives
    an empty result, and a column of ``docs`` named like the score gives way to it.
    """
    docs = docs.drop(out) if out != text_col else docs
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most 2^20 places and weights
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    text_at = docs.columns.index(text_col)

    def scored(batches):
        model_, table = held.value, held.value.dense()
        make = Features(model_.bits)
        for batch in portions(batches):
            values = np.empty(batch.num_rows)
            for k, text in enumerate(batch.column(text_at).to_pylist()):
                places = make.of(text or "")
                places = np.unique(places[table[places] != 0])
                values[k] = model_.bias + table[places].sum(dtype=np.float64)
            probability = 1.0 / (1.0 + np.exp(-np.clip(values, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(probability, pa.float64())], names=[*batch.schema.names, out]
            )

    return docs.mapInArrow(scored, schema)
