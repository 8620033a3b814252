"""Quality by word vectors of random indexing, pooled per document, and a small two-layer network.

Every word bucket has a sparse random index vector; its context vector is the sum of the index vectors
of the words around it over all documents. A document is the mean of its words' context and index
vectors. A two-layer network, trained on a bounded labelled sample, gives a logit, and a temperature
fitted on rows left out of training calibrates the probability.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import save

BUCKETS = 1 << 13
DIMENSIONS = 32
NONZERO = 4
WINDOW = 2
# Context vectors travel in blocks of so many buckets.
BLOCK = 64
# Labelled rows to learn from, at most: those with the least hash of their doc_id.
TRAIN_ROWS = 12_000
HIDDEN = 32
EPOCHS = 60
SEED = 3
THRESHOLD = 0.3
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE_WORDS = 500_000
_ROWS_AT_ONCE = 1 << 16


def index_vectors(buckets: int = BUCKETS, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """Ternary vectors with NONZERO entries each, the same in every task."""
    rng = np.random.default_rng(seed)
    table = np.zeros((buckets, dimensions), np.int8)
    places = np.argsort(rng.random((buckets, dimensions)), axis=1)[:, :NONZERO]
    signs = rng.integers(0, 2, (buckets, NONZERO), dtype=np.int8) * 2 - 1
    np.put_along_axis(table, places, signs, axis=1)
    return table


class Tokens:
    """Buckets of a text's words and signs; words in capitals and repeats add a token of their own."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets = buckets
        self.cache: dict[str, int] = {}
        self.capitals, self.repeat = self._bucket("<capitals>"), self._bucket("<repeat>")

    def _bucket(self, word: str) -> int:
        if len(self.cache) > _CACHE_WORDS:
            self.cache.clear()
        value = zlib.crc32(word.encode()) % self.buckets
        self.cache[word] = value
        return value

    def of(self, text: str) -> np.ndarray:
        cache, found = self.cache, []
        last = None
        for token in _TOKEN.findall(text):
            lower = token.lower()
            if lower == last:
                found.append(self.repeat)
            elif lower != token and len(token) > 1 and token.isupper():
                found.append(self.capitals)
            last = lower
            found.append(cache[lower] if lower in cache else self._bucket(lower))
        return np.array(found, np.int64)


def _neighbour_sums(found: np.ndarray, index: np.ndarray, sums: np.ndarray) -> None:
    """Add to ``sums`` by bucket the index vectors of the words around each word of ``found``."""
    for start in range(0, len(found), _ROWS_AT_ONCE):
        # Neighbours over the edge of a piece are kept by overlapping the pieces.
        piece = found[max(0, start - WINDOW) : start + _ROWS_AT_ONCE + WINDOW]
        low, high = min(start, WINDOW), min(len(found) - start, _ROWS_AT_ONCE)
        vectors = index[piece]
        around = np.zeros((high, index.shape[1]), np.int32)
        for step in range(1, WINDOW + 1):
            left, right = max(0, step - low), min(high, len(piece) - low - step)
            around[left:] += vectors[low + left - step : low + high - step]
            around[:right] += vectors[low + step : low + step + right]
        # Rows of one bucket stand together, then each run is added up at once.
        own = piece[low : low + high]
        order = np.argsort(own.astype(np.uint16), kind="stable")
        heads = np.flatnonzero(np.diff(own[order], prepend=-1))
        sums[own[order[heads]]] += np.add.reduceat(around[order], heads, axis=0)


def _blocks_of(sums: np.ndarray, salt: int):
    """Blocks of the table that have anything, as one batch (salt, block, values)."""
    parts = [(k // BLOCK, sums[k : k + BLOCK]) for k in range(0, len(sums), BLOCK)]
    parts = [(block, part.astype("<i8").tobytes()) for block, part in parts if part.any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([salt] * len(parts), pa.int32()), pa.array([b for b, _ in parts], pa.int32()), pa.array([v for _, v in parts], pa.binary())],
        names=["salt", "block", "values"],
    )


def _context_blocks(batches, buckets: int, dimensions: int, seed: int, salts: int):
    """The context sums of one task, in blocks; texts are put together, two gaps of no word apart."""
    index = np.vstack([index_vectors(buckets, dimensions, seed), np.zeros((1, dimensions), np.int8)]).astype(np.int32)
    tokens, gap = Tokens(buckets), np.full(WINDOW, buckets)
    sums = np.zeros((buckets + 1, dimensions), np.int64)
    for batch in batches:
        waiting, size = [], 0
        for text in batch.column("text").to_pylist():
            found = tokens.of(text)
            waiting += [found, gap]
            size += len(found)
            if size >= _ROWS_AT_ONCE:
                _neighbour_sums(np.concatenate(waiting), index, sums)
                waiting, size = [], 0
        if waiting:
            _neighbour_sums(np.concatenate(waiting), index, sums)
    yield from _blocks_of(sums[:buckets], TaskContext.get().partitionId() % salts)


def _added(batches, buckets: int, dimensions: int):
    """Blocks added up by number, in one table of fixed size."""
    sums = np.zeros((buckets, dimensions), np.int64)
    for batch in batches:
        for block, values in zip(batch.column("block").to_pylist(), batch.column("values")):
            part = np.frombuffer(values.as_buffer(), "<i8").reshape(-1, dimensions)
            sums[block * BLOCK : block * BLOCK + len(part)] += part
    yield from _blocks_of(sums, 0)


def context_vectors(docs: DataFrame, buckets: int = BUCKETS, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """Context vectors of all buckets over all rows of ``docs`` (text), of unit length or zero.

    Each task sums its documents into one table of a fixed size. The tables are added up in two steps, by
    groups of tasks, an eighth as many as shuffle partitions, and then by block, so no task reads all of them.
    """
    texts = docs.select("text")
    salts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    kind = "salt int, block int, values binary"
    parts = texts.mapInArrow(lambda batches: _context_blocks(batches, buckets, dimensions, seed, salts), kind)
    for number, key in ((salts, "salt"), (min(salts, 16), "block")):
        parts = parts.repartition(number, key).mapInArrow(lambda batches: _added(batches, buckets, dimensions), kind)
    totals = save(parts, "quality-contexts").toArrow()
    table = np.zeros((buckets, dimensions))
    for block, values in zip(totals.column("block").to_pylist(), totals.column("values").to_pylist()):
        part = np.frombuffer(values, "<i8").reshape(-1, dimensions)
        table[block * BLOCK : block * BLOCK + len(part)] += part
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


@dataclass
class Model:
    """The word table (bucket by vector), the standardisation, the two layers and the temperature."""

    words: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        hidden = np.maximum((pooled - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -700, 700)))


def _pool(tokens: Tokens, words: np.ndarray, text: str) -> np.ndarray:
    """The mean word vector; zeros for a text without words. Long texts are summed in pieces."""
    found = tokens.of(text)
    total = np.zeros(words.shape[1])
    for start in range(0, len(found), _ROWS_AT_ONCE):
        total += words[found[start : start + _ROWS_AT_ONCE]].sum(axis=0, dtype=np.float64)
    return total / max(len(found), 1)


def _pooled(docs: DataFrame, words: np.ndarray, keep: list[str]) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(words)  # BUCKETS x 2 DIMENSIONS numbers
    fields = [docs.schema[c] for c in keep]

    def pooled(batches):
        tokens, table = Tokens(len(held.value)), held.value
        for batch in batches:
            rows = [_pool(tokens, table, text).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(rows, pa.binary())], names=[*keep, "pooled"]
            )

    return docs.select("text", *keep).mapInArrow(pooled, T.StructType([*fields, T.StructField("pooled", T.BinaryType())]))


def fit_network(x: np.ndarray, y: np.ndarray, words: np.ndarray, seed: int = SEED) -> Model:
    """Adam on the logistic loss; every fifth row is left out and fits the temperature."""
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    left_out = np.arange(len(y)) % 5 == 4
    mean, scale = (x[~left_out].mean(0), x[~left_out].std(0) + 1e-6) if (~left_out).any() else (np.zeros(width), np.ones(width))
    z = (x - mean) / scale
    params = [rng.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    rows, step = np.flatnonzero(~left_out), 0
    for _ in range(EPOCHS if len(rows) else 0):
        order = rng.permutation(rows)
        for start in range(0, len(order), 128):
            batch = order[start : start + 128]
            raw = z[batch] @ params[0] + params[1]
            hidden = np.maximum(raw, 0)
            logit = hidden @ params[2] + params[3]
            error = (1 / (1 + np.exp(-np.clip(logit, -35, 35))) - y[batch]) / len(batch)
            back = np.outer(error, params[2]) * (raw > 0)
            gradients = [z[batch].T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ error + 1e-4 * params[2], np.array([error.sum()])]
            step += 1
            for k, g in enumerate(gradients):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] -= 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model = Model(words, mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    if left_out.any():
        logits, truth = model.logits(x[left_out]), y[left_out]
        grid = np.geomspace(0.25, 8, 61)
        loss = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Word vectors from all of ``docs`` (doc_id, text); the network from at most ``rows`` labelled rows.

    Rows without a label, an id or a document are left out; rows that repeat count again. Without any
    labelled row the network keeps its first weights.
    """
    words = np.hstack([context_vectors(docs), index_vectors().astype(np.float32)])
    chosen = (
        labels.where("doc_id is not null and label in (0, 1)").select(F.col("doc_id").alias("__id"), "label")
        .orderBy(F.xxhash64("__id"), "__id", "label").limit(rows)
    )
    sample = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("__id")).select("__id", F.col("label").cast("int").alias("label"), "text")
    found = _pooled(sample, words, ["__id", "label"]).toArrow()
    found = found.sort_by([("__id", "ascending"), ("label", "ascending"), ("pooled", "ascending")])
    x = np.array([np.frombuffer(b) for b in found.column("pooled").to_pylist()]).reshape(-1, words.shape[1])
    y = np.array(found.column("label").to_pylist(), float)
    shuffled = np.random.default_rng(SEED).permutation(len(y))
    return fit_network(x[shuffled], y[shuffled], words)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the calibrated probability of each whole text; null texts score as empty ones.

    Texts of any length are read whole, equal texts score alike, repeated rows stay, an empty table gives
    an empty result, and a column of ``docs`` named like the score gives way to it.
    """
    docs = docs.drop(out) if out != text_col else docs
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    text_at = docs.columns.index(text_col)

    def scored(batches):
        own = held.value
        tokens = Tokens(len(own.words))
        for batch in batches:
            pooled = [_pool(tokens, own.words, text or "") for text in batch.column(text_at).to_pylist()]
            values = own.probability(np.array(pooled)) if pooled else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, out])

    return docs.mapInArrow(scored, schema)
