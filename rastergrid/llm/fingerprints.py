"""MinHash fingerprints of documents and of edited copies, and near pairs by signature bands.

Each text needs the next one by id. Documents are dealt into cells, which are ranges of ids of about the
same bytes; the first document of each cell also goes to the end of the cell before, and every cell is
walked in order by a task of its own. So texts are shuffled once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shingles import Permutations, shingle_set

PERMUTATIONS = 64
SEED = 21
BANDS = 16
CELL_BYTES = 16 << 20
# A document counts once for each so many bytes when ranges of ids are chosen.
_WEIGHT_BYTES = 16 << 10
# Rows of an Arrow batch that become Python strings at a time.
_ROWS_AT_ONCE = 500
_LOWEST = -(1 << 63)


def fingerprint(text: str, permutations: Permutations) -> np.ndarray:
    """16 bits of the least value of each permutation over the text's 5-word shingles."""
    return (permutations.signature(shingle_set(text)) & np.uint32(0xFFFF)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal permutations, an estimate of the Jaccard similarity."""
    return float(np.mean(a == b))


def with_next(text: str, after: str) -> str:
    """The text whose last floor(n/2) code points are replaced by the first as many of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _cells(batches, heads: np.ndarray):
    """Rows with their cell; the head of a cell comes again as the tail of the cell before."""
    rising = heads[::-1]
    for batch in batches:
        ids = pc.fill_null(batch.column("doc_id"), _LOWEST).to_numpy(zero_copy_only=False)
        # heads fall; cell k has the ids from heads[k] down to above heads[k + 1], the last one also all null ids.
        cell = np.clip(len(heads) - 1 - np.searchsorted(rising, ids, side="left"), 0, None) if len(heads) else np.zeros(len(ids), int)
        is_head = (heads[cell] == ids) if len(heads) else np.zeros(len(ids), bool)
        is_head &= batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        before = (cell[is_head] - 1) % max(len(heads), 1)
        table = pa.Table.from_batches([batch])
        own = table.append_column("cell", pa.array(cell, pa.int32())).append_column("tail", pa.array(np.zeros(len(ids), bool)))
        again = table.filter(pa.array(is_head)).append_column("cell", pa.array(before, pa.int32())).append_column(
            "tail", pa.array(np.ones(len(before), bool))
        )
        yield from own.to_batches()
        yield from again.to_batches()


_RESULT = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
     T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
     T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
     T.StructField("near_next", T.DoubleType())]
)


def _walk(batches, count: int, seed: int):
    permutations = Permutations(count, seed)
    names = [f.name for f in _RESULT.fields]
    held = first = None  # (cell, id, text, fingerprint)
    done: list[tuple] = []

    def row(one, after):
        edited = with_next(one[2], after[2])
        mark = fingerprint(edited, permutations)
        return (one[1], len(one[2]), hashlib.sha256(edited.encode()).hexdigest(), one[3].tobytes().hex(),
                mark.tobytes().hex(), likeness(one[3], mark), likeness(one[3], after[3]))

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(x), t) for x, t in zip(zip(*rows), [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])],
            names=names,
        )

    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
            part = batch.slice(start, _ROWS_AT_ONCE)
            for cell, tail, key, text in zip(*[part.column(c).to_pylist() for c in ("cell", "tail", "doc_id", "text")]):
                if held is not None and held[0] != cell:
                    done.append(row(held, first))
                    held = None
                if tail and held is None:
                    continue
                now = (cell, key, text, fingerprint(text, permutations))
                if held is not None:
                    done.append(row(held, now))
                elif not tail:
                    first = now
                held = None if tail else now
            if done:
                yield batch_of(done)
                done = []
    if held is not None:
        # Only a table without ids has a cell without a tail: its first row follows its last.
        yield batch_of([row(held, first)])


def fingerprints(docs: DataFrame, count: int = PERMUTATIONS, seed: int = SEED, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with the fingerprints of its text and its edited text.

    The next document is the one with the next smaller id; after the smallest comes the largest, and a
    single document follows itself. Rows with the same id follow each other by text; null ids come last.
    Texts without words share one fingerprint. An empty table gives an empty result.
    """
    bytes_ = F.octet_length("text").cast("bigint")
    total = docs.agg(F.sum(bytes_)).first()[0] or 0
    cells = max(1, -(-int(total) // cell_bytes))
    # Ranges of ids only, each id as often as it weighs; the largest id of each range heads a cell.
    weights = docs.where("doc_id is not null").select("doc_id", F.explode(F.sequence(F.lit(0), (bytes_ / _WEIGHT_BYTES).cast("int"))))
    ranges = weights.select("doc_id").repartitionByRange(cells, F.col("doc_id").desc())
    found = ranges.groupBy(F.spark_partition_id()).agg(F.max("doc_id").alias("head")).select("head").toArrow().column("head")
    heads = np.sort(found.to_numpy())[::-1].copy()
    dealt = docs.select("doc_id", "text").mapInArrow(
        lambda batches: _cells(batches, heads), "doc_id bigint, text string, cell int, tail boolean"
    )
    ordered = dealt.repartitionById(max(1, len(heads)), F.col("cell")).sortWithinPartitions(
        "cell", "tail", F.col("doc_id").desc_nulls_last(), "text"
    )
    return ordered.mapInArrow(lambda batches: _walk(batches, count, seed), _RESULT)


def near_pairs(docs: DataFrame, count: int = PERMUTATIONS, bands: int = BANDS, seed: int = SEED,
               similarity: float = 0.75) -> DataFrame:
    """Pairs (a, b, similarity) that share a signature band and whose whole shingle sets are similar.

    Each band value links its documents to the one with the smallest id, so copies cost one pair each.
    """
    def signed(batches):
        permutations = Permutations(count, seed)
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
            marks = [permutations.signature(s).view(np.int32).tolist() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s.view(np.int64).tolist() for s in sets], pa.list_(pa.int64())),
                 pa.array(marks, pa.list_(pa.int32()))], names=["doc_id", "shingles", "signature"],
            )

    from .common import save

    rows = save(
        docs.select("doc_id", "text").where("doc_id is not null")
        .mapInArrow(signed, "doc_id bigint, shingles array<bigint>, signature array<int>").where("size(shingles) > 0"),
        "fingerprint-sets",
    )
    width = count // bands
    band = F.explode(F.array(*[F.xxhash64(F.lit(k), F.slice("signature", k * width + 1, width)) for k in range(bands)]))
    banded = rows.select("doc_id", band.alias("band"))
    hubs = save(banded.groupBy("band").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).where("n > 1"), "fingerprint-bands")
    pairs = banded.join(hubs, "band").where("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct()
    sides = [rows.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", (common / (F.size("sa") + F.size("sb") - common)).alias("similarity")).where(
        F.col("similarity") >= similarity
    )
