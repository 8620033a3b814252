"""Ranked lexical search by presence masks.

Tasks keep of each document the terms of the queries that it has. For each query, a block of documents
is grouped by mask: bit k of a document's mask tells whether it has the query's term k. A mask bounds
the score of its documents, as every term gives at most the best it gives anywhere in the block. Masks
are evaluated from the greatest bound down until no bound left can reach the query's last place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

TOP = 10
# Terms of all queries of one block, about; more queries go through the documents in further blocks.
BLOCK_TERMS = 1 << 19
_DOCS_AT_ONCE = 8192
_FIRST_MASKS = 32
_NONE = -(1 << 63)


def _table() -> bytes:
    """ASCII but letters and digits becomes space, A-Z lower case; other bytes stay."""
    table = bytearray(range(256))
    for byte in range(128):
        char = chr(byte)
        table[byte] = ord(char.lower()) if char.isalnum() else 32
    return bytes(table)


_BYTES = _table()


def terms(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case."""
    return text.encode().translate(_BYTES).split()


@dataclass
class Queries:
    """A block of queries: terms, and for each query the numbers of its terms."""

    numbers: dict[bytes, int]
    ids: list
    wanted: list[np.ndarray]


def _postings(batches, queries: Queries):
    """Per document: number of terms, and the query terms it has with their counts."""
    numbers = queries.numbers
    for batch in batches:
        sizes, have, often = [], [], []
        for text in batch.column("text").to_pylist():
            found = terms(text)
            own, counts = np.unique(np.array([numbers[t] for t in found if t in numbers], np.int32), return_counts=True)
            sizes.append(len(found))
            have.append(own.astype("<i4").tobytes())
            often.append(counts.astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(have, pa.binary()), pa.array(often, pa.binary())],
            names=["doc_id", "n", "terms", "counts"],
        )


def _holding(batches, count: int):
    """In how many documents of a task each term is."""
    total = np.zeros(count, np.int64)
    for batch in batches:
        joined = b"".join(batch.column("terms").to_pylist())
        total += np.bincount(np.frombuffer(joined, "<i4"), minlength=count)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["term", "df"])


class Block:
    """Documents with what each of their terms gives: by document, and by term."""

    def __init__(self, ids, sizes, have, often, documents: int, length: int, count: int):
        self.ids, self.size = ids, len(ids)
        lengths = np.array([len(h) // 4 for h in have])
        self.begin = np.concatenate([[0], np.cumsum(lengths)])
        self.term = np.frombuffer(b"".join(have), "<i4").astype(np.int64)
        tf = np.frombuffer(b"".join(often), "<i4").astype(np.int64)
        doc = np.repeat(np.arange(self.size), lengths)
        m = 10 + 90 * sizes * documents // max(length, 1)
        self.gives = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
        order = np.argsort(self.term, kind="stable")
        self.by_term = doc[order]
        self.start = np.searchsorted(self.term[order], np.arange(count + 1))
        self.best = np.zeros(count, np.int64)
        np.maximum.at(self.best, self.term, self.gives)

    def masks(self, wanted: np.ndarray):
        """Distinct masks as rows of 64-bit words, and the documents of each."""
        masks = np.zeros((self.size, -(-len(wanted) // 64)), np.uint64)
        for k, term in enumerate(wanted.tolist()):
            masks[self.by_term[self.start[term] : self.start[term + 1]], k // 64] |= np.uint64(1 << (k % 64))
        if masks.shape[1] == 1:
            distinct, group = np.unique(masks[:, 0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            distinct, group = np.unique(masks, axis=0, return_inverse=True)
        order = np.argsort(group.ravel(), kind="stable")
        return distinct, order, np.searchsorted(group.ravel()[order], np.arange(len(distinct) + 1))

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of documents; ``weights`` has 0 for terms that the query has not."""
        lengths = self.begin[docs + 1] - self.begin[docs]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[docs] - (ends - lengths), lengths)
        total = np.concatenate([[0], np.cumsum(weights[self.term[places]] * self.gives[places])])
        return total[ends] - total[ends - lengths]


def _better(best: list, ids: np.ndarray, scores: np.ndarray, top: int) -> list:
    """The best ``top`` of (score, id): highest score, then lowest id, null ids (the lowest number) last."""
    good = np.flatnonzero(scores > 0)
    if len(good) > top:
        least = np.partition(scores[good], -top)[-top]
        good = good[scores[good] >= least]
    rows = best + [(-int(s), int(i) == _NONE, int(i)) for s, i in zip(scores[good], ids[good])]
    return sorted(rows)[:top]


def _ranked(batches, queries: Queries, weight: np.ndarray, documents: int, length: int, top: int):
    """The best documents of a task for every query."""
    found: list[list] = [[] for _ in queries.ids]
    of_query = np.zeros(len(weight), np.int64)

    def work(rows):
        table = pa.Table.from_batches(rows)
        ids = table.column("doc_id").fill_null(_NONE).to_numpy()
        block = Block(ids, table.column("n").to_numpy(), table.column("terms").to_pylist(), table.column("counts").to_pylist(),
                      documents, length, len(weight))
        for k, wanted in enumerate(queries.wanted):
            distinct, order, start = block.masks(wanted)
            gain = weight[wanted] * block.best[wanted]
            bits = np.unpackbits(distinct.view(np.uint8), axis=1, bitorder="little", count=len(wanted))
            bounds = bits @ gain
            falling = np.argsort(-bounds, kind="stable")
            of_query[wanted] = weight[wanted]
            at, step = 0, _FIRST_MASKS
            while at < len(falling) and bounds[falling[at]] > 0:
                # Nothing left can take a place; an equal score still can, by its id.
                if len(found[k]) == top and bounds[falling[at]] < -found[k][-1][0]:
                    break
                chosen = falling[at : at + step]
                docs = np.concatenate([order[start[g] : start[g + 1]] for g in chosen])
                found[k] = _better(found[k], block.ids[docs], block.scores(docs, of_query), top)
                at, step = at + step, step * 2
            of_query[wanted] = 0

    waiting, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, _DOCS_AT_ONCE):
            part = batch.slice(start, _DOCS_AT_ONCE)
            waiting.append(part)
            size += part.num_rows
            if size >= _DOCS_AT_ONCE:
                work(waiting)
                waiting, size = [], 0
    if waiting:
        work(waiting)
    rows = [(k, None if none else i, -s) for k, best in enumerate(found) for s, none, i in best]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64()))], names=["query", "doc_id", "score"]
        )


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` best rows of ``docs`` (doc_id, text) for each of ``queries`` (item_id, text): item_id, rank, doc_id, score.

    Rows of ``queries`` with one item_id make one query of all their terms. Null texts have no terms, and
    a query without terms, or without a document that has any, has no rows. Only scores above 0 rank, equal ones by
    ascending doc_id, null last; rows of ``docs`` that repeat rank each for itself. Texts of any length are read whole.
    Empty tables give an empty result; other columns of either table are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    asked = queries.select(queries["item_id"].cast("bigint").alias("item_id"), F.coalesce(queries["text"], F.lit("")).alias("text"))

    def split(batches):
        for batch in batches:
            own = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(own, pa.list_(pa.binary()))], names=["item_id", "terms"])

    wanted = asked.mapInArrow(split, "item_id bigint, terms array<binary>").select("item_id", F.explode("terms").alias("term")).distinct()
    wanted = save(wanted, "search-terms")
    blocks = max(1, -(-wanted.count() // block_terms))
    results = None
    for number in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number)
        found = _search_block(spark, rows, part.orderBy("item_id", "term").toArrow(), top)
        results = found if results is None else results.unionByName(found)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return results.withColumn("rank", place).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _search_block(spark, rows: DataFrame, wanted: pa.Table, top: int) -> DataFrame:
    """The best documents of every task for a block of queries, whose terms the driver holds."""
    asked: dict = {}
    numbers: dict[bytes, int] = {}
    for item, term in zip(wanted.column("item_id").to_pylist(), wanted.column("term").to_pylist()):
        asked.setdefault(item, []).append(numbers.setdefault(term, len(numbers)))
    block = Queries(numbers, list(asked), [np.array(v, np.int64) for v in asked.values()])
    held = spark.sparkContext.broadcast(block)  # about BLOCK_TERMS terms
    postings = save(
        rows.mapInArrow(lambda batches: _postings(batches, held.value), "doc_id bigint, n bigint, terms binary, counts binary"),
        "search-postings",
    )
    totals = postings.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    documents, length = totals["documents"], totals["length"]
    df = np.zeros(len(numbers), np.int64)
    counts = postings.select("terms").mapInArrow(lambda batches: _holding(batches, len(held.value.numbers)), "term bigint, df bigint")
    counted = counts.groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
    weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    weights = spark.sparkContext.broadcast(weight)
    ranked = postings.mapInArrow(
        lambda batches: _ranked(batches, held.value, weights.value, documents, length, top), "query bigint, doc_id bigint, score bigint"
    )
    kind = "query bigint, item_id bigint"
    names = spark.createDataFrame(pa.table({"query": pa.array(range(len(block.ids)), pa.int64()), "item_id": pa.array(block.ids, pa.int64())}), kind)
    return ranked.join(F.broadcast(names), "query").select("item_id", "doc_id", "score")
