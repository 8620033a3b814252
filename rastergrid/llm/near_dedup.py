"""MinHash near-duplicates by an inverted join over signature coordinates.

1. Every document gets its set of word shingles and a signature; documents with the same set make a
   class, and one of each goes on.
2. Classes are posted under each pair of coordinate and value. Lists with one member are skipped.
3. Two signatures with ``matches`` equal coordinates share at least one of the first
   ``coordinates - matches + 1`` of them in any common order. The order is by length of list, shortest
   first, so long lists (frequent passages) are merged only for documents that have little else.
4. In each list one member, that with most shared and fewest own shingles, is the hub and is compared with the members
   outside its component. After some rounds, what is left of the lists is compared pair by pair between
   components. Pairs that cannot be similar are left out in the join: by their unshared shingles, or by the
   bits in which their parity bitmaps differ, which are never more than the shingles in which the sets differ.
   Groups of copies thus cost a pair per member and hub, and no link between components is lost.
5. Pairs above the match threshold are confirmed on the whole sets; components of the links are the
   result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, mark_table, portions, save, with_mark
from .shingles import Permutations, shingle_set

COORDINATES = 64
# Equal coordinates that make a candidate. At a similarity of exactly 0.75 a pair has fewer in about
# 3 of a million cases.
MATCHES = 32
SIMILARITY = (75, 100)
SEED = 11
# Go on with hubs while the pairs left are more than this many times the members, for some rounds.
PAIRS_PER_MEMBER = 1
HUB_ROUNDS = 2
# 64-bit words of a parity bitmap.
BITMAP_WORDS = 16


def _set_key(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _parity(shingles: np.ndarray) -> np.ndarray:
    """For each of the bitmap's places, whether an odd number of shingles falls on it."""
    size = 64 * BITMAP_WORDS
    counts = np.bincount((shingles % np.uint64(size)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _signatures(batches, coordinates: int, seed: int):
    permutations = Permutations(coordinates, seed)
    for batch in portions(batches):
        counts, keys, signatures = [], [], []
        for text in batch.column("text").to_pylist():
            shingles = shingle_set(text)
            counts.append(len(shingles))
            keys.append(_set_key(shingles))
            signatures.append(permutations.signature(shingles).view(np.int32))
        values = np.concatenate(signatures) if signatures else np.empty(0, np.int32)
        offsets = np.arange(0, len(values) + 1, coordinates, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
             pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))],
            names=["doc_id", "n_shingles", "set_key", "signature"],
        )


def _sets(batches):
    for batch in portions(batches):
        found = [shingle_set(text) for text in batch.column("text").to_pylist()]
        offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
        values = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
        bits = np.concatenate([_parity(s) for s in found]) if found else np.empty(0, np.int64)
        places = np.arange(0, len(bits) + 1, BITMAP_WORDS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(values, pa.int64())),
             pa.array(map(_set_key, found), pa.binary()), pa.ListArray.from_arrays(places, pa.array(bits, pa.int64()))],
            names=["doc_id", "shingles", "set_key", "bits"],
        )


def signatures(docs: DataFrame, coordinates: int = COORDINATES, seed: int = SEED) -> DataFrame:
    """doc_id, n_shingles, set_key (null for an empty set) and signature of every row (doc_id, text)."""
    return docs.mapInArrow(
        lambda batches: _signatures(batches, coordinates, seed),
        "doc_id bigint, n_shingles bigint, set_key binary, signature array<int>",
    )


def prefix_lists(classes: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """(key, rep, weight) for the lists that must be merged, each with two members at least.

    ``weight`` is the number of collisions of the member over all its coordinates.
    """
    posted = classes.select("rep", F.posexplode("signature").alias("__place", "__value")).select(
        "rep", F.xxhash64("__place", "__value").alias("key")
    )
    lengths = save(posted.groupBy("key").agg(F.count("*").alias("length")).where("length > 1"), "near-lengths")
    marks = save(mark_table(lengths, "key"), "near-marks")
    shared = with_mark(posted, "key", marks, "__shared").where("__shared").select("rep", "key").join(lengths, "key")
    shared = save(shared, "near-shared")
    # A document has one row per coordinate here, so its window is small. Its other lists have one
    # member and stand first in the order.
    of_rep = Window.partitionBy("rep")
    ordered = shared.withColumns(
        {
            "__all": F.count("*").over(of_rep), "weight": F.sum("length").over(of_rep),
            "__place": F.row_number().over(of_rep.orderBy("length", "key")),
        }
    ).where(
        (F.col("__all") >= matches)
        & (F.col("__place") + coordinates - F.col("__all") <= coordinates - matches + 1)
    ).select("key", "rep", "weight")
    members = save(ordered, "near-prefixes")
    again = save(members.groupBy("key").agg(F.count("*").alias("__n")).where("__n > 1").select("key"), "near-lists")
    return save(members.join(again, "key"), "near-members")


def _close(pairs: DataFrame, sets: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``matches`` coordinates; only signatures are read for it."""
    def side(name):
        return sets.select(F.col("rep").alias(name), F.col("signature").alias(f"__sig_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    equal = F.size(F.filter(F.zip_with("__sig_a", "__sig_b", lambda x, y: x == y), lambda x: x))
    return save(both.where(equal >= matches).select("a", "b"), "near-close")


def _confirmed(pairs: DataFrame, sets: DataFrame, matches: int, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) with enough equal coordinates whose whole sets are similar enough."""
    def side(name):
        return sets.select(F.col("rep").alias(name), F.col("shingles").alias(f"__set_{name}"))

    both = _close(pairs, sets, matches).join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("__set_a", "__set_b"))
    whole = F.size("__set_a") + F.size("__set_b") - common
    return both.where(similarity[1] * common >= similarity[0] * whole).select("a", "b")


def _own_and_shared(sets: DataFrame) -> DataFrame:
    """(rep, bits, own, shared): how many shingles no other candidate has, and how many another has too."""
    exploded = sets.select("rep", F.explode("shingles").alias("__shingle"))
    single = exploded.groupBy("__shingle").agg(F.min("rep").alias("rep"), F.count("*").alias("__n")).where("__n = 1")
    own = single.groupBy("rep").agg(F.count("*").alias("own"))
    sized = sets.select("rep", "bits", F.size("shingles").alias("__all"))
    return sized.join(own, "rep", "left").select(
        "rep", "bits", F.coalesce("own", F.lit(0)).alias("own"), (F.col("__all") - F.coalesce("own", F.lit(0))).alias("shared")
    )


def _joined(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """Components (node, label) after new links: only links between components are followed."""
    if labels is None:
        return components(found)
    known = labels.select(F.col("node").alias("a"), F.col("label").alias("__la"))
    ends = found.join(known, "a", "left").join(known.toDF("b", "__lb"), "b", "left")
    between = ends.select(F.coalesce("__la", "a").alias("a"), F.coalesce("__lb", "b").alias("b")).where("a <> b")
    lifted = components(between.distinct())
    moved = labels.join(lifted.toDF("label", "__to"), "label", "left").select("node", F.coalesce("__to", "label").alias("label"))
    fresh = lifted.join(labels, "node", "left_anti")
    return save(moved.unionByName(fresh), "near-components")


def _pairs(members: DataFrame, other: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Distinct pairs of a list, between components, that can be similar at all.

    What two sets have in common is at most the smaller of their shared parts, and their union is at least
    the larger of these with both their own parts. Two sets of together n shingles with a similarity of t differ
    in at most n (1 - t) / (1 + t) of them, and their bitmaps in no more places than that.
    """
    t, whole = similarity
    b = other.select("key", *[F.col(c).alias(f"__{c}") for c in ("rep", "component", "own", "shared", "bits")])
    union = F.greatest("shared", "__shared") + F.col("own") + F.col("__own")
    possible = whole * F.least("shared", "__shared") >= t * union
    differ = sum((F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("__bits")[k])) for k in range(BITMAP_WORDS)), F.lit(0))
    sizes = F.col("own") + F.col("shared") + F.col("__own") + F.col("__shared")
    near = (whole + t) * differ <= (whole - t) * sizes
    pairs = members.join(b, "key").where((F.col("component") != F.col("__component")) & possible & near)
    return pairs.select(F.least("rep", "__rep").alias("a"), F.greatest("rep", "__rep").alias("b")).distinct()


def linked_classes(classes: DataFrame, docs: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES,
                   similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """(node, label) for the classes with a similar one: the smallest class of their component."""
    listed = prefix_lists(classes, coordinates, matches)
    wanted = save(listed.select("rep").distinct(), "near-wanted")
    marks = save(mark_table(wanted, "rep"), "near-wanted-marks")
    texts = with_mark(docs.withColumnRenamed("doc_id", "rep"), "rep", marks, "__wanted").where("__wanted")
    texts = texts.select("rep", "text").join(wanted, "rep")
    found = texts.select(F.col("rep").alias("doc_id"), "text").mapInArrow(_sets, "doc_id bigint, shingles array<bigint>, set_key binary, bits array<bigint>")
    # Where an id has several rows, that of the class counts.
    chosen = classes.join(wanted, "rep", "left_semi").select("rep", "set_key", "signature")
    sets = found.withColumnRenamed("doc_id", "rep").join(chosen, ["rep", "set_key"]).dropDuplicates(["rep"])
    sets = save(sets.select("rep", "signature", "shingles", "bits"), "near-sets")
    parts = _own_and_shared(sets).where((similarity[1] - similarity[0]) * F.col("shared") >= similarity[0] * F.col("own"))
    members = save(listed.join(parts, "rep").withColumn("component", F.col("rep")), "near-possible")
    labels, round_ = None, 0
    while True:
        # Pairs that are left: those of different components, list by list.
        inside = members.groupBy("key", "component").agg(
            F.count("*").alias("__n"), F.max(F.struct(F.col("shared") - F.col("own"), "weight", (-F.col("rep")).alias("minus"))).alias("__hub")
        )
        hubs = save(
            inside.groupBy("key").agg(
                ((F.pow(F.sum("__n"), F.lit(2)) - F.sum(F.col("__n") * F.col("__n"))) / 2).alias("__pairs"),
                F.sum("__n").alias("__n"), F.max("__hub").alias("__hub"),
            ).where("__pairs > 0").select("key", "__pairs", "__n", (-F.col("__hub.minus")).alias("rep")),
            "near-hubs",
        )
        left, size = hubs.agg(F.sum("__pairs"), F.sum("__n")).first()
        if not size:
            break
        last = left <= PAIRS_PER_MEMBER * size or round_ >= HUB_ROUNDS
        open_ = members.join(hubs.select("key"), "key")
        hub_rows = members.join(hubs.select("key", "rep"), ["key", "rep"])
        pairs = _pairs(open_, open_ if last else hub_rows, similarity)
        labels = _joined(labels, save(_confirmed(pairs, sets, matches, similarity), "near-links"))
        if last:
            break
        # A hub has met every member of its list that was outside its component.
        rest = open_.join(hubs.select("key", "rep"), ["key", "rep"], "left_anti").drop("component")
        rest = rest.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        members = save(
            rest.select("key", "rep", "weight", "own", "shared", "bits", F.coalesce("label", "rep").alias("component")), "near-left"
        )
        round_ += 1
    if labels is None:
        return wanted.select(F.col("rep").alias("node"), F.col("rep").alias("label")).limit(0)
    return labels


def near_dedup(docs: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES,
               similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Texts without words have an empty set, are linked with nothing and stay. A row with a null id belongs to
    its class but names no component; without another id its component is null, and it stays. Rows that
    repeat an id are all rows of one document. Very long texts are hashed in blocks. An empty table
    gives an empty result.
    """
    signed = save(signatures(docs, coordinates), "near-signatures")
    classes = signed.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "signature", "n_shingles")).alias("__first")
    )
    classes = save(
        classes.select("set_key", F.col("__first.doc_id").alias("rep"), "__first.signature", "__first.n_shingles"),
        "near-classes",
    )
    found = linked_classes(classes, docs, coordinates, matches, similarity).withColumnRenamed("node", "rep")
    named = save(
        classes.select("set_key", "rep").join(found, "rep", "left")
        .select("set_key", F.coalesce("label", "rep").alias("component_id")),
        "near-named",
    )
    rows = signed.select("doc_id", "n_shingles", "set_key")
    with_words = rows.where("set_key is not null").join(named, "set_key", "left")
    without = rows.where("set_key is null").withColumn("component_id", F.col("doc_id"))
    return (
        with_words.select("doc_id", "n_shingles", "component_id")
        .unionByName(without.select("doc_id", "n_shingles", "component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
