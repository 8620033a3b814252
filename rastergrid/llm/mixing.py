"""Mixing sources to target weights along a curriculum.

Targets are found by filling: every source's share grows with its weight until it meets its limit.
Each source has a weight schedule over training time 0..1; its integral, scaled to the source's
target, is the cumulative demand for its words. Documents of a source are laid end to end in a seeded
order (and again for a second pass), and the time at which the demand reaches the middle of a
document's words is its training position. Sorting by position range gives the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = "mix-1"
# Rows that a prefix sum walks through in one window.
BLOCK_ROWS = 2_000
# Relative weight at the knots of training time, by place in WEIGHTS: falling, flat, rising.
SCHEDULES = (((0.0, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 2.0)))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """source, source_size, rank and target from one row (source, source_size) per source.

    Sources take the weights in turn, by code point, null last. The targets add up to ``share`` of all
    words; a target stops at ``repeats`` times its source and the rest is shared anew by weight. One
    row per source goes through a single window.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.withColumns({"__weight": weight, "__limit": F.col("source_size") * F.lit(float(repeats))})
    # Sources reach their limit in the order of limit by weight. A source stays below it as soon as
    # the level of those not full is under its own ratio.
    by_ratio = Window.orderBy(F.col("__limit") / F.col("__weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    full = F.coalesce(F.sum("__limit").over(before), F.lit(0.0))
    open_weight = F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(before), F.lit(0.0))
    words = F.lit(share) * F.sum("source_size").over(everything)
    level = ranked.withColumn("__level", (words - full) / open_weight)
    level = level.withColumn("__open", F.col("__level") * F.col("__weight") < F.col("__limit"))
    least = F.min(F.when(F.col("__open"), F.struct(F.col("__limit") / F.col("__weight"), F.col("rank"), F.col("__level")))).over(everything)
    level = level.withColumn("__final", least["__level"])
    target = F.least(F.col("__limit"), F.coalesce(F.col("__final") * F.col("__weight"), F.col("__limit")))
    return level.select("source", "source_size", "rank", target.alias("target"))


def _position(share: Column, schedule) -> Column:
    """The time at which the integral of a piecewise linear weight reaches ``share`` of its whole."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:])]
    need = share * F.lit(sum(areas))
    result, done = F.lit(1.0), sum(areas)
    for k in reversed(range(len(areas))):
        (t0, w0), (t1, w1) = schedule[k], schedule[k + 1]
        done -= areas[k]
        slope, rest = (w1 - w0) / (t1 - t0), F.greatest(need - F.lit(done), F.lit(0.0))
        # w0 * x + slope / 2 * x^2 = rest, in the form that has no cancellation
        x = 2 * rest / (F.lit(w0) + F.sqrt(F.lit(w0 * w0) + F.lit(2 * slope) * rest))
        result = F.when(need < F.lit(done + areas[k]), F.lit(t0) + x).otherwise(result)
    return result


def _reached(at: float, schedule) -> float:
    """The share of its whole that the integral of a piecewise linear weight has reached at a time; inverse of ``_position``."""
    done = whole = 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        x = min(max(at - t0, 0.0), t1 - t0)
        done += x * (w0 + w0 + (w1 - w0) * x / (t1 - t0)) / 2
        whole += (t1 - t0) * (w0 + w1) / 2
    return done / whole


def mix(
    docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
    repeats: int = REPEATS, schedules=SCHEDULES, block_rows: int = BLOCK_ROWS, until: float = 1.0,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): size, source_size, target, taken, positions, text_key.

    ``taken`` is the number of words that the mix takes of the document over all passes up to the training time ``until``. The
    words taken of a source are its cumulative demand at that time rounded down (its target, at the end), so one document
    of a source may be taken in part. Rows come in training order, sorted by range of their first position, those not taken last.
    ``positions`` has one training time for each pass that takes of the document. Null texts have no
    words and are never taken; a null source is a source. Rows that repeat are taken as rows of their own, and
    rows with the same id are told apart by their text. Texts of any length count whole. An empty table
    gives an empty result; columns of ``docs`` besides the three are not looked at.
    """
    words = F.regexp_count("text", F.lit(WORD)).cast("bigint")
    # Equal rows get the same key, and swapping equal rows changes nothing.
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    rows = save(
        docs.select("doc_id", "source", F.coalesce(words, F.lit(0)).alias("size"), key.alias("__key"),
                    F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")),
        "mix-rows",
    )
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__rows"))
    sources = save(
        source_targets(by_source, weights, share, repeats)
        .join(by_source.select(F.col("source").alias("__s"), "__rows"), F.col("source").eqNullSafe(F.col("__s")))
        .select("source", "source_size", "rank", "target", F.ceil(F.col("__rows") / block_rows).alias("__blocks")),
        "mix-sources",
    )
    # Prefix sums in two levels: blocks are ranges of the key, so the order of blocks is that of keys.
    fraction = F.conv(F.substring("__key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    known = sources.select(F.col("source").alias("__s"), "source_size", "rank", "target", "__blocks")
    placed = rows.join(known, F.col("source").eqNullSafe(F.col("__s"))).drop("__s").withColumn(
        "__block", F.floor(fraction * F.col("__blocks")).cast("int")
    )
    totals = placed.groupBy("rank", "__block").agg(F.sum("size").alias("__words"))
    starts = totals.select(
        "rank", "__block",
        (F.sum("__words").over(Window.partitionBy("rank").orderBy("__block")) - F.col("__words")).alias("__start"),
    )
    inside = Window.partitionBy("rank", "__block").orderBy("__key", "size", "text_key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    laid = placed.withColumn("__end", F.sum("size").over(inside)).join(save(starts, "mix-starts"), ["rank", "__block"])
    laid = laid.withColumn("__begin", F.col("__start") + F.col("__end") - F.col("size"))
    which = F.pmod("rank", F.lit(len(weights)))

    def reached(share_done):
        position = _position(share_done, schedules[-1])
        for k in range(len(schedules) - 1):
            position = F.when(which == k, _position(share_done, schedules[k])).otherwise(position)
        return position

    # A pass takes the words that the cumulative demand has reached at the end of the time asked for.
    demands = [F.floor(F.col("target") * F.lit(_reached(until, schedule))) for schedule in schedules]
    demand = F.element_at(F.array(*demands), F.least(which, F.lit(len(schedules) - 1)).cast("int") + 1)
    passes = []
    for turn in range(repeats):
        begin = F.col("__begin") + turn * F.col("source_size")
        part = F.greatest(F.lit(0), F.least(F.col("size"), demand - begin))
        middle = reached((begin + part / 2) / F.col("target"))
        passes.append(F.when(part > 0, F.struct(middle.alias("at"), part.alias("words"))))
    passes = laid.withColumn("__passes", F.array_compact(F.array(*passes)))
    taken = F.aggregate("__passes", F.lit(0).cast("bigint"), lambda total, one: total + one["words"])
    mixed = passes.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), F.col("__passes.at").alias("positions"), "text_key",
    )
    # Ids deal rows over ranges where positions do not, as those that are not taken have none.
    order = [F.try_element_at("positions", F.lit(1)).asc_nulls_last(), F.col("doc_id"), F.col("text_key")]
    return save(mixed, "mixed").repartitionByRange(*order).sortWithinPartitions(*order)


def training_order(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents that the mix takes, once for each pass, sorted by range of training position.

    A document taken in part comes whole. The result has the columns of ``docs``, whatever their names; of rows
    that repeat entirely each comes as often as the mix takes it.
    """
    places = (
        mixed.where("taken > 0").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"),
                                        F.col("source").alias("__source"), "positions")
        .groupBy("__id", "__text", "__source").agg(F.flatten(F.collect_list("positions")).alias("__positions"),
                                                   F.count("*").alias("__copies"))
    )
    key, at = unused(docs, "text_key"), unused(docs, "position")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    places = save(places, "mix-places")
    if not places.where("__copies > 1").isEmpty():
        # The positions of repeated rows are together already.
        keyed = keyed.dropDuplicates(["doc_id", key, "source"])
    joined = keyed.alias("d").join(
        places.alias("p"),
        F.col("d.doc_id").eqNullSafe(F.col("p.__id")) & (F.col(f"d.{key}") == F.col("p.__text"))
        & F.col("d.source").eqNullSafe(F.col("p.__source")),
    )
    spread = joined.select(*[F.col(f"d.`{c}`") for c in docs.columns], F.explode("p.__positions").alias(at))
    return spread.repartitionByRange(at).sortWithinPartitions(at).select(*[F.col(f"`{c}`") for c in docs.columns])
