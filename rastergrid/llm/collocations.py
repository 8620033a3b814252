"""Phrase collocations by Toivonen's method: a sample proposes, full passes count until the border holds.

1. A bounded sample of documents proposes words and pairs at a lowered threshold.
2. Full passes count all words, every pair of proposed words and every triple of proposed pairs: the
   proposals and their negative border (what is not proposed itself but all parts of which are).
3. Words or pairs of the border that turn out frequent are proposed too, and a further pass counts what
   this newly puts inside or on the border. When no proposal is added, every frequent phrase is counted.

Tasks cut texts into words in numpy and count within a bounded number of words; what they emit is added
up by Spark. A word travels as a 64-bit hash. The words themselves are counted by their texts, and
if two have one hash, everything is counted again under another seed, so counts are exact. What is
proposed goes to tasks as bitmaps of a bounded size; a bit that is set by chance costs counting only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

LEAST = 10
TOP = 2_000
COVERED = (50, 100)
# Bytes of text that propose phrases, about; everything is counted in all texts.
SAMPLE_BYTES = 64 << 20
# A proposal needs this share of the count to be expected in the sample of a phrase with the least frequency, and two at least.
LOWERED = 0.5
# Bits of a bitmap for each member, and their limits (32 MiB).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 28
_CHUNK = 1 << 20
_WORDS_AT_ONCE = 1 << 18
# Rows of an Arrow batch, coming in as texts and going out as counts.
_TEXTS_AT_ONCE, _ROWS_AT_ONCE = 500, 1 << 15
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
# Words are counted by their texts, pairs (h3 = 0) and triples by the hashes of their words, in narrow rows.
_WORD = ["lang", "word", "h1"]
_WORD_COUNTED = "lang string, word string, h1 bigint, n bigint"
_NGRAM = ["h1", "h2", "h3"]
_NGRAM_COUNTED = "h1 bigint, h2 bigint, h3 bigint, n bigint"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of pairs for bitmaps; ``_PAIR_HASH`` is the same in SQL."""
    left, right = left.astype(np.uint64), right.astype(np.uint64)
    x = (left << np.uint64(17) | left >> np.uint64(47)) ^ right
    return (x ^ (x >> np.uint64(23))).astype(np.int64)


_TURNED = "((shiftleft(h1, 17) | shiftrightunsigned(h1, 47)) ^ h2)"
_PAIR_HASH = f"({_TURNED} ^ shiftrightunsigned({_TURNED}, 23))"


class Words:
    """Cuts texts into words and hashes them: a sum over bytes of a random value times a power of place."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = int(rng.integers(1 << 40, 1 << 62)) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.salt = int(rng.integers(1, 1 << 62))
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.lower = lower
        self.kind = np.zeros(256, np.uint8)  # 0 in a word, 1 between words, 2 between pieces
        self.kind[[32, 9]] = 1
        self.kind[list(_SEPARATORS)] = 2
        self.powers = self.back = np.empty(0, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            for name, number in (("powers", self.base), ("back", self.inverse)):
                steps = np.full(size, number, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def of(self, data: np.ndarray, salt: int):
        """Hashes of the words of ``data`` (bytes), whether each follows the one before in its piece, and their ends."""
        low = self.lower[data]
        kind = self.kind[low]
        inside = np.concatenate([[False], kind == 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.empty(0, np.int64), np.empty(0, bool), starts, ends, low
        self._grow(len(data) + 1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(self.values[low] * self.powers[: len(low)], dtype=np.uint64)])
        hashed = _mix((total[ends] - total[starts]) * self.back[starts] + np.uint64(salt))
        breaks = np.concatenate([[0], np.cumsum(kind == 2)])
        joined = np.concatenate([[False], breaks[starts[1:]] == breaks[starts[:-1]]])
        # No word has the hash 0, which stands for no word.
        return np.where(hashed == 0, np.uint64(1), hashed).view(np.int64), joined, starts, ends, low


def _segments(text: str):
    """The bytes of a text in pieces of about _CHUNK, cut where a piece of text ends anyway."""
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) <= _CHUNK:
        yield data
        return
    cuts = np.flatnonzero(np.isin(data, np.frombuffer(_SEPARATORS, np.uint8))) + 1
    start = 0
    while start < len(data):
        later = cuts[cuts > start]
        fitting = later[later <= start + _CHUNK]
        stop = int(fitting[-1]) if len(fitting) else int(later[0]) if len(later) else len(data)
        yield data[start:stop]
        start = stop


@dataclass
class Proposal:
    """What one round proposes, as bitmaps over hashes; None proposes everything."""

    words: np.ndarray | None
    pairs: np.ndarray | None

    def has_word(self, h: np.ndarray) -> np.ndarray:
        return _bit(self.words, h)

    def has_pair(self, h: np.ndarray) -> np.ndarray:
        return _bit(self.pairs, h)


def _bit(bitmap: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    if bitmap is None:
        return np.ones(len(h), bool)
    place = h & np.int64(len(bitmap) * 8 - 1)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _ngram_rows(hashes: list[np.ndarray], counts: np.ndarray):
    """Counts as batches of a bounded number of rows."""
    for start in range(0, len(counts), _ROWS_AT_ONCE):
        part = slice(start, start + _ROWS_AT_ONCE)
        n = len(counts[part])
        columns = [h[part] for h in hashes] + [np.zeros(n, np.int64)] * (3 - len(hashes)) + [counts[part].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*_NGRAM, "n"])


def _count_words(parts):
    """Counts of the words of one load, with their texts."""
    hashed = np.concatenate([p[0] for p in parts])
    known, first, counts = np.unique(hashed, return_index=True, return_counts=True)
    ends = np.cumsum([len(p[0]) for p in parts])
    part_of = np.searchsorted(ends, first, side="right")
    for start in range(0, len(known), _ROWS_AT_ONCE):
        langs, texts = [], []
        for place, k in zip(first[start : start + _ROWS_AT_ONCE].tolist(), part_of[start : start + _ROWS_AT_ONCE].tolist()):
            own, _, starts, stops, low, lang = parts[k]
            at = place - (int(ends[k]) - len(own))
            langs.append(lang)
            texts.append(low[starts[at] : stops[at]].tobytes().decode())
        part = slice(start, start + _ROWS_AT_ONCE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(texts, pa.string()), pa.array(known[part]), pa.array(counts[part].astype(np.int64))],
            names=[*_WORD, "n"],
        )


def _count_ngrams(parts, rounds: list[Proposal]):
    """Counts of the pairs and triples of one load that the last of ``rounds`` adds."""
    hashed, joined = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    known, own = np.unique(hashed, return_inverse=True)
    now, earlier = rounds[-1], rounds[:-1]

    def left_over(test):
        """Inside the last round's proposals, and counted by no round before."""
        keep = test(now)
        for proposal in earlier:
            keep &= ~test(proposal)
        return keep

    size = len(known)
    follows = np.flatnonzero(joined[1:])  # place of the left word of each pair
    pairs, pair_of, counts = np.unique(own[follows] * size + own[follows + 1], return_inverse=True, return_counts=True)
    left, right = known[pairs // size], known[pairs % size]
    keep = left_over(lambda p: p.has_word(left) & p.has_word(right))
    if keep.any():
        yield from _ngram_rows([left[keep], right[keep]], counts[keep])
    hashed_pairs = pair_hash(left, right)
    in_a_row = np.flatnonzero(np.diff(follows) == 1) if len(follows) else follows
    # Most pairs are in no proposal, so triples are looked for only around pairs that are.
    inside = now.has_pair(hashed_pairs)
    in_a_row = in_a_row[inside[pair_of[in_a_row]] & inside[pair_of[in_a_row + 1]]]
    triples, counts = np.unique(pair_of[in_a_row] * size + own[follows[in_a_row] + 2], return_counts=True)
    first_pair, last = triples // size, known[triples % size]
    middle = right[first_pair]
    keep = left_over(lambda p: p.has_pair(hashed_pairs[first_pair]) & p.has_pair(pair_hash(middle, last)))
    if keep.any():
        yield from _ngram_rows([left[first_pair][keep], middle[keep], last[keep]], counts[keep])


def _lang_salt(lang: str, words: Words) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode(), seed=words.salt & 0xFFFFFFFF)


def _counted(batches, rounds: list[Proposal] | None, seed: int):
    """Counts of words without ``rounds``, of pairs and triples with them."""
    words = Words(seed)

    def count(parts):
        return _count_words(parts) if rounds is None else _count_ngrams(parts, rounds)

    parts, held = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, _TEXTS_AT_ONCE):
            some = batch.slice(start, _TEXTS_AT_ONCE)
            for text, lang in zip(some.column("text").to_pylist(), some.column("lang").to_pylist()):
                salt = _lang_salt(lang, words)
                for data in _segments(text):
                    found = words.of(data, salt)
                    if len(found[0]):
                        # Texts are needed only where words are counted by them.
                        parts.append((*found, lang) if rounds is None else found[:2])
                        held += len(found[0])
                    if held >= _WORDS_AT_ONCE:
                        yield from count(parts)
                        parts, held = [], 0
    if parts:
        yield from count(parts)


def _count_all_words(docs: DataFrame, seed: int) -> DataFrame:
    parts = docs.select("text", "lang").mapInArrow(lambda batches: _counted(batches, None, seed), _WORD_COUNTED)
    return parts.groupBy(*_WORD).agg(F.sum("n").alias("n"))


def _count_inside(docs: DataFrame, rounds: list[Proposal], seed: int) -> DataFrame:
    """Counts over all of ``docs`` of the pairs and triples that the last of ``rounds`` adds."""
    held = docs.sparkSession.sparkContext.broadcast(rounds)  # bitmaps of at most MOST_BITS, two a round, three rounds
    parts = docs.select("text", "lang").mapInArrow(lambda batches: _counted(batches, held.value, seed), _NGRAM_COUNTED)
    return parts.groupBy(*_NGRAM).agg(F.sum("n").alias("n"))


def _bitmap(members: DataFrame, hashed: str) -> np.ndarray:
    """The members' hashes as a bitmap of BITS_EACH bits each, within the limits."""
    count, bits = members.count(), LEAST_BITS
    while bits < min(MOST_BITS, BITS_EACH * count):
        bits *= 2
    place = f"pmod({hashed}, {bits}L) + 1"
    rows = members.groupBy(F.expr(f"bitmap_bucket_number({place})").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({place}))").alias("bits")
    ).toArrow()
    bitmap = np.zeros(bits // 8, np.uint8)
    for bucket, part in zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()):
        own = np.frombuffer(part, np.uint8)[: len(bitmap)]
        bitmap[(bucket - 1) * 4096 : (bucket - 1) * 4096 + len(own)] = own
    return bitmap


def frequent(docs: DataFrame, least: int = LEAST, sample_bytes: int = SAMPLE_BYTES, seed: int = 1):
    """(words, ngrams) of ``docs`` (text, lang), exact: words (lang, word, h1, n) all of them, ngrams (h1, h2, h3, n >= least) with h3 = 0 for pairs."""
    while True:
        total = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
        share = min(1.0, sample_bytes / total) if total else 1.0
        drawn = F.pmod(F.xxhash64(F.lit(seed), "text", "lang"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
        lowered = max(2, int(LOWERED * least * share))
        sample = docs.where(drawn)
        proposed = save(_count_all_words(sample, seed).where(F.col("n") >= lowered), "phrases-sample-words")
        pairs = save(_count_inside(sample, [Proposal(None, None)], seed).where(f"h3 = 0 and n >= {lowered}"), "phrases-sample-pairs")
        rounds = [Proposal(_bitmap(proposed, "h1"), _bitmap(pairs, _PAIR_HASH))]
        words = save(_count_all_words(docs, seed), "phrases-words")
        if words.groupBy("h1").count().where("count > 1").isEmpty():
            break
        seed += 1
    often = words.where(F.col("n") >= least)
    ngrams = save(_count_inside(docs, rounds, seed).where(f"n >= {least}"), "phrases-counted")
    known = None
    while True:
        pairs = ngrams.where("h3 = 0")
        number = pairs.count()
        # A triple is counted when one round proposes both of its pairs, a pair when one proposes both words.
        if number == known or (known is None and _covered(rounds[0], often, pairs)):
            return words, ngrams
        known = number
        rounds.append(Proposal(_bitmap(often, "h1"), _bitmap(pairs, _PAIR_HASH)))
        ngrams = ngrams.unionByName(save(_count_inside(docs, rounds, seed).where(f"n >= {least}"), "phrases-further"))


def _covered(proposal: Proposal, often: DataFrame, pairs: DataFrame) -> bool:
    """Are all frequent words and pairs among those proposed?"""
    held = often.sparkSession.sparkContext.broadcast(proposal)

    def outside(batches):
        for batch in batches:
            k, h1, h2 = (batch.column(c).to_numpy() for c in ("k", "h1", "h2"))
            inside = np.where(k == 1, held.value.has_word(h1), held.value.has_pair(pair_hash(h1, h2)))
            yield batch.filter(pa.array(~inside))

    both = often.select(F.lit(1).alias("k"), "h1", F.lit(0).cast("bigint").alias("h2")).unionByName(
        pairs.select(F.lit(2).alias("k"), "h1", "h2")
    )
    return both.mapInArrow(outside, "k int, h1 bigint, h2 bigint").isEmpty()


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, covered: tuple[int, int] = COVERED,
    sample_bytes: int = SAMPLE_BYTES, lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """The best phrases of two or three words per language: lang, rank, phrase, a, l, r, n, score.

    A text is cut into pieces at ``.,;:!?`` and line ends, a piece into words at spaces and tabs, A-Z in lower
    case. ``a`` is how often the phrase occurs, ``l`` and ``r`` how often the two parts at its weakest cut do,
    ``n`` the words of the language, ``score`` floor(1000000 a a / (l r)). A phrase is left out if a longer
    one that holds it occurs in ``covered`` of its places. Ties go to the more frequent phrase, then
    to the first in byte order. Null texts are empty, a null language is ``und``; rows that repeat count
    again; texts of any length are read whole; an empty table gives an empty result; other columns of
    ``docs``, whatever their names, are not looked at.
    """
    rows = docs.select(
        F.coalesce(docs[text_col], F.lit("")).alias("text"), F.coalesce(docs[lang_col], F.lit("und")).alias("lang")
    )
    words, ngrams = frequent(rows, least, sample_bytes)
    often = words.where(F.col("n") >= least)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    pairs, triples = (ngrams.where(f"h3 {sign} 0").withColumnRenamed("n", "a") for sign in ("=", "<>"))
    within = triples.select("a", F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("p"))
    within = within.groupBy("p.h1", "p.h2").agg(F.max("a").alias("longer"))

    def part(name, *keys):
        """Counts of words, or of pairs, under the given key columns."""
        source = often if len(keys) == 1 else pairs.withColumnRenamed("a", "n")
        return source.select(*[F.col(f"h{k + 1}").alias(key) for k, key in enumerate(keys)], F.col("n").alias(name))

    def score(l_, r_):
        return F.expr(
            f"CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) "
            f"div (CAST({l_} AS DECIMAL(15,0)) * CAST({r_} AS DECIMAL(15,0)))"
        )

    two = pairs.join(within, ["h1", "h2"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * covered[1] < F.col("a") * covered[0])
    ).drop("longer").join(part("l", "h1"), "h1").join(part("r", "h2"), "h2").withColumn("score", score("l", "r"))
    three = (
        triples.join(part("l1", "h1"), "h1").join(part("r2", "h3"), "h3")
        .join(part("r1", "h2", "h3"), ["h2", "h3"]).join(part("l2", "h1", "h2"), ["h1", "h2"])
        .withColumns({"s1": score("l1", "r1"), "s2": score("l2", "r2")})
    )
    first = F.col("s1") <= F.col("s2")
    three = three.withColumns(
        {"l": F.when(first, F.col("l1")).otherwise(F.col("l2")), "r": F.when(first, F.col("r1")).otherwise(F.col("r2")),
         "score": F.least("s1", "s2")}
    )
    columns = ["h1", "h2", "h3", "a", "l", "r", "score"]
    found = two.select(*columns).unionByName(three.select(*columns))
    # The best of each language by score alone come first, with all ties at the last place; texts are joined to those.
    by_hash = often.select("lang", "h1")
    scored = found.join(by_hash, "h1")
    cut = F.rank().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc()))
    best = scored.withColumn("place", cut).where(F.col("place") <= top).drop("place")
    for k in (1, 2, 3):
        text = often.select(F.col("h1").alias(f"h{k}"), F.col("word").alias(f"w{k}"))
        best = best.join(text, f"h{k}", "left")
    phrase = F.concat_ws(" ", "w1", "w2", "w3")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
