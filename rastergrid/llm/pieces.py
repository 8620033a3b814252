"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is turned into symbols, and an agenda holds the adjacent pairs that make a piece, best score
first and leftmost first among equals. Pieces never reach over a place where the two characters beside it
stand together in no piece, so a text is cut there and its parts are encoded for themselves; parts seen
before come from a cache of bounded size. In every Arrow batch all new parts, joined by line ends over which no
piece reaches, and one whole text of each group of texts are checked against the library.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import portions

SPACE = "▁"
# Parts that each of the two generations of the cache may hold, about 200 bytes each.
_CACHE_PARTS = 200_000
_CHARS_AT_ONCE = 1 << 20
# Characters of parts that are merged together, and that the library checks as one text.
_MERGE_CHARS, _CHECK_CHARS = 1 << 16, 1 << 11
# Longer parts have an agenda of their own; a round over all parts for each of their merges would be quadratic.
_SHORT_PART = 64
# Places of order, place in the part and piece in an entry of the agenda.
_ORDER_AT, _PLACE_AT = 52, 20
_PLACE_MASK, _SYMBOL_MASK = (1 << 32) - 1, (1 << 20) - 1
_SLOT_BITS = 20
_RESULTS = ["n_tokens", "ids_sha256", "decoded_sha256"]
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _slot_of(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


class PieceCoder:
    """Encoder and decoder of one vocabulary file (bytes): identity normalizer, byte fallback, dummy prefix."""

    def __init__(self, model: bytes, check: bool = True):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        normal = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or normal.precompiled_charsmap or normal.remove_extra_whitespaces:
            raise ValueError("a merge-type vocabulary with the identity normalizer is needed")
        if not spec.trainer_spec.byte_fallback or any(p.type in (_USER, _UNUSED) for p in spec.pieces):
            raise ValueError("a vocabulary with byte fallback and without user pieces is needed")
        self.prefix = " " if normal.add_dummy_prefix else ""
        self.pieces = [p.piece for p in spec.pieces]
        self.score = {p.piece: p.score for p in spec.pieces if p.type == _NORMAL}
        self.ids = {p.piece: k for k, p in enumerate(spec.pieces) if p.type == _NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): k for k, p in enumerate(spec.pieces) if p.type == _BYTE}
        self.raw = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for byte, k in self.byte_ids.items():
            self.raw[k] = bytes([byte])
        self.byte_id = np.array([self.byte_ids.get(b, -1) for b in range(256)], np.int32)
        self.decimals = [str(k) for k in range(len(self.pieces))]
        self._number_symbols()
        beside = {piece[k : k + 2] for piece in self.score for k in range(len(piece) - 1)}
        # Cut before a space mark that follows anything else, and around line ends, where no piece joins them.
        joined = {pair for pair in beside if pair[1] == SPACE and pair[0] != SPACE}
        if joined or any("\n" in pair for pair in beside):
            raise ValueError("the vocabulary has pieces over spaces or line ends")
        if SPACE not in self.ids:
            raise ValueError("the vocabulary has no piece for a space")
        self.parts = re.compile("\n| +[^ \n]*|[^ \n]+")
        # Ids of parts, as the bytes of 32-bit numbers.
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.line = self._merge_long("\n")
        self.library = None
        if check:
            self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
            spec.normalizer_spec.add_dummy_prefix = False
            self.bare = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())

    def _number_symbols(self) -> None:
        """Numbers for characters and pieces, and what each adjacent pair of numbers makes: (order of score, piece)."""
        names = sorted({c for piece in self.score for c in piece} | set(self.score))
        self.symbol = {name: k for k, name in enumerate(names)}
        if SPACE in self.symbol:
            self.symbol[" "] = self.symbol[SPACE]  # parts are kept with plain spaces
        self.none = len(names)  # a character of no piece, or a place that was merged into its left one
        self.width = self.none + 1
        order = {score: k for k, score in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.pairs: dict[int, int] = {}
        for piece, score in self.score.items():
            made = order[score] << _ORDER_AT | self.symbol[piece]
            for cut in range(1, len(piece)):
                left, right = self.symbol.get(piece[:cut]), self.symbol.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.width + right] = made
        self.vocabulary = np.array([self.ids.get(name, -1) for name in names] + [-1], np.int32)
        # The same as arrays: numbers of characters by code point, and the pairs by key.
        self.of_char = np.full(0x110000, self.none, np.int32)
        for name, number in self.symbol.items():
            if len(name) == 1:
                self.of_char[ord(name)] = number
        self.pair_keys = np.array(sorted(self.pairs), np.int64)
        made = [self.pairs[key] for key in self.pair_keys.tolist()]
        self.pair_orders = np.array([m >> _ORDER_AT for m in made], np.int64)
        self.pair_pieces = np.array([m & _SYMBOL_MASK for m in made], np.int32)
        # A hash table over the keys: the place of a key is at its slot or behind it, before an empty slot.
        self.slots = np.full(1 << _SLOT_BITS, -1, np.int32)
        wanting, slot = np.arange(len(self.pair_keys), dtype=np.int32), _slot_of(self.pair_keys)
        while len(wanting):
            free = self.slots[slot[wanting]] < 0
            self.slots[slot[wanting[free]]] = wanting[free]
            wanting = wanting[self.slots[slot[wanting]] != wanting]
            slot[wanting] = (slot[wanting] + 1) & len(self.slots) - 1

    def _merge_long(self, part: str) -> list[int]:
        """One part with an agenda of its own, in time n log n."""
        symbol, none, pairs, width = self.symbol, self.none, self.pairs, self.width
        at = [symbol.get(c, none) for c in part]
        size = len(at)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        # One number an entry: order of score, then place, then the piece that the pair makes.
        agenda = []
        for k in range(size - 1):
            made = pairs.get(at[k] * width + at[k + 1])
            if made is not None:
                agenda.append(made + (k << _PLACE_AT))
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry >> _PLACE_AT & _PLACE_MASK
            right = after[left]
            # Stale when either side was merged since.
            if right >= size or pairs.get(at[left] * width + at[right]) != entry - (left << _PLACE_AT):
                continue
            merged = entry & _SYMBOL_MASK
            at[left], at[right] = merged, none
            beyond = after[left] = after[right]
            if beyond < size:
                before[beyond] = left
                made = pairs.get(merged * width + at[beyond])
                if made is not None:
                    heapq.heappush(agenda, made + (left << _PLACE_AT))
            ahead = before[left]
            if ahead >= 0:
                made = pairs.get(at[ahead] * width + merged)
                if made is not None:
                    heapq.heappush(agenda, made + (ahead << _PLACE_AT))
        found: list[int] = []
        vocabulary, place = self.vocabulary, 0
        while place < size:
            known = int(vocabulary[at[place]])
            if known >= 0:
                found.append(known)
            else:
                found.extend(self.byte_ids[b] for b in part[place].encode())
            place = after[place]
        return found

    def _pair_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place in the pair table of what two neighbours make, -1 if nothing."""
        key = left.astype(np.int64) * self.width + right
        slot = _slot_of(key)
        place = self.slots[slot]
        other = np.flatnonzero((place >= 0) & (self.pair_keys[place] != key))
        while len(other):
            slot[other] = (slot[other] + 1) & len(self.slots) - 1
            place[other] = found = self.slots[slot[other]]
            other = other[(found >= 0) & (self.pair_keys[found] != key[other])]
        return place

    def _merge_short(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many parts at once: every round takes the head of each part's agenda, until all agendas are empty.

        Returns the ids of all parts in a row and where those of each part begin and end.
        """
        chars = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.arange(len(parts), dtype=np.int32), np.fromiter(map(len, parts), np.int64, len(parts)))
        at = self.of_char[chars]
        pair = np.full(len(at), -1, np.int32)
        pair[:-1] = np.where(owner[:-1] == owner[1:], self._pair_of(at[:-1], at[1:]), -1)
        while True:
            places = np.flatnonzero(pair >= 0)
            if not len(places):
                break
            entries = self.pair_orders[pair[places]] << 32 | places
            owners = owner[places]
            heads = np.minimum.reduceat(entries, np.flatnonzero(np.diff(owners, prepend=-1))) & 0xFFFFFFFF
            at[heads] = self.pair_pieces[pair[heads]]
            left = np.ones(len(at), bool)
            left[heads + 1] = False
            at, owner, pair, chars = at[left], owner[left], pair[left], chars[left]
            # Each part lost one place before the heads of the parts behind it.
            heads -= np.arange(len(heads))
            changed = np.concatenate([heads, heads[heads > 0] - 1])
            changed = changed[changed < len(at) - 1]
            inside = owner[changed] == owner[changed + 1]
            pair[changed] = np.where(inside, self._pair_of(at[changed], at[changed + 1]), -1)
            if owner[heads[-1]] == owner[-1] and heads[-1] == len(at) - 1:
                pair[-1] = -1
        ids = self.vocabulary[at]
        unknown = chars[ids < 0]
        if len(unknown):
            # A character that is no piece becomes the pieces of its bytes.
            times = np.ones(len(ids), np.int64)
            times[ids < 0] = 1 + (unknown >= 0x80) + (unknown >= 0x800) + (unknown >= 0x10000)
            ids, owner = np.repeat(ids, times), np.repeat(owner, times)
            ids[ids < 0] = self.byte_id[np.frombuffer(unknown.tobytes().decode("utf-32-le").encode(), np.uint8)]
        return ids, np.searchsorted(owner, np.arange(len(parts) + 1))

    def _merged(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, none of them long; they go together up to some size."""
        found = []
        for group in _groups(parts, _MERGE_CHARS):
            ids, ends = self._merge_short(group)
            held, ends = ids.tobytes(), (4 * ends).tolist()
            found.extend([held[a:b] for a, b in zip(ends, ends[1:])])
        return found

    def learn(self, parts: set[str]) -> None:
        """Encode the parts that no cache holds, check them against the library and remember them."""
        new = parts.difference(self.cache)
        if len(self.cache) + len(new) > _CACHE_PARTS:
            # Two generations: the young one becomes the old one, and parts that are met again move back.
            self.old, self.cache, new = self.cache, {}, parts
        unseen = new.difference(self.old)
        again = new - unseen
        self.cache.update(zip(again, map(self.old.__getitem__, again)))
        short = [p for p in unseen if len(p) <= _SHORT_PART]
        long = [p for p in unseen if len(p) > _SHORT_PART]
        found = self._merged(short) + [np.array(self._merge_long(p), np.int32).tobytes() for p in long]
        self.verify(short + long, found)
        self.cache.update(zip(short + long, found))

    def forget(self) -> None:
        """Empty the cache."""
        self.cache, self.old = {}, {}

    def _plain(self, ids: list[int]) -> str:
        """The text of ids, without what holds for the start of a text only."""
        return b"".join(map(self.raw.__getitem__, ids)).decode(errors="replace")

    def encode(self, text: str) -> list[int]:
        """The ids, without begin or end; none for an empty text."""
        _, joined, _ = self.digest(text)
        return list(map(int, joined.split(","))) if joined else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts before a text goes."""
        text = self._plain(ids)
        return text[1:] if self.prefix and text.startswith(" ") else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the decimal ids joined by commas, and the decoded text."""
        return next(self.digests([text]))

    def digests(self, texts: list[str]):
        """``digest`` of every text, in order; texts are worked on together up to some size."""
        for group in _groups(texts, _CHARS_AT_ONCE):
            # An empty text has no prefix either.
            parts = [self.parts.findall(self.prefix + t.replace(SPACE, " ")) if t else [] for t in group]
            self.learn(set().union(*parts))
            cache, decimals = self.cache, self.decimals
            for k, own in enumerate(parts):
                ids = np.frombuffer(b"".join(map(cache.__getitem__, own)), np.int32).tolist()
                result = len(ids), ",".join(map(decimals.__getitem__, ids)), self.decode(ids)
                if k == 0:
                    self.verify_whole(group[0], result)
                yield result

    def verify(self, parts: list[str], found: list[bytes]) -> None:
        """Compare ids and decoded texts of parts with the library's; raises where they differ.

        Parts are checked together with a line end between them, which is an id of its own and in no other part.
        """
        if self.library is None:
            return
        line = np.array(self.line, np.int32).tobytes()
        start = 0
        for group in _groups(parts, _CHECK_CHARS):
            text = "\n".join([*group, ""])
            own = np.frombuffer(line.join([*found[start : start + len(group)], b""]), np.int32).tolist()
            if self.bare.encode(text) != own or self.bare.decode(own) != text or self._plain(own) != text:
                raise ValueError(f"ids differ from the library's among {group[:8]!r}")
            start += len(group)

    def verify_whole(self, text: str, result: tuple[int, str, str]) -> None:
        """Compare a whole text, with its cuts and its prefix, with the library's; raises where it differs."""
        if self.library is None:
            return
        ids = self.library.encode(text)
        if result != (len(ids), ",".join([self.decimals[k] for k in ids]), self.library.decode(ids)):
            raise ValueError(f"ids differ from the library's for the text {text[:80]!r}")


def _groups(texts: list[str], size: int):
    """Neighbouring texts of together about so many characters; no group is more than one text longer."""
    places = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))) // size
    ends = [*(np.flatnonzero(np.diff(places)) + 1).tolist(), len(texts)] if texts else []
    for start, stop in zip([0, *ends], ends):
        yield texts[start:stop]


_coders: dict[tuple[str, bool], PieceCoder] = {}


def coder_of(model: bytes, check: bool = True) -> PieceCoder:
    """The worker process's coder of a vocabulary: its tables outlive a task."""
    key = hashlib.sha256(model).hexdigest(), check
    if key not in _coders:
        _coders[key] = PieceCoder(model, check)
    return _coders[key]


def read_model(path: str) -> bytes:
    """A vocabulary file, installed beside the driver; tasks get its bytes."""
    with open(path, "rb") as file:
        return file.read()


def encode_documents(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, with n_tokens, ids_sha256 and decoded_sha256 of each whole text.

    Null and empty texts have no ids and an empty decoded text; texts of any length are encoded whole;
    repeated rows come out as often as they go in; an empty table gives an empty result. Columns of
    ``docs`` named like one of the three results give way to it. ``model`` is the vocabulary's file.
    """
    keep = [c for c in docs.columns if c != text_col and c not in _RESULTS]
    docs = docs.select(*[F.col(f"`{c}`") for c in [*keep, text_col]])
    schema = T.StructType(
        [*[docs.schema[c] for c in keep], T.StructField("n_tokens", T.LongType()),
         T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    )
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(lambda batches: _encoded(batches, held.value, keep, text_col), schema)


def _encoded(batches, model: bytes, keep: list[str], text_col: str):
    coder = coder_of(model)
    try:
        for batch in portions(batches):
            counts, ids, texts = [], [], []
            for number, joined, decoded in coder.digests([text or "" for text in batch.column(text_col).to_pylist()]):
                counts.append(number)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                texts.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                names=[*keep, *_RESULTS],
            )
    finally:
        # The worker process may go on with other stages, which need the memory.
        coder.forget()
