"""Main text of web pages by a maximum-scoring run of words and tags.

A page is a row of tags and words. Words score by what is around them: elements with a meaning, class words,
how long their block is, how much of it is links, whether it ends like a sentence and whether it stands in one of several
containers of one kind, as comments do. Scores are positive in article text and negative in menus, adverts and the
like; tags score negative. The weights come from a logistic regression over labelled pages. One linear scan finds the run
with the greatest sum, and the blocks of that run, without the pieces that score negative for themselves, are the text.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .labelled_pages import WANTED, layouts

# Pages of the table to learn from, at most: those with one article element and the least hash of their id.
TRAIN_PAGES = 400
# Bytes of those pages together, at most, besides the first.
TRAIN_BYTES = 16 << 20
# Pages with layouts drawn by rule that are learned from besides.
LAYOUTS = 300
# A short piece counts as much as one of so many words.
_LEAST_WEIGHT = 8
TAG_COST = 0.25
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|template|noscript|svg|textarea|select|title|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
# Fixed lists of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
# Elements that say nothing about what they hold: their names are no features.
NEUTRAL = frozenset("html body div span b i em strong u small font center tbody thead tr td th table br p".split())
# Containers that are counted by name and class.
_CONTAINERS = frozenset("div li section article dd tr blockquote td".split())
# An opening tag of these ends an open paragraph.
ENDS_P = BLOCK - {"caption", "legend", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "body", "html", "head"}
SAME_ENDS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}


def pieces(html: str):
    """(block number, text, features, tags before, place) for each run of text, in page order.

    Pieces are in one place if the elements that hold their blocks, such as two paragraphs, stand in one element and
    their other features but those of length are the same.
    """
    runs = list(_runs(html))
    kinds: dict[tuple, int] = {}
    for *_, opened in runs:
        for kind in opened:
            kinds[kind] = kinds.get(kind, 0) + 1
    words: dict[int, list] = {}
    held: dict[int, int] = {}
    for block, text, around, _, containers, _, _ in runs:
        own = words.setdefault(block, [0, 0, ""])
        found = text.split()
        own[0] += len(found)
        own[1] += len(found) if "in:a" in around else 0
        own[2] = found[-1] if found else own[2]
        for _, number in containers:
            held[number] = held.get(number, 0) + len(found)
    everything = sum(own[0] for own in words.values())
    for block, text, around, tags, containers, parent, _ in runs:
        total, linked, last = words[block]
        own = {f"words:{min(total.bit_length(), 6)}", f"links:{0 if not linked else 1 if 2 * linked < total else 2}"}
        if last[-1:] in _ENDS:
            own.add("sentence")
        if any(kinds.get(kind, 0) > 1 for kind, _ in containers):
            own.add("repeated")
        # The share of the page's words in the innermost container that has a class: that of a notice is small.
        own.add(f"box:{min(everything // max(held[containers[-1][1]], 1), 20).bit_length() if containers else ''}")
        if not containers and not linked:
            # Straight in an article, or on the page.
            own.add(f"bare:{next((n for n in ('article', 'main') if f'in:{n}' in around), '')}")
        features = around | own
        place = frozenset(f for f in features if not f.startswith("words:") and f != "sentence")
        yield block, text, features, tags, (parent, place)


def _runs(html: str):
    """The runs of text with the features of their elements, their containers, and the containers opened before them."""
    stack: list[tuple[str, tuple[str, ...], tuple | None, int]] = []
    block = tags = at = number = 0
    opened: list[tuple] = []

    def features():
        own = {f"at:{next((n for n, *_ in reversed(stack) if n in BLOCK and n != 'div'), '')}"}
        for name, marks, *_ in stack:
            if name not in NEUTRAL:
                own.add(f"in:{name}")
            own.update(marks)
        return frozenset(own)

    def run(text, tags):
        before = tuple(opened)
        opened.clear()
        inside = tuple(container for _, _, container, _ in stack if container)
        blocks = [k for k, (name, *_) in enumerate(stack) if name in BLOCK]
        parent = stack[blocks[-1] - 1][3] if blocks and blocks[-1] else 0
        return block, text, features(), tags, inside, parent, before

    for found in _TAG.finditer(html):
        if found.start() > at:
            yield run(unescape(html[at : found.start()]), tags)
            tags = 0
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            # Comments and elements without readable text.
            if found["raw"]:
                tags += 1
                if found["raw"].lower() in ("title", "select", "textarea", "iframe"):
                    block += 1
            continue
        tags += 1
        if name in BLOCK:
            block += 1
        if found["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in ENDS_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK:
                    break
        if name in SAME_ENDS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if stack[k][0] in SAME_ENDS[name]:
                    break
        if name not in VOID and not found["attrs"].rstrip().endswith("/"):
            marks = tuple(
                f"mark:{word.lower()}" for m in _MARKS.findall(found["attrs"]) for word in _WORDS.findall("".join(m))
            )
            own = tuple(m for m in marks if m != _WANTED_MARK)
            container = None
            number += 1
            if own and name in _CONTAINERS:
                container = ((name, own), number)
                opened.append((name, own))
            stack.append((name, marks, container, number))
        elif name == "br":
            yield run(" ", 0)
    if at < len(html):
        yield run(unescape(html[at:]), tags)


_ENDS = frozenset(".!?:;\"'”’…)")
_WANTED_MARK = f"mark:{WANTED}"
# Inside an article these may not be text: they say nothing when labels are taken from article elements.
_UNSURE = frozenset({"in:aside", "in:nav", "in:form", "in:footer", "in:button", "repeated", "links:2"})


class Weights:
    """Score of a word by the features around it."""

    def __init__(self, bias: float, by_feature: dict[str, float]):
        self.bias, self.by_feature = bias, by_feature
        self.known: dict[frozenset, float] = {}

    def of(self, features: frozenset) -> float:
        if features not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[features] = self.bias + sum(self.by_feature.get(f, 0.0) for f in features)
        return self.known[features]


def fit(examples: list[tuple[frozenset, int, float]], steps: int = 400) -> Weights:
    """Logistic regression over (features, label, weight of the example)."""
    names = sorted({f for features, _, _ in examples for f in features})
    place = {f: k for k, f in enumerate(names)}
    merged: dict[tuple[frozenset, int], float] = {}
    for features, label, weight in examples:
        merged[features, label] = merged.get((features, label), 0.0) + weight
    rows = list(merged)
    x = np.zeros((len(rows), len(names) + 1))
    x[:, -1] = 1
    for k, (features, _) in enumerate(rows):
        x[k, [place[f] for f in features]] = 1
    y = np.array([label for _, label in rows], float)
    weight = np.sqrt(np.array([merged[r] for r in rows]))
    weight /= weight.sum()
    values, first, second = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, steps + 1):
        error = weight * (1 / (1 + np.exp(-np.clip(x @ values, -35, 35))) - y)
        gradient = x.T @ error + 2e-5 * values
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        values -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Weights(float(values[-1]), dict(zip(names, values[:-1].tolist())))


def labelled(html: str, marked: bool) -> list[tuple[frozenset, int, float]]:
    """Examples from a page; article text is inside ``article`` or, where ``marked``, in elements marked so.

    Inside an article element, side columns, menus, forms and the like may not be text: they say nothing.
    """
    found = []
    for _, text, features, _, _ in pieces(html):
        words = len(text.split())
        if words:
            inside = _WANTED_MARK in features if marked else "in:article" in features
            if inside and not marked and features & _UNSURE:
                continue
            found.append((frozenset(f for f in features if f != _WANTED_MARK), int(inside), float(min(max(words, _LEAST_WEIGHT), 50))))
    return found


def train(pages: DataFrame, rows: int = TRAIN_PAGES, id_col: str = "page_id", bytes_held: int = TRAIN_BYTES) -> Weights:
    """Weights from pages drawn by rule and from pages with one article element, at most ``rows`` of ``bytes_held`` in all."""
    one = F.regexp_count("html", F.lit("(?i)<article[\\s>]")) == 1
    size = F.octet_length("html")
    chosen = pages.where(F.col("html").isNotNull() & one).orderBy(F.xxhash64(id_col), id_col).limit(rows).select("html", size.alias("size"))
    order = Window.orderBy(F.xxhash64("html"), "html").rowsBetween(Window.unboundedPreceding, -1)
    # The window is over the bounded sample only.
    kept = chosen.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    kept = kept.where((F.col("before") == 0) | (F.col("before") + F.col("size") <= bytes_held))
    return fit_pages(kept.select("html").toArrow().column("html").to_pylist(), list(layouts(LAYOUTS)))


def fit_pages(tabled: list[str], drawn: list[str]) -> Weights:
    """Weights from pages of a table, labelled by their article element, and from drawn ones; both sources count alike."""
    examples = [e for html in tabled for e in labelled(html, False)]
    own = [e for html in drawn for e in labelled(html, True)]
    share = sum(w for _, _, w in examples) / max(sum(w for _, _, w in own), 1.0)
    return fit(examples + [(f, y, w * max(share, 1.0)) for f, y, w in own])


def best_slice(steps: list[tuple[float, float]]) -> tuple[int, int]:
    """The run of (gain, cost between it and the one before) with the greatest sum above 0, first and shortest among equals.

    A run pays the costs between its members, not the one before its first.
    """
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for k, (gain, cost) in enumerate(steps):
        if total - cost <= 0:
            total, start = 0.0, k
        else:
            total -= cost
        total += gain
        if total > best:
            best, found = total, (start, k + 1)
    return found


def main_text(html: str, weights: Weights) -> str:
    """The text of the best run: its blocks, white space as one space, joined by line ends."""
    runs = list(pieces(html))
    # Pieces in one place, such as the paragraphs of an article, share the mean score of their words, whatever their length.
    places: dict[tuple, list[float]] = {}
    for _, text, features, _, place in runs:
        own = places.setdefault(place, [0.0, 0.0])
        words = len(text.split())
        own[0] += weights.of(features) * words
        own[1] += words
    scores = [own[0] / own[1] if own[1] else 0.0 for own in (places[place] for *_, place in runs)]
    best_run = best_slice([(score * len(text.split()), tags * TAG_COST) for score, (_, text, _, tags, _) in zip(scores, runs)])
    blocks: dict[int, list[str]] = {}
    for k in range(*best_run):
        # White space alone has no score of its own.
        if scores[k] > 0 or not runs[k][1].strip():
            blocks.setdefault(runs[k][0], []).append(runs[k][1])
    return "\n".join(filter(None, (" ".join("".join(parts).split()) for parts in blocks.values())))


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url, text, n_chars of every page; a null or empty page, or one without an article, has no text.

    Pages that repeat are rows of their own. A page is scanned whole, however long.
    """
    plain = (weights.bias, weights.by_feature)

    def texts(batches):
        own = Weights(*plain)
        for batch in batches:
            found = [main_text(html or "", own) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(
        texts, "page_id bigint, url string, text string, n_chars bigint"
    )
