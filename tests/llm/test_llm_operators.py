"""The numbered operators on small tables, against brute force, round trips or held-out labels."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastergrid.llm import (
    chat, exact_dedup, fingerprints, html_text, labelled_pages, mixing, near_dedup, pieces, quality, sharding, shingles, toxicity,
)
from rastergrid.llm.common import components, plain, portions

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"


def table(spark, rows):
    """Documents with two columns whose names operators use themselves."""
    full = [(i, t, "en", s, len(t or ""), "x", "y") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def sample_words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd(llm_spark):
    long_text = " ".join(sample_words(20_000, 1))
    rows = [
        (1, "same text", "a"), (2, "same text", "b"), (3, None, None), (4, "", "a"), (5, long_text, "a"),
        (6, "x", "b"), (7, "same text", None), (8, "Größe 日本 🎉\x00\n ▁ ", "c"), (None, "no id", "c"),
        (9, "repeated", "c"), (9, "repeated", "c"),
    ]
    return rows, table(llm_spark, rows)


def test_exact_dedup(llm_spark, odd):
    rows, docs = odd
    got = exact_dedup.exact_dedup(plain(docs), {"size": F.length("text")}).collect()
    assert len(got) == len(rows)
    for row in got:
        same = [i for i, t, _ in rows if (t or "") in {u or "" for j, u, _ in rows if j == row.doc_id}]
        assert row.group_size == len(same)
        assert row.keep_id == max((i for i in same if i is not None), default=None)
    assert sum(r.kept for r in got) == len({t or "" for _, t, _ in rows})
    assert exact_dedup.exact_dedup(plain(docs.limit(0))).count() == 0


def test_exact_dedup_levels_agree(llm_spark):
    """Texts that share size or prefix only are told apart."""
    rows = [(k, ("p" * 300) + str(k % 7), "a") for k in range(40)]
    got = exact_dedup.exact_dedup(plain(table(llm_spark, rows))).where("kept").collect()
    assert sorted(r.doc_id for r in got) == [33, 34, 35, 36, 37, 38, 39]


def test_sharding(llm_spark, odd, tmp_path):
    _, docs = odd
    many = table(llm_spark, [(k, "t" * (k % 5), "s") for k in range(1000)]).unionByName(docs)
    sized = many.select("doc_id", "text", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"))
    got = sharding.shuffle_into_shards(sized, "doc_id", "size", bucket_bytes=500)
    first = [tuple(r) for r in got.orderBy("shard", "slot").collect()]
    again = sharding.shuffle_into_shards(sized.repartition(3), "doc_id", "size", bucket_bytes=500)
    assert first == [tuple(r) for r in again.orderBy("shard", "slot").collect()]
    counts = {}
    for *_, shard, slot in first:
        counts.setdefault(shard, []).append(slot)
    assert all(slots == list(range(len(slots))) for slots in counts.values())
    assert sorted(counts) == list(range(16))
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    ids = [r[0] for r in first if r[0] is not None]
    assert ids != sorted(ids)
    sharding.write_shards(got, str(tmp_path / "out"))
    assert llm_spark.read.parquet(str(tmp_path / "out")).count() == 1011
    assert sharding.shuffle_into_shards(sized.limit(0), "doc_id", "size").count() == 0


def test_fisher_yates():
    assert sorted(sharding.fisher_yates(100, 1)) == list(range(100))
    assert len(sharding.fisher_yates(0, 1)) == 0
    seen = {tuple(sharding.fisher_yates(3, k)) for k in range(200)}
    assert seen == set(itertools.permutations(range(3)))


def test_mixing(llm_spark, odd):
    _, docs = odd
    rows = [(100 + k, " ".join(["w"] * (k % 13)), f"s{k % 4}") for k in range(300)]
    every = table(llm_spark, rows).unionByName(docs)
    mixed = mixing.mix(every.select("doc_id", "source", "text"), block_rows=20)
    got = mixed.collect()
    assert len(got) == 311
    by_source = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        assert (len(r.positions) > 0) == (r.taken > 0)
        by_source.setdefault(r.source, []).append(r)
    for found in by_source.values():
        assert sum(r["size"] for r in found) == found[0].source_size
        assert sum(r.taken for r in found) == int(found[0].target)
        assert found[0].target <= 2 * found[0].source_size
    total = sum(r[0].target for r in by_source.values())
    assert total == pytest.approx(1.5 * sum(r["size"] for r in got))
    order = mixing.training_order(every, mixed)
    assert order.columns == every.columns
    assert order.count() == sum(len(r.positions) for r in got)
    assert mixing.mix(every.limit(0).select("doc_id", "source", "text")).count() == 0


def test_position_inverts_the_integral(llm_spark):
    schedule = ((0.0, 0.5), (0.5, 1.0), (1.0, 2.0))
    shares = [0.0, 0.1, 1 / 3, 0.5, 0.99]
    frame = llm_spark.createDataFrame([(s,) for s in shares], "s double")
    got = [r[0] for r in frame.select(mixing._position(F.col("s"), schedule)).collect()]
    grid = np.linspace(0, 1, 100_001)
    weight = np.interp(grid, [t for t, _ in schedule], [w for _, w in schedule])
    area = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
    assert got == pytest.approx(np.interp(shares, area / area[-1], grid).tolist(), abs=1e-4)


def test_mixing_by_demand_and_in_training_order(llm_spark):
    """What is taken up to a time is the integral of the schedule there, and rows come sorted by position range."""
    rows = [(k, " ".join(["w"] * (1 + k % 7)), f"s{k % 3}") for k in range(400)]
    mixed = mixing.mix(table(llm_spark, rows).select("doc_id", "source", "text"), block_rows=50)
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [element_at(positions" in plan and "Sort [element_at(positions" in plan
    firsts = [r.positions[0] if r.positions else 2.0 for r in mixed.collect()]
    assert firsts == sorted(firsts) and len(firsts) == 400
    half = mixing.mix(table(llm_spark, rows).select("doc_id", "source", "text"), block_rows=50, until=0.5).collect()
    grid = np.linspace(0, 1, 100_001)
    for k, schedule in enumerate(mixing.SCHEDULES):
        weight = np.interp(grid, [t for t, _ in schedule], [w for _, w in schedule])
        area = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
        assert mixing._reached(0.5, schedule) == pytest.approx(area[50_000] / area[-1], abs=1e-6) and mixing._reached(1.0, schedule) == 1.0
        of_source = [r for r in half if r.source == f"s{k}"]
        assert sum(r.taken for r in of_source) == int(of_source[0].target * mixing._reached(0.5, schedule))
        assert all(at <= 0.5 for r in of_source for at in r.positions)


def test_near_dedup_against_brute_force(llm_spark, odd):
    rng, rows = random.Random(3), []
    for family in range(6):
        base = sample_words(120, family)
        for copy in range(25):
            changed = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                changed[rng.randrange(len(changed))] = f"e{rng.randrange(10**9)}"
            rows.append((family * 100 + copy, " ".join(changed), "a"))
    rows += [(1000 + k, " ".join(sample_words(60, 900) + sample_words(20, 1000 + k)), "a") for k in range(30)]
    rows += [(2000, "One two THREE", "a"), (2001, "one two three", "b"), (2002, "  ", "a"), (2003, "\n", "b"), (2004, None, "c")]
    sets = {}
    for i, text, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            label[high] = low
    got = {r.doc_id: r for r in near_dedup.near_dedup(plain(table(llm_spark, rows))).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(s), root(i)) for i, s in sets.items()}
    assert all(r.kept == (i == r.component_id) for i, r in got.items())
    odd_rows = near_dedup.near_dedup(plain(odd[1])).collect()
    assert len(odd_rows) == 11
    assert {r.component_id for r in odd_rows if r.doc_id in (1, 2, 7)} == {1}
    assert near_dedup.near_dedup(plain(odd[1].limit(0))).count() == 0


def test_components(llm_spark):
    edges = [(k, k + 1) for k in range(20)] + [(50, 40), (40, 60), (7, 7)]
    got = dict(map(tuple, components(llm_spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(21)}, 40: 40, 50: 40, 60: 40}


def test_toxicity(llm_spark, odd):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(900):
        text = sample_words(40, k)
        toxic = k % 4 == 0
        if toxic:
            text[3:5] = rng.sample(["nasty", "vile", "rotten"], 2)
        rows.append((k, " ".join(text), "a"))
        labels.append((k, int(toxic)))
    docs = plain(table(llm_spark, rows))
    marked = llm_spark.createDataFrame(labels, "doc_id long, label int")
    model = toxicity.train(docs, marked.where("doc_id < 600"))
    assert 0 < len(model.places) < 2000
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    right = sum((got[k] >= 0.7) == bool(y) for k, y in labels[600:])
    assert right >= 290
    scored = toxicity.score(odd[1], model, "text", "__s").collect()
    assert len(scored) == 11 and all(0 <= r["__s"] <= 1 for r in scored)
    empty = toxicity.train(docs, marked.limit(0))
    assert len(empty.places) == 0
    assert toxicity.score(docs.limit(0), empty).count() == 0


def test_quality(llm_spark, odd):
    rows, labels = [], []
    for k in range(600):
        text = [f"v{random.Random(k * 100 + j).randrange(300)}" for j in range(60)]
        good = k % 3 > 0
        rows.append((k, " ".join(text if good else [w + "$$$" for w in text]), "a"))
        labels.append((k, int(good)))
    docs = plain(table(llm_spark, rows))
    marked = llm_spark.createDataFrame(labels, "doc_id long, label int")
    model = quality.train(docs, marked.where("doc_id < 400"))
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert sum((got[k] >= 0.3) == bool(y) for k, y in labels[400:]) >= 195
    assert all(0 <= r["__s"] <= 1 for r in quality.score(odd[1], model, "text", "__s").collect())
    assert quality.train(docs.limit(0), marked.limit(0)).temperature == 1.0


def test_context_vectors_against_brute_force(llm_spark):
    texts = ["a b c a", "b", "", "c c c $$ D E"]
    docs = llm_spark.createDataFrame([(t,) for t in texts], "text string")
    index, sums, tokens = quality.index_vectors(), {}, quality.Tokens()
    for text in texts:
        found = tokens.of(text)
        for k, bucket in enumerate(found):
            for j in range(max(0, k - 2), min(len(found), k + 3)):
                if j != k:
                    sums[bucket] = sums.get(bucket, 0) + index[found[j]].astype(int)
    got = quality.context_vectors(docs)
    for bucket, total in sums.items():
        assert got[bucket] == pytest.approx(total / max(np.linalg.norm(total), 1e-9), abs=1e-6)


def test_pieces_equal_the_library(llm_spark, odd):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows, docs = odd
    rng = random.Random(5)
    drawn = ["".join(rng.choices("ab the\n  é▁日🎉\x00\t<s>", k=rng.randrange(60))) for _ in range(300)]
    coder = pieces.PieceCoder(pieces.read_model(path))
    for text in drawn:
        ids = library.encode(text)
        assert coder.encode(text) == ids
        assert coder.decode(ids) == library.decode(ids)
    got = pieces.encode_documents(docs, pieces.read_model(path)).collect()
    assert len(got) == len(rows)
    expected = set()
    for i, text, _ in rows:
        ids = library.encode(text or "")
        expected.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                      hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == expected


def test_pieces_of_parts_checked_together(monkeypatch):
    """Many groups of parts and generations of the cache; nothing is held after a task, and a wrong id is noticed."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import pyarrow as pa
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.read_model(path)
    for name, size in (("_CACHE_PARTS", 40), ("_MERGE_CHARS", 50), ("_CHECK_CHARS", 30), ("_CHARS_AT_ONCE", 200)):
        monkeypatch.setattr(pieces, name, size)
    rng = random.Random(6)
    texts = ["".join(rng.choices(["the ", "of", " a", "▁", "\n", "日本", "🎉", "é", "ing", "x" * 70, "\t", "\x00", "7"], k=rng.randrange(40))) for _ in range(1500)]
    texts += [None, "", " ", "\n", "▁", " " * 90, "ab" * 500]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    got = list(pieces._encoded([batch], model, ["doc_id"], "text"))
    rows = [row for part in got for row in part.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(len(texts))) and len(got) > 1
    for row, text in zip(rows, texts):
        ids = library.encode(text or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert not pieces.coder_of(model).cache and not pieces.coder_of(model).old
    coder = pieces.PieceCoder(model)
    right = coder._merged
    monkeypatch.setattr(coder, "_merged", lambda parts: [ids[::-1] if p == " verywrong" else ids for p, ids in zip(parts, right(parts))])
    with pytest.raises(ValueError, match="differ"):
        coder.encode("that is verywrong here")


def test_python_sees_few_rows_at_a_time():
    """Signatures, sets and scores of a batch come in portions, with the same rows in the same order."""
    import pyarrow as pa

    texts = [f"one two three four five six {k % 700}" for k in range(2500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2500)), "text": texts})
    signed, sets = list(near_dedup._signatures([batch], 8, 1)), list(near_dedup._sets([batch]))
    for found in (signed, sets):
        assert max(b.num_rows for b in found) <= 1024
        assert [i for b in found for i in b.column("doc_id").to_pylist()] == list(range(2500))
        keys = [k for b in found for k in b.column("set_key").to_pylist()]
        assert keys[:700] == keys[700:1400] and len(set(keys)) == 700
    assert [b.num_rows for b in portions([batch.slice(0, 0)])] == []


def test_html(llm_spark):
    body = "<p>Some words &amp; more of them, in\n a  row.<p>Second <b>part</b> of it<br>goes on &lt;here&gt;."
    html = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>one</a></li></ul></nav>"
        "<div class='ad'>Buy now</div><article><h1>The head</h1>" + body
        + "<aside>Elsewhere</aside><div class='comments'><p>I agree</p></div></article><footer>&copy; me</footer></body></html>"
    )
    want = "The head\nSome words & more of them, in a row.\nSecond part of it goes on <here>."
    rows = [(1, "u", html), (2, "v", None), (3, "w", ""), (4, "x", "<nav><a>only a menu</a></nav>"), (1, "u", html), (5, "y", "<p <\"'")]
    pages = llm_spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_text.extract(pages, html_text.train(pages)).collect()
    assert sorted(r.page_id for r in got) == [1, 1, 2, 3, 4, 5]
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == want and texts[2] == texts[3] == texts[4] == ""
    assert all(r.n_chars == len(r.text) for r in got)
    plain_page = html.replace("<article>", "<div id='content'>").replace("</article>", "</div>")
    assert html_text.main_text(plain_page, html_text.train(pages)) == want
    assert html_text.extract(pages.limit(0), html_text.train(pages.limit(0))).count() == 0


def wanted_text(html):
    """The text of the blocks that a drawn page marks, and the page without the marks."""
    blocks = {}
    for block, text, features, _, _ in html_text.pieces(html):
        if html_text._WANTED_MARK in features:
            blocks.setdefault(block, []).append(text)
    return "\n".join(filter(None, (" ".join("".join(parts).split()) for parts in blocks.values()))), html.replace(f' class="{labelled_pages.WANTED}"', "")


@pytest.fixture(scope="module")
def drawn_weights():
    return html_text.fit_pages([], list(labelled_pages.layouts(html_text.LAYOUTS)))


def test_html_layouts(drawn_weights):
    """Article text in divs, without containers, beside menus and before comments that no class word tells."""
    said = ["The old bridge over the river was closed for repairs last week.", "Workers found cracks in two of the main beams during a check.",
            "The town hopes to open it again before the summer fair begins."]
    text = "".join(f"<p>{s}</p>" for s in said)
    top = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>About</a></li></ul></nav>"
    end = "<footer><p>Copyright notice of the site</p></footer>"
    reply = "<div class='reply'><p>I saw it too and it was great.</p></div><div class='reply'><p>Thanks for the article!</p></div>"
    links = "<div><a href='/'>Home</a> <a href='/x'>News</a></div>"
    for body in (
        f"{top}<article><div>{text}</div></article>{end}", f"{top}<article><div class='article-body'>{text}</div></article>{end}",
        f"{top}<main><div class='text'>{text}</div></main>{end}", f"{top}<article><div class='content'>{text}</div></article>{end}",
        f"{links}<div>{text}</div><div>Site by us</div>", f"{top}<article>{text}<div class='replies'>{reply}</div></article>{end}",
        f"{top}<article>{text}</article><div id='discussion'>{reply}</div>{end}",
    ):
        assert html_text.main_text(f"<html><body>{body}</body></html>", drawn_weights) == "\n".join(said), body


def test_html_layouts_held_out(drawn_weights):
    kept = extra = missed = 0
    for html in labelled_pages.layouts(150, seed=99):
        want, page = wanted_text(html)
        found, wanted = collections.Counter(html_text.main_text(page, drawn_weights).split()), collections.Counter(want.split())
        both = (found & wanted).total()
        kept, extra, missed = kept + both, extra + found.total() - both, missed + wanted.total() - both
    assert kept > 20_000 and extra < 0.01 * kept and missed < 0.02 * kept


def test_best_slice_against_all_runs():
    rng = random.Random(5)
    for _ in range(300):
        steps = [(rng.randrange(-6, 7), rng.choice((0, 0, 1, 3))) for _ in range(rng.randrange(0, 12))]

        def total(a, b):
            return sum(g for g, _ in steps[a:b]) - sum(c for _, c in steps[a + 1 : b])

        best = max([0, *(total(a, b) for a in range(len(steps)) for b in range(a + 1, len(steps) + 1))])
        a, b = html_text.best_slice(steps)
        assert (total(a, b) if b > a else 0) == best


def test_ftrl_against_a_plain_version():
    """One coordinate at a time, as the method is usually written."""
    rng = random.Random(7)
    examples = [np.array(sorted(rng.sample(range(16), rng.randrange(0, 6))), np.int32) for _ in range(60)]
    labels = np.array([float(3 in e or rng.random() < 0.1) for e in examples])
    model = toxicity.fit_ftrl(examples, labels, bits=4, epochs=3)
    z, n = [0.0] * 17, [0.0] * 17

    def weight(k):
        if abs(z[k]) <= toxicity.L1:
            return 0.0
        return -(z[k] - (1 if z[k] > 0 else -1) * toxicity.L1) / ((toxicity.BETA + n[k] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    order = np.random.default_rng(toxicity.SEED)
    for _ in range(3):
        for k in order.permutation(len(examples)):
            places = [*examples[k].tolist(), 16]
            own = [weight(p) for p in places]
            error = 1 / (1 + np.exp(-sum(own))) - labels[k]
            for p, w in zip(places, own):
                sigma = ((n[p] + error * error) ** 0.5 - n[p] ** 0.5) / toxicity.ALPHA
                z[p] += error - sigma * w
                n[p] += error * error
    want = {k: weight(k) for k in range(16) if weight(k)}
    assert dict(zip(model.places.tolist(), model.weights.tolist())) == pytest.approx(want) and model.bias == pytest.approx(weight(16))
    assert 3 in want


def test_toxicity_score_against_a_plain_version(llm_spark, odd):
    texts = [t for _, t, _ in odd[0]]
    make = toxicity.Features(8)
    model = toxicity.Model(np.arange(0, 256, 3), np.linspace(-1, 1, 86).astype(np.float32), -0.2, 8)
    weights = dict(zip(model.places.tolist(), model.weights.tolist()))
    # A column named like the result gives way.
    got = toxicity.score(odd[1], model).select("doc_id", "score", F.col("text")).collect()
    assert len(got) == len(texts)
    for row in got:
        total = model.bias + sum(weights.get(p, 0.0) for p in set(make.of(row.text or "").tolist()))
        assert row.score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-6)


def test_network_and_temperature():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 6))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    model = quality.fit_network(x, y, np.zeros((1, 6)))
    for row, logit in zip(x[:20], model.logits(x[:20])):
        hidden = [max(0.0, sum((row[k] - model.mean[k]) / model.scale[k] * model.w1[k, j] for k in range(6)) + model.b1[j]) for j in range(quality.HIDDEN)]
        assert logit == pytest.approx(sum(h * w for h, w in zip(hidden, model.w2)) + model.b2)
    left = np.arange(200) % 5 == 4
    logits = model.logits(x[left])

    def loss(t):
        p = 1 / (1 + np.exp(-logits / t))
        return -np.mean(np.where(y[left] == 1, np.log(p), np.log(1 - p)))

    grid = np.geomspace(0.25, 8, 61)
    assert loss(model.temperature) == pytest.approx(min(map(loss, grid)))
    assert model.probability(x[:3]) == pytest.approx(1 / (1 + np.exp(-model.logits(x[:3]) / model.temperature)))
    assert np.mean((model.logits(x[~left]) > 0) == (y[~left] == 1)) > 0.9


def test_fingerprints(llm_spark, odd):
    rows = [(k * 3, " ".join(sample_words(5 + k % 40, k)), "a") for k in range(300)]
    docs = plain(table(llm_spark, rows))
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs, cell_bytes=3000).collect()}
    permutations = shingles.Permutations(fingerprints.PERMUTATIONS, fingerprints.SEED)
    down = sorted(rows, reverse=True)
    for k, (i, text, _) in enumerate(down):
        after = down[(k + 1) % len(down)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        mark, changed = fingerprints.fingerprint(text, permutations), fingerprints.fingerprint(edited, permutations)
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (mark.tobytes().hex(), changed.tobytes().hex())
        assert row.near_edited == fingerprints.likeness(mark, changed)
        assert row.near_next == fingerprints.likeness(mark, fingerprints.fingerprint(after, permutations))
    # Null ids come last, in the last of many cells, and ids that repeat follow each other by text.
    tail = [(None, f"without id {k} " + " ".join(sample_words(30, k)), "a") for k in range(3)]
    tail += [(rows[7][0], "aa " + rows[7][1], "a")]
    ordered = sorted(rows + tail, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    found = fingerprints.fingerprints(plain(table(llm_spark, rows + tail)), cell_bytes=2000).collect()
    want = []
    for k, (i, text, _) in enumerate(ordered):
        half = len(text) // 2
        want.append((i, hashlib.sha256((text[: len(text) - half] + ordered[(k + 1) % len(ordered)][1][:half]).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.edited_sha256)) for r in found)
    assert fingerprints.fingerprints(plain(odd[1])).count() == 11
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0
    alone = fingerprints.fingerprints(docs.where("doc_id = 0")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    copies = plain(table(llm_spark, [(k, rows[200 + k % 2][1], "a") for k in range(6)]))
    pairs = {(r.a, r.b) for r in fingerprints.near_pairs(copies).collect()}
    assert pairs == {(0, 2), (0, 4), (1, 3), (1, 5)}


def test_chat_paths(llm_spark):
    # A tree with three leaves, a chain of 20, a circle, and a message whose parent is missing.
    rows = [("t", 1, None, 1.0), ("t", 2, 1, 0.0), ("t", 3, 1, 5.0), ("t", 4, 2, 9.0), ("t", 5, 3, 0.0), ("t", 6, 3, 4.0)]
    rows += [("c", k, k - 1 if k else None, 0.0) for k in range(20)]
    rows += [("o", 1, 2, 1.0), ("o", 2, 1, 1.0), ("m", 5, 4, 1.0)]
    full = [(c, n, p, s, "assistant" if n % 2 else "user", f"{c}{n}") for c, n, p, s in rows]
    messages = llm_spark.createDataFrame(full, "conv string, node long, parent long, score double, role string, text string")
    got = chat.chosen_paths(messages, 2).orderBy("conv", "rank", "depth").collect()
    paths = {}
    for r in got:
        paths.setdefault((r.conv, r["rank"]), []).append(r.node)
    assert paths == {("t", 1): [1, 2, 4], ("t", 2): [1, 3, 6], ("c", 1): list(range(20)), ("m", 1): [5]}
    assert chat.format_chats(messages.limit(0)).count() == 0


def test_chat_round_trip(llm_spark):
    texts = ["", "<|im_end|>", "a\\b<\\|n", "\\n\n<", "|x", "<|im_start|>assistant\nok", "🎉"]
    turns = [("user" if k % 2 else "assistant", t) for k, t in enumerate(texts)] + [("odd\nrole<|", "x")]
    text, spans = chat.format_turns(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert text.count(chat.OPEN) == len(turns)
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (None, None, None, None), (1, 1, "assistant", None)]
    frame = llm_spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv: r for r in chat.read_back(chat.format_chats(chat.as_tree(frame))).collect()}
    assert got["1"].n_turns == 3 and got["1"].loss_chars == 0 and got[""].n_turns == 1


def test_parity_bitmaps_never_rule_out_similar_sets():
    rng = np.random.default_rng(3)
    for size in (1, 40, 700, 5000):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for share in (0.0, 0.05, 0.3):
            moved = int(size * share)
            other = np.concatenate([base[moved:], rng.integers(0, 1 << 63, moved, dtype=np.uint64)])
            differ = len(np.setxor1d(base, other))
            bits = near_dedup._parity(base) ^ near_dedup._parity(other)
            assert int(np.unpackbits(bits.view(np.uint8)).sum()) <= differ
    assert not near_dedup._parity(np.empty(0, np.uint64)).any()
