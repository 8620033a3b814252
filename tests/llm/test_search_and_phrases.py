"""Collocations, lexical search and license scans against brute force, on odd rows and ties."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastergrid.llm import collocations, licenses, search

SCHEMA = "doc_id long, text string, lang string, score double, rank string, word string"


def table(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, g, 0.5, "x", "y") for i, t, g in rows], SCHEMA)


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


ODD = [(None, None, None), (1, "", "en"), (2, "\x00 İK. K\tÄ", "en"), (3, "x", None), (3, "x", None), (4, "word " * 30_000, "fr")]


def prose(seed, count, size=60, words=25):
    rng = random.Random(seed)
    names = [f"W{k}" if k % 3 else f"é{k}" for k in range(words)]
    return [
        (100 + k, "".join(rng.choice(names) + rng.choice([" ", " ", " ", "\t", ". ", ", ", "\n"]) for _ in range(rng.randrange(size))),
         rng.choice(["en", "de", None]))
        for k in range(count)
    ]


def brute_collocations(rows, least, top):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for at in range(len(words) - k + 1):
                    f[lang, tuple(words[at : at + k])] += 1
    found = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) == 1 or a < least:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        if len(p) == 2 and any(b >= least and 100 * b >= 50 * a for (g, q), b in f.items() if g == lang and len(q) == 3 and p in (q[:2], q[1:])):
            continue
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, rank, p.decode(), -a, l_, r, n[lang], -score)
        for lang, own in found.items() for rank, (score, a, p, l_, r) in enumerate(sorted(own)[:top], 1)
    }


@pytest.mark.parametrize("sample_bytes", [1, 3_000, 1 << 30])
def test_collocations(llm_spark, sample_bytes):
    """Whatever the sample proposes, the passes close on the same phrases."""
    rows = ODD + prose(1, 150)
    want = brute_collocations(rows, 4, 40)
    got = collocations.collocations(table(llm_spark, rows), least=4, top=40, sample_bytes=sample_bytes).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_collocations_of_nothing(llm_spark):
    docs = table(llm_spark, ODD)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.where("doc_id = 3"), least=1).count() == 0


def test_words_of_segments(monkeypatch):
    """Cutting long texts at ends of pieces changes no word and no neighbourhood; hashes tell words apart."""
    monkeypatch.setattr(collocations, "_CHUNK", 50)
    text = prose(2, 1, 4000)[0][1] + " " + "z" * 300 + " end"
    words, parts = collocations.Words(3), []
    for data in collocations._segments(text):
        _, joined, starts, ends, low = words.of(data, 5)
        parts += [(low[s:e].tobytes().decode(), j) for s, e, j in zip(starts, ends, joined)]
    want = []
    for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
        want += [(w, k > 0) for k, w in enumerate(re.findall("[^ \t]+", piece))]
    assert [(w, bool(j)) for w, j in parts] == want
    one = np.frombuffer(b"ab ba a\x00 \x00a a aa", np.uint8)
    assert len(set(words.of(one, 5)[0].tolist())) == 6


def test_bitmaps_agree_with_sql(llm_spark):
    rng = np.random.default_rng(4)
    pairs = rng.integers(-(1 << 63), 1 << 63, (500, 2), dtype=np.int64)
    frame = llm_spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "h1 bigint, h2 bigint")
    hashed = collocations.pair_hash(pairs[:, 0], pairs[:, 1])
    assert [r[0] for r in frame.select(F.expr(collocations._PAIR_HASH)).collect()] == hashed.tolist()
    for hashes, sql in ((hashed, collocations._PAIR_HASH), (pairs[:, 0], "h1")):
        bitmap = collocations._bitmap(frame, sql)
        assert collocations._bit(bitmap, hashes).all()
        assert np.unpackbits(bitmap).sum() == len(set((hashes & (len(bitmap) * 8 - 1)).tolist()))


def brute_search(rows, queries, top):
    word = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    docs = [(i, collections.Counter(lower(w) for w in word.findall(t or ""))) for i, t in rows]
    n_docs, length = sum(1 for _, c in docs if c), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(w for _, c in docs for w in c)
    asked = collections.defaultdict(set)
    for item, text in queries:
        asked[item] |= {lower(w) for w in word.findall(text or "")}
    result = []
    for item, wanted in asked.items():
        scored = []
        for i, c in docs:
            m = 10 + 90 * sum(c.values()) * n_docs // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        result += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(result, key=str)


def test_search(llm_spark, monkeypatch):
    monkeypatch.setattr(search, "_FIRST_MASKS", 2)
    docs = [(i, t) for i, t, _ in ODD + prose(5, 200, 30, 90)] + [(900 + k, "W1 W2 w1") for k in range(15)] + [(None, "w2 W1, é3")]
    asked = [(1, "W1 w2; É3 é3"), (2, None), (3, "nothing-here"), (None, "w5 w7"), (1, "w4"), (4, " ".join(f"w{k} é{k}" for k in range(90)))]
    queries = llm_spark.createDataFrame([(i, t, "x") for i, t in asked], "item_id long, text string, rank string")
    frame = table(llm_spark, [(i, t, "en") for i, t in docs]).repartition(5)
    want = brute_search(docs, asked, 10)
    assert sorted(map(tuple, search.search(frame, queries).collect()), key=str) == want
    assert sorted(map(tuple, search.search(frame, queries, block_terms=40).collect()), key=str) == want
    assert search.search(frame.limit(0), queries).count() == 0
    assert search.search(frame, queries.limit(0)).count() == 0


def brute_scan(rows):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    docs = [(i, word.findall(lower(t))) for i, t in rows]
    df = collections.Counter(w for _, ws in docs for w in set(ws))

    def weight(w):
        return math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[w] + 1)))

    result = []
    for i, ws in docs:
        base, labels, best = [], set(), 0.0
        for t in licenses.TEMPLATES:
            size = len(t["words"])
            for start in range(-size, len(ws)):
                if not all(0 <= start + m < len(ws) and ws[start + m] == t["words"][m] for m in t["must"]):
                    continue
                same = [k for k in range(size) if 0 <= start + k < len(ws) and ws[start + k] == t["words"][k]]
                whole = sum(weight(w) for w in t["words"])
                score = sum(weight(t["words"][k]) for k in same) / whole if whole else 1.0
                if t["base"] or score >= licenses.LEAST_SCORE:
                    labels.add(t["label"])
                    best = max(best, score)
                    base += [(start, t["label"])] if t["base"] else []
        result.append((i, len(ws), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                       ",".join(sorted({b for _, b in base})), ",".join(sorted(labels)), best))
    return sorted(result, key=str)


def test_license_scan(llm_spark):
    rows = [(i, t) for i, t, _ in ODD] + [
        (10, "MIT license"), (11, "The mit License, Apache-License and CC/BY-NC 4.0; cc by cc by"),
        (12, "Licensed under the Apache License, Version 2.0."), (13, "apache licenses, mit license2, KMIT license"),
        (14, "permission is hereby granted, free of charge, to any person obtaining a copy"), (15, "public license version 3"),
        (16, "by " * 500 + "cc by " * 40 + "gnu general public license"), (17, "version 3 gnu lesser general public license"),
        (10, "MIT license"), (None, "cc by sa 4 0"), (18, "Apache Lİcense apache license"),
    ] + [(i, t) for i, t, _ in prose(6, 50)]
    got = licenses.scan(table(llm_spark, [(i, t, "en") for i, t in rows]))
    assert sorted(map(tuple, got.collect()), key=str) == brute_scan(rows)
    assert licenses.scan(table(llm_spark, []).limit(0)).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
