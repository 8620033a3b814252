"""License scans by a positional index of rare words, with DataFrame functions only.

1. One pass over the texts counts, for every word of the templates, the documents that have it, and so
   its IDF. Of each template's mandatory phrases the rarest words are indexed: word, template, place.
2. A second pass looks the indexed words up in the documents that have any. Each hit gives postings
   (template, place of the hit less place in the template); where a template's postings meet at one
   relative place, they make a candidate.
3. A candidate stands if its mandatory phrases do, word by word, in the window of words around it. Its
   score is the share of the template's IDF that agrees at its place.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Of a template's mandatory words at most so many of the rarest are indexed, those with at least this share of the
# greatest IDF among them; the check of whole phrases needs no more, and frequent words would be hits everywhere.
INDEXED, RARE = 2, 0.5
# The least score that gives the label of a template that is not a base phrase.
LEAST_SCORE = 0.5

# Base phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"),
]
# Label, words of a usual notice, and the phrases of it that must stand.
NOTICES = [
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["gnu affero general public license"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
    ("cc-by-4", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ["permission is hereby granted free of charge", "obtaining a copy"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ["redistribution and use in source and binary forms", "with or without modification"]),
    ("mpl-2", "subject to the terms of the mozilla public license version 2 0", ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["use copy modify and or distribute this software", "with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]


def template(label: str, text: str, phrases: list[str], base: bool = False) -> dict:
    """A template: its words, and the places of the words that must stand."""
    words, must = text.split(), set()
    for phrase in phrases:
        own = phrase.split()
        start = next(k for k in range(len(words) - len(own) + 1) if words[k : k + len(own)] == own)
        must.update(range(start, start + len(own)))
    return {"label": label, "base": base, "words": words, "must": sorted(must)}


TEMPLATES = [template(label, phrase, [phrase], True) for phrase, label in BASE] + [template(*notice) for notice in NOTICES]
_SCHEMA = "array<struct<label: string, base: boolean, words: array<string>, must: array<int>>>"


def template_table(spark: SparkSession, templates: list[dict]) -> DataFrame:
    """(template, label, base, words, must); its size is that of the given templates."""
    rows = F.posexplode(F.from_json(F.lit(json.dumps(templates)), _SCHEMA))
    table = spark.range(1).select(rows.alias("template", "t"))
    return table.select("template", "t.*")


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case; other characters keep their place among the words."""
    # Two characters besides A-Z turn into ASCII in lower case; others stay beyond ASCII.
    lower = F.lower(F.replace(F.replace(text, F.lit("İ"), F.lit("ı")), F.lit("K"), F.lit("ĸ")))
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _weight(total, df) -> Column:
    return F.floor(1000 * F.log((2 * total + 2) / (2 * df + 1))).cast("bigint")


def scan(docs: DataFrame, templates: list[dict] | None = None, least_score: float = LEAST_SCORE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, the places of base phrases, labels and the best score.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the least and the
    greatest word they start at (null without one). ``base_labels`` and ``labels`` are distinct, sorted and
    joined by commas; ``labels`` has those of the other templates too that stand with ``least_score`` or
    more. ``score`` is the best score of a base phrase or of a template that gave its label, else 0. Null texts are
    empty; texts of any length are read whole; rows that repeat, or share an id, stay rows of their own;
    an empty table gives an empty result; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    longest = max(len(t["words"]) for t in templates)
    vocabulary = sorted({w for t in templates for w in t["words"]})
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))

    # First pass: number of words, and the documents that each template word is in.
    words = words_of(F.col("text"))
    known = F.array(*map(F.lit, vocabulary))
    facts = save(
        rows.withColumn("words", words)
        .select("doc_id", "text_key", F.size("words").cast("bigint").alias("n_words"), F.array_intersect("words", known).alias("seen")),
        "license-facts",
    )
    counts = facts.agg(F.count("*").alias("total"))
    df = facts.select(F.explode("seen").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    table = template_table(spark, templates)
    every = table.select("template", "must", F.posexplode("words").alias("place", "word"))
    total = counts.first()["total"]
    weighed = every.join(F.broadcast(df), "word", "left").select(
        "template", "place", "word", F.array_contains("must", F.col("place")).alias("must"),
        _weight(F.lit(total), F.coalesce("df", F.lit(0))).alias("weight"),
    )
    weighed = save(weighed, "license-weights")
    # The index: the rarest mandatory words of each template, with the words beside them from the template itself.
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("order"), "word", "place")))
    ranks = weighed.where("must").groupBy("template").agg(ordered.alias("all")).select(
        "template", F.slice(F.filter("all", lambda one: one["order"] <= F.get("all", F.lit(0))["order"] * RARE), 1, INDEXED).alias("rarest")
    )
    profile = weighed.groupBy("template").agg(
        F.sort_array(F.collect_list(F.struct("place", "weight"))).alias("weights"), F.sum("weight").alias("whole")
    )
    index = (
        ranks.join(profile, "template").join(table, "template")
        .select("template", "label", "base", "words", "must", "weights.weight", "whole",
                F.size("rarest").alias("postings"), F.posexplode("rarest").alias("rank", "r"))
        .select("*", F.col("r.word").alias("word"), F.col("r.place").alias("at")).drop("r")
    )
    index = save(index, "license-index")
    # At most INDEXED words a template; the rarest one of each is the one whose hits keep the words around them.
    chosen = index.groupBy("word").agg(F.min("rank").alias("rank")).orderBy("word").collect()
    rare, rarest = [r["word"] for r in chosen], [r["word"] for r in chosen if r["rank"] == 0]

    # Second pass: hits of indexed words, each with the words around it.
    looked_up, around = F.array(*map(F.lit, rare)), F.array(*map(F.lit, rarest))
    somewhere = F.lit(False)
    lower = F.lower("text")
    for word in rare:
        somewhere = somewhere | F.contains(lower, F.lit(word))
    hits = F.filter(
        F.transform("words", lambda w, k: F.when(F.array_contains(looked_up, w), F.struct(k.alias("pos"), w.alias("word")))),
        lambda hit: hit.isNotNull(),
    )
    begin = lambda hit: F.greatest(hit["pos"] - longest + 1, F.lit(0))
    windows = F.transform(
        "hits", lambda hit: F.struct(
            hit["pos"].alias("pos"), hit["word"].alias("word"), begin(hit).alias("begin"),
            F.when(F.array_contains(around, hit["word"]), F.slice("words", begin(hit) + 1, F.lit(2 * longest - 1))).alias("window"),
        )
    )
    found = (
        rows.where(somewhere).withColumn("words", words).select("doc_id", "text_key", "words", hits.alias("hits"))
        .where(F.size("hits") > 0).select("doc_id", "text_key", F.explode(windows).alias("hit")).select("doc_id", "text_key", "hit.*")
    )
    postings = found.join(F.broadcast(index), "word").withColumn("start", F.col("pos") - F.col("at"))
    # Postings meet at a relative place (below 0 if the text begins inside a notice). The window of the rarest
    # one holds all words of the template there.
    key = ["doc_id", "text_key", "template", "start"]
    first = F.when(F.col("rank") == 0, F.struct("begin", "window"))
    met = postings.groupBy(*key).agg(
        F.bit_or(F.expr("shiftleft(1, rank)")).alias("ranks"), F.max("postings").alias("postings"), F.max(first).alias("w")
    ).where("ranks = shiftleft(1, postings) - 1")
    shape = F.broadcast(index.where("rank = 0").select("template", "label", "base", "words", "must", "weight", "whole"))
    agrees = F.transform("words", lambda word, k: F.coalesce(F.get("w.window", F.col("start") - F.col("w.begin") + k) == word, F.lit(False)))
    candidates = met.join(shape, "template").withColumn("agrees", agrees)
    standing = candidates.where(F.forall("must", lambda place: F.get("agrees", place)))
    agreed = F.aggregate(
        F.zip_with("agrees", "weight", lambda same, weight: F.when(same, weight).otherwise(F.lit(0).cast("bigint"))),
        F.lit(0).cast("bigint"), lambda a, b: a + b,
    )
    share = F.when(F.col("whole") > 0, agreed / F.col("whole")).otherwise(F.lit(1.0))
    standing = standing.withColumn("score", share).where(F.col("base") | (F.col("score") >= least_score))
    labels = lambda c: F.concat_ws(",", F.array_sort(c))
    labelled = standing.groupBy("doc_id", "text_key").agg(
        F.count_if(F.col("base")).alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        labels(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        labels(F.collect_set("label")).alias("labels"), F.max("score").alias("score"),
    )
    return facts.alias("f").join(
        labelled.alias("l"), F.col("f.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("f.text_key") == F.col("l.text_key")), "left"
    ).select(
        "f.doc_id", "f.n_words", F.coalesce("l.n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("l.first_word").cast("bigint").alias("first_word"), F.col("l.last_word").cast("bigint").alias("last_word"),
        F.coalesce("l.base_labels", F.lit("")).alias("base_labels"), F.coalesce("l.labels", F.lit("")).alias("labels"),
        F.coalesce("l.score", F.lit(0.0)).alias("score"),
    )


def oracle_sql(templates: list[dict] | None = None, least_score: float = LEAST_SCORE) -> str:
    """The same in DuckDB, by brute force over all places of all templates."""
    rows = ", ".join(
        f"({k}, '{t['label']}', {str(t['base']).lower()}, {t['words']!r}, {t['must']!r})" for k, t in enumerate(templates or TEMPLATES)
    )
    return rf"""
    WITH worded AS MATERIALIZED (
        SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), templates(template, label, base, words, must) AS (VALUES {rows}),
    vocabulary AS (SELECT DISTINCT unnest(words) AS word FROM templates),
    df AS (
        SELECT word, count(*) AS df FROM (SELECT row_id, unnest(list_distinct(w)) AS word FROM worded) JOIN vocabulary USING (word) GROUP BY word
    ), weights AS (
        SELECT word, floor(1000 * ln((2 * (SELECT count(*) FROM documents) + 2) / (2 * coalesce(df, 0) + 1)))::BIGINT AS weight
        FROM vocabulary LEFT JOIN df USING (word)
    ), weighed AS (
        SELECT template, any_value(label) AS label, any_value(base) AS base, any_value(must) AS must, list(word ORDER BY spot) AS words,
               list(weight ORDER BY spot) AS weight, sum(weight)::BIGINT AS whole
        FROM (SELECT template, label, base, must, unnest(words) AS word, unnest(range(len(words))) AS spot FROM templates)
        JOIN weights USING (word) GROUP BY template
    ), starts AS (
        SELECT row_id, w, t.*, unnest(list_filter(range(1, len(w) + 1), lambda p: w[p] = words[must[1] + 1])) - 1 - must[1] AS start
        FROM worded JOIN weighed t ON list_contains(w, words[must[1] + 1])
    ), standing AS (
        SELECT row_id, label, base, start,
               list_sum(list_transform(range(len(words)), lambda k: CASE WHEN start + k >= 0 AND w[greatest(start + k, 0) + 1] = words[k + 1]
                        THEN weight[k + 1] ELSE 0 END))::BIGINT / whole::DOUBLE AS score
        FROM starts WHERE len(list_filter(must, lambda m: w[start + m + 1] = words[m + 1])) = len(must)
    ), found AS (
        SELECT row_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
               max(start) FILTER (WHERE base) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
        FROM standing WHERE base OR score >= {least_score} GROUP BY row_id
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
           coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
    FROM worded LEFT JOIN found USING (row_id)
    """
