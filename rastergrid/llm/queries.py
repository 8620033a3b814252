"""The numbered operators over their whole tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastergrid.session import ship_package

from . import chat, collocations, exact_dedup, fingerprints, html_text, licenses, mixing, near_dedup, pieces, quality, search, sharding, toxicity
from .common import plain, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under its name."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return add


@query(
    """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """
)
def op1_exact_dedup(spark, sf_dir):
    """Which row of each group of identical texts stays."""
    docs = plain(table(spark, sf_dir, "documents"))
    return exact_dedup.exact_dedup(docs, {"text_sha256": F.sha2("text", 256)})


def _labels(spark, sf_dir, column, parts, held):
    """Training labels only, and the remainder that decides about them."""
    left = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))
    labels = table(spark, sf_dir, "labels").where(left != held)
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).alias("label"))


def _scored(docs, model, scorer, parts, held, threshold):
    left = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(parts))
    return scorer(docs, model).select(
        "doc_id", (left == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def toxicity_model(spark, sf_dir):
    """The model that query and pipeline use: labels from rows outside the held-out third."""
    docs = plain(table(spark, sf_dir, "documents"))
    return toxicity.train(docs, _labels(spark, sf_dir, "toxic", 3, 1))


@query()
def op2_toxicity(spark, sf_dir):
    """A toxicity score for every document."""
    docs = plain(table(spark, sf_dir, "documents"))
    return _scored(docs, toxicity_model(spark, sf_dir), toxicity.score, 3, 1, toxicity.THRESHOLD)


@query()
def op3_sharding(spark, sf_dir):
    """All documents in 16 shards of equal row counts, in a global shuffle."""
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), size.alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.shuffle_into_shards(rows, "doc_id", "size").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    r"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source
    ), weighed AS (
        SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(rank % 3) + 1] AS w, source_size * 2.0::DOUBLE AS top FROM sources
    ), levels AS (
        SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(top) OVER b, 0))
                  / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
        FROM weighed WINDOW b AS (ORDER BY top / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), filled AS (
        SELECT *, arg_min(level, struct_pack(a := top / w, b := rank)) FILTER (WHERE level * w < top) OVER () AS final
        FROM levels
    ), targets AS (
        SELECT source, source_size, rank, least(top, coalesce(final * w, top)) AS target FROM filled
    ), laid AS (
        SELECT d.*, t.source_size, t.target, t.rank, sum(d.size) OVER (
                   PARTITION BY d.source ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) - d.size AS begin_at
        FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
    ), passed AS (
        SELECT *, greatest(0, least(size, floor(target)::BIGINT - begin_at)) AS once,
               greatest(0, least(size, floor(target)::BIGINT - begin_at - source_size)) AS twice FROM laid
    ), shares AS (
        SELECT *, (begin_at + once / 2.0::DOUBLE) / target AS share,
               share * [0.75::DOUBLE, 1.0::DOUBLE, 1.125::DOUBLE][(rank % 3) + 1] AS need FROM passed
    )
    SELECT doc_id, size, source_size, target, (once + twice)::BIGINT AS taken,
           CASE WHEN once > 0 THEN floor(1000000::DOUBLE * CASE
               WHEN rank % 3 = 0 THEN CASE WHEN need < 0.75 THEN 2 * need / (1 + sqrt(1 - need)) ELSE 1.0 END
               WHEN rank % 3 = 1 THEN CASE WHEN need < 1.0 THEN 2 * need / (1 + sqrt(1.0::DOUBLE)) ELSE 1.0 END
               WHEN need < 0.375 THEN 2 * need / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2 * need))
               WHEN need < 1.125 THEN 0.5::DOUBLE + 2 * (need - 0.375::DOUBLE) / (1 + sqrt(1 + 4 * (need - 0.375::DOUBLE)))
               ELSE 1.0 END)::BIGINT END AS first_at
    FROM shares
    """
)
def op4_mixing(spark, sf_dir):
    """How many words of each document a mix of all sources takes, and when in training it takes them first (millionths)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    first = F.floor(1_000_000 * F.try_element_at("positions", F.lit(1)))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", first.alias("first_at"))


@query(
    r"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
        FROM worded
    ), counts AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
    shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
    common AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
        FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ), linked AS (
        SELECT x, y FROM common JOIN counts p ON p.doc_id = x JOIN counts q ON q.doc_id = y
        WHERE 100 * common.n >= 75 * (p.n + q.n - common.n)
    ), reach AS (
        SELECT doc_id AS x, doc_id AS y FROM counts UNION SELECT r.x, l.y FROM reach r JOIN linked l ON r.y = l.x
    ), smallest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
    SELECT c.doc_id, c.n AS n_shingles, s.component_id, c.doc_id = s.component_id AS kept
    FROM counts c JOIN smallest s ON s.x = c.doc_id
    """
)
def op9_near_dedup(spark, sf_dir):
    """The component of similar documents that each document belongs to."""
    return near_dedup.near_dedup(plain(table(spark, sf_dir, "documents")))


@query()
def op6_sentencepiece(spark, sf_dir):
    """Ids of every document under the vocabulary file, and their text back."""
    import public_tokenizers

    docs = plain(table(spark, sf_dir, "documents"))
    return pieces.encode_documents(docs, pieces.read_model(public_tokenizers.path("piece_bpe_32k.model")))


@query()
def op10_quality(spark, sf_dir):
    """A quality score for every document."""
    docs = plain(table(spark, sf_dir, "documents"))
    model = quality.train(docs, _labels(spark, sf_dir, "quality", 5, 0))
    return _scored(docs, model, quality.score, 5, 0, quality.THRESHOLD)


@query()
def op5_html_extraction(spark, sf_dir):
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.train(pages))


@query()
def op7_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprints(plain(table(spark, sf_dir, "documents")))


@query(
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
    ), sized AS (
        SELECT *, length(replace(replace(replace(role, '\', '\'), '<|', '<\|'), chr(10), '\n'))
                  + length(replace(replace(text, '\', '\'), '<|', '<\|')) + 24 AS n FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(n)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """
)
def op8_chat_formatting(spark, sf_dir):
    """Every conversation in the chat template, as a reader gets it back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = f"{chat.CLOSE}{chat.OPEN}assistant ok"
    tricky = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    messages = chat.as_tree(rows.unionByName(tricky))
    found = chat.read_back(chat.format_chats(messages))
    return found.select(F.nullif("conv", F.lit("")).cast("bigint").alias("conv_id"), *found.columns[1:])


@query(
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), worded AS MATERIALIZED (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ), grams AS (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
        FROM worded, (VALUES (1), (2), (3)) t(k)
    ), counts AS MATERIALIZED (
        SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
    ), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
    often AS MATERIALIZED (SELECT lang, k, phrase, f FROM counts WHERE f >= 10),
    candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM often WHERE k > 1),
    halves AS MATERIALIZED (
        SELECT *, array_to_string(w[1:cut], ' ') AS left_part, array_to_string(w[cut + 1:], ' ') AS right_part
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)
    ), cuts AS (
        SELECT c.lang, c.k, c.phrase, c.a, cut, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f))::BIGINT AS score
        FROM halves c JOIN often l ON l.lang = c.lang AND l.phrase = left_part
        JOIN often r ON r.lang = c.lang AND r.phrase = right_part
    ), weakest AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ), inner_pairs AS (
        SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE k = 3
    ), longer AS (SELECT lang, phrase, max(a) AS longest FROM inner_pairs GROUP BY ALL),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
        FROM weakest LEFT JOIN longer USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 50 * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """
)
def op11_collocations(spark, sf_dir):
    """The best phrases of two or three words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query(licenses.oracle_sql())
def op13_license_scan(spark, sf_dir):
    """The license phrases and notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH texts AS (
        SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
    ), tokens AS (
        SELECT row_id, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM texts
    ), counts AS MATERIALIZED (SELECT row_id, doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
    sizes AS (SELECT row_id, sum(tf)::BIGINT AS n FROM counts GROUP BY row_id),
    whole AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
    df AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
    wanted AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark
    ), weighed AS (
        SELECT item_id, term, floor(1000 * ln((2 * big_n + 2) / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM wanted JOIN df USING (term), whole
    ), scored AS (
        SELECT item_id, row_id, any_value(doc_id) AS doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
        FROM weighed JOIN counts USING (term) JOIN sizes USING (row_id), whole GROUP BY item_id, row_id
    )
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10
    """
)
def op12_lexical_search(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
