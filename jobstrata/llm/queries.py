"""Registered queries of the subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.llm import (
    alignment,
    language,
    lines,
    mixing,
    neardup,
    neighbours,
    packing,
    surrogates,
    tokens,
    topk,
    trie,
    url_filters,
    warc,
)
from jobstrata.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def keep(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return keep


@_register("op1_language")
def op1_language(spark, sf_dir):
    """The language of every document, learned from those that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs), ["doc_id"])
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@_register("op4_mixing")
def op4_mixing(spark, sf_dir):
    """Words that a mix by source weights takes of every document."""
    taken = mixing.copies(read_table(spark, sf_dir, "documents"))
    each = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("row")
    return taken.select("*", each).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
    )


@_register(
    "op8_topk",
    """
WITH rows AS (
    SELECT vec_id, [floor(64 * x) for x in CAST(embedding AS DOUBLE[])] AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
    FROM rows q JOIN rows r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
), ranked AS (
    SELECT query_id, vec_id, score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
)
def op8_topk(spark, sf_dir):
    """The 20 largest integer inner products of every 20th vector."""
    table = read_table(spark, sf_dir, "embeddings")
    return topk.top_inner_products(table, F.col("id") % 20 == 0, 20)


@_register(
    "op9_neighbours",
    """
WITH rows AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x for x in embedding if x <> 0]) > 0
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id,
           sqrt(list_sum([(q.v[i] - r.v[i]) * (q.v[i] - r.v[i]) for i in range(1, len(q.v) + 1)]))
               AS score
    FROM rows q JOIN rows r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
), ranked AS (
    SELECT query_id, vec_id, score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
)
def op9_neighbours(spark, sf_dir):
    """The 10 nearest vectors of every 100th vector."""
    table = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(table, F.col("id") % 100 == 0, 10)


@_register("op10_tokens")
def op10_tokens(spark, sf_dir):
    """Byte-level BPE tokens of every document, and whether they pass 512."""
    docs = read_table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.count_tokens(docs, path, 512, ["doc_id"])


@_register("op7_packing")
def op7_packing(spark, sf_dir):
    """Pieces of all documents in sequences of 4096 tokens."""
    return packed_digest(read_table(spark, sf_dir, "documents"))


def packed_digest(docs: DataFrame) -> DataFrame:
    """Packed pieces with a checksum in place of their ids."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, 2)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@_register(
    "op3_warc",
    """
WITH heads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM heads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts""",
)
def op3_warc(spark, sf_dir):
    """All pages through deduplicated archives."""
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@_register(
    "op5_lines",
    r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place
    FROM documents
), counted AS (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM split
), placed AS (
    SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY place) AS through
    FROM counted WHERE words > 0
), framed AS (
    SELECT doc_id, place AS first, max(place) OVER w AS last,
           string_agg(line, chr(10)) OVER w AS content, sum(words) OVER w AS words
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY through - words
                             RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
    UNION ALL
    SELECT doc_id, min(place) OVER w, place,
           string_agg(line, chr(10)) OVER w, sum(words) OVER w
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY through
                             RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), later AS (
    SELECT *, min((doc_id, first)) OVER (PARTITION BY content) AS original
    FROM framed WHERE words >= 50
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(first, last)) AS place
    FROM later WHERE (doc_id, first) <> original
), marked AS (
    SELECT s.doc_id, s.line, s.place, g.place IS NOT NULL AS gone
    FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.place = g.place
)
SELECT doc_id, CAST(count(CASE WHEN gone THEN 1 END) AS INTEGER) AS removed_lines,
       coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, text FROM documents WHERE text IS NULL""",
)
def op5_lines(spark, sf_dir):
    """All documents without their repeated runs of 50 words or more."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.remove_repeated_runs(docs)


@_register(
    "op2_neardup",
    r"""
WITH RECURSIVE words AS (
    SELECT doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(
        CASE WHEN coalesce(len(w), 0) = 0 THEN []
             WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS s
    FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), smallest AS (
    SELECT x, min(y) AS component_id FROM reached GROUP BY x
)
SELECT s.doc_id, len(s.s) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM sets s JOIN smallest m ON s.doc_id = m.x""",
)
def op2_neardup(spark, sf_dir):
    """Components of near-duplicate documents."""
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), 85)


@_register("op6_surrogates")
def op6_surrogates(spark, sf_dir):
    """All documents with surrogates for personal data."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_personal_data(docs, "documents-2024")


SITES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}
# Words of hosts and paths that are not wanted where no site decides.
PATTERNS = {
    f"^{word}^": "block"
    for word in ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "track", "xxx")
}


@_register(
    "op13_urls",
    r"""
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), sites(rule, site, start, verdict) AS (
    VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
           ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), judged AS (
    SELECT p.*, (SELECT arg_max(struct_pack(rule := s.rule, verdict := s.verdict), length(s.rule))
                 FROM sites s WHERE ('.' || p.host) LIKE ('%.' || s.site)
                   AND starts_with(p.path, s.start)) AS best
    FROM parts p
), patterned AS (
    SELECT *, list_min([w for w in ['^adult^', '^ads^', '^bets^', '^casino^', '^pills^', '^porn^',
                                    '^spam^', '^track^', '^xxx^']
        if regexp_matches(host || path, '(?i)(^|[^A-Za-z0-9])' || trim(w, '^')
                                        || '([^A-Za-z0-9]|$)')]) AS blocking
    FROM judged
)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN blocking IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN best IS NULL THEN blocking END AS pattern
FROM patterned""",
)
def op13_urls(spark, sf_dir):
    """Verdicts on the URLs of all pages."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filters.judge(pages, url_filters.rule_table(spark, SITES, PATTERNS))
    return judged.drop("url")


@_register("op12_alignment")
def op12_alignment(spark, sf_dir):
    """Byte-level and piece tokens of every document, aligned, with corpus-wide counts."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(docs, *paths, keep=["doc_id"])


@_register(
    "op11_trie",
    """
WITH own AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                              coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
    SELECT c, list(struct_pack(role := role, text := text) ORDER BY place) AS t
    FROM own GROUP BY c
), heads AS (
    SELECT c, t, xor(list_reduce(list_prepend(4294967295::BIGINT,
            [ascii(d)::BIGINT for d in string_split(CAST(c AS VARCHAR), '')]),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                lambda x, step: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 AS h
    FROM turns
), whole AS (
    SELECT a.c, list_concat(coalesce(b.t[1:a.h], []), a.t[a.h + 1:]) AS t
    FROM heads a LEFT JOIN turns b ON b.c = a.c - a.c % 5
), paths AS (
    SELECT c, t, unnest(range(len(t) + 1)) AS d FROM whole
), nodes AS (
    SELECT t[1:d] AS key, d, min(c) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CASE WHEN len(t) = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')
               AS ends
    FROM paths GROUP BY t[1:d], d
), children AS (
    SELECT key[1:d - 1] AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), weighed AS (
    SELECT n.*, coalesce(k.n_children, 0) AS n_children,
           CASE WHEN n.d > 0 THEN (n.n_convs - 1) * strlen(n.key[n.d].text) ELSE 0 END AS weight
    FROM nodes n LEFT JOIN children k ON n.key = k.key
), below AS (
    SELECT p.t[1:p.d] AS key, sum(w.weight) AS saved,
           count(CASE WHEN w.n_children = 0 THEN 1 END) AS leaves
    FROM weighed w JOIN paths p ON w.conv_id = p.c AND p.d <= w.d GROUP BY 1
)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children,
       b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
       sha256(w.ends) AS ends_sha256
FROM weighed w JOIN below b ON w.key = b.key
LEFT JOIN nodes p ON w.d > 0 AND p.key = w.key[1:w.d - 1]""",
)
def op11_trie(spark, sf_dir):
    """Nodes of the prefix trie of all conversations, rebuilt to begin alike."""
    return trie.prefix_trie(*trie.rebuilt(read_table(spark, sf_dir, "conversations")))
