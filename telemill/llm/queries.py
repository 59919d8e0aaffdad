"""The registered queries of the operators in this subpackage, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.acceptance.registry import with_shared_folder
from telemill.llm import (
    exact_dedup,
    filter_audit,
    html_text,
    language,
    licenses,
    merkle,
    multi_index,
    ngram_join,
    packing,
    pieces,
    quality,
    repeats,
    url_filter,
)
from telemill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = with_shared_folder(function)
        if sql is not None:
            SQL[name] = sql
        return function

    return register


# The rules of the query, as host, path and verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

OP1_SQL = """
WITH rules(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'),
  ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
tails AS (SELECT page_id, substr(url, nullif(strpos(url, '://'), 0) + 3) AS rest FROM pages),
split AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM tails),
fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC,
                            length(rhost) DESC) AS place
  FROM split LEFT JOIN rules
       ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fits WHERE place = 1"""


@query("op1_url_filter", OP1_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
spots AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 8)),
starts AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM spots) WHERE n > 1),
repeats AS (
  SELECT doc_id, sum(least(8, coalesce(following - i, 8)))::BIGINT AS n FROM starts GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(l) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '\p{Lu}{2}'))) AS n_shouted
  FROM d LEFT JOIN repeats USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 4 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * n_dup_lines > n_lines OR 2 * n_shouted > n_words) AS kept
FROM b"""


@query("op2_quality_rules", OP2_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


@query("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    "op5_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)""",
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP6_SQL = f"""
WITH templates(template, license, body) AS (VALUES {", ".join(
    f"({i}, {_quoted(name)}, {_quoted(body)})"
    for i, (name, body) in enumerate(licenses.TEMPLATES)
)}),
units AS (
  SELECT doc_id AS owner, unnest(list_distinct(
    [text] || string_split_regex(text, '\\n[ \\t]*\\n') || string_split(text, chr(10)))) AS body
  FROM documents WHERE text IS NOT NULL),
worded AS (
  SELECT kind, owner, body, list_filter(
    string_split_regex(lower(body), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
  FROM (SELECT 'unit' AS kind, owner, body FROM units
        UNION ALL SELECT 'template', template, body FROM templates)),
paired AS (
  SELECT kind, owner, body, pair, count(*) OVER (PARTITION BY kind, owner, body) AS n
  FROM (SELECT DISTINCT kind, owner, body, w[i] || ' ' || w[i + 1] AS pair
        FROM (SELECT *, unnest(range(1, len(w))) AS i FROM worded))),
alike AS (
  SELECT u.owner AS doc_id, u.body, license, 2.0::DOUBLE * count(*) / (u.n + t.n) AS dice
  FROM paired u JOIN paired t ON u.pair = t.pair AND u.kind = 'unit' AND t.kind = 'template'
  JOIN templates ON template = t.owner
  GROUP BY u.owner, u.body, u.n, t.owner, t.n, license)
SELECT doc_id, license, dice, coalesce(n_units, 0) AS n_units
FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN (
  SELECT doc_id, arg_min(license, (-dice, license)) AS license, max(dice) AS dice,
         count(DISTINCT body) AS n_units
  FROM alike WHERE dice >= 0.8 GROUP BY doc_id) USING (doc_id)"""


@query("op6_license_scan", OP6_SQL)
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    names = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    return packing.packed_documents(docs, *map(public_tokenizers.path, names))


@query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode_decode(table(spark, sf_dir, "documents"), model)
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language.train(docs.filter(~held_out).select("text", "lang"))
    return language.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


# All pairs, where the index may miss some; those of the tables are well above the limit.
OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9),
reached(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM parts"""


@query("op11_embedding_near_dedup", OP11_SQL)
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings"))


# SQL has no crc32, so its bits are made one by one.
CRC32_SQL = """xor(4294967295::BIGINT, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
    lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, zero: xor(c >> 1, 3988292384::BIGINT * (c & 1)))))"""

OP12_SQL = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, lang,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS a,
         coalesce(strlen(text) || ':' || text, '-') AS b, n_chars
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || b) AS leaf,
         sha256(a || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || b) AS altered
  FROM l),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
  FROM leaves),
tree(g, level, pos, node, n) AS (
  SELECT g, 0, pos, leaf, n FROM placed
  UNION ALL
  SELECT g, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
  FROM tree WHERE n > 1 GROUP BY g, level, pos // 2, n),
roots AS (SELECT g, node FROM tree WHERE n = 1),
top(level, pos, node, n) AS (
  SELECT 0, g, node, (SELECT count(*) FROM roots) FROM roots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
  FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
  SELECT doc_id, leaf, g, t.level, (pos_ >> t.level) & 1 AS bit, s.node AS sibling
  FROM (SELECT *, pos AS pos_ FROM placed) AS p
  JOIN (SELECT DISTINCT g, level FROM tree WHERE n > 1) AS t USING (g)
  LEFT JOIN tree AS s ON s.g = p.g AND s.level = t.level AND s.pos = xor(pos_ >> t.level, 1)
  UNION ALL
  SELECT doc_id, leaf, p.g, 100 + t.level, (p.g >> t.level) & 1, s.node
  FROM placed AS p, (SELECT DISTINCT level FROM top WHERE n > 1) AS t
  LEFT JOIN top AS s ON s.level = t.level AND s.pos = xor(p.g >> t.level, 1)),
proofs AS (
  SELECT doc_id, leaf, list(coalesce(sibling, '') ORDER BY level) AS siblings,
         list(bit ORDER BY level) AS bits
  FROM steps GROUP BY doc_id, leaf),
folding(doc_id, leaf, node, siblings, bits) AS (
  SELECT doc_id, p.leaf, CASE WHEN {CRC32_SQL} % 7 = 0 THEN altered ELSE p.leaf END,
         coalesce(siblings, []), coalesce(bits, [])
  FROM placed AS p LEFT JOIN proofs USING (doc_id)
  UNION ALL
  SELECT doc_id, leaf,
         sha256(CASE WHEN bits[1] = 1 THEN siblings[1] || node ELSE node || siblings[1] END),
         siblings[2:], bits[2:]
  FROM folding WHERE len(bits) > 0)
SELECT p.doc_id, p.leaf, r.node AS subroot, t.node AS root,
       sha256(coalesce(list_aggregate(o.siblings, 'string_agg', ''), '')) AS proof_sha256,
       f.node AS folded_root, f.node = t.node AS verified
FROM placed AS p JOIN roots AS r USING (g) JOIN top AS t ON t.n = 1
LEFT JOIN proofs AS o ON o.doc_id = p.doc_id JOIN folding AS f ON f.doc_id = p.doc_id AND len(f.bits) = 0"""


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered)


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
marked AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels
  GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(w) < 200)::INT
         + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS fails
  FROM d LEFT JOIN marked USING (doc_id)),
counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good,
         count(*) FILTER (WHERE toxic) AS toxic
  FROM failing GROUP BY part, fails),
letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS own,
         coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
sized AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (WHERE fails & (before | own) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE fails & before = 0 AND fails & own > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE fails & before > 0 AND fails & own > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE fails & before = 0 AND fails & own > 0), 0)::BIGINT
           AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE fails & before = 0 AND fails & own > 0), 0)::BIGINT
           AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM sized"""


@query("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.text_failures(docs, labels))
