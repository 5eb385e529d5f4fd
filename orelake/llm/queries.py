"""Queries of the training-data operators, each beside its check in SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.llm import (
    exact_dedup,
    kneser_ney,
    merkle_manifest,
    mixing,
    near_dedup,
    page_text,
    personal_data,
    piece_sampling,
    quality_rules,
    source_audit,
    toxicity,
    url_filters,
    warc_archive,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if check is not None:
            CHECKS[run.__name__] = check
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
lines AS (
  SELECT doc_id, t, w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS tri
  FROM words),
repeated AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, x) AS c
    FROM (SELECT doc_id, unnest(tri) AS x, unnest(range(1, len(tri) + 1)) AS pos FROM lines)),
    unnest([pos, pos + 1, pos + 2]) AS u(p)
  WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS c FROM repeated GROUP BY doc_id),
m AS (
  SELECT lines.doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(c, 0)::BIGINT AS n_repeat_words
  FROM lines LEFT JOIN covered ON covered.doc_id = lines.doc_id),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
           + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 8 ELSE 0 END
           + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 16 ELSE 0 END)::BIGINT AS failed_bits
  FROM m)
SELECT *, (failed_bits & 3) <> 0 AS base_failed, 'v2' AS policy, (failed_bits & 15) = 0 AS kept FROM b
"""
)
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, failure bits and verdict of the default policy for every document."""
    return quality_rules.apply_policy(quality_rules.ledger(table(spark, folder, "documents")))


@query(
    r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
"""
)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one of equal text that stays."""
    return exact_dedup.groups(table(spark, folder, "documents"))


@query()
def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the class of near-copies it is in."""
    return near_dedup.classes(table(spark, folder, "documents")).select("doc_id", "class_id", "class_size")


@query()
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Domain posteriors, fitted rate and number of copies of every document."""
    labelled = mixing.label_domains(table(spark, folder, "labels"))
    return mixing.rates(table(spark, folder, "documents"), labelled)


@query()
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Sampled pieces of every document, and whether they decode to its text."""
    encoded = piece_sampling.encode(table(spark, folder, "documents").select("doc_id", "text"), check="lossless")
    return encoded.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "lossless")


@query()
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: base counts and digest, and all spans."""
    return personal_data.digest(personal_data.find(table(spark, folder, "documents")))


@query()
def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page and its length."""
    return page_text.extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query(
    r"""
WITH s AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM s),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host, '(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
)
def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the url of every page."""
    return url_filters.judge(table(spark, folder, "pages"))


@query()
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity of every document under a model of trusted text, and its place among its language's thresholds."""
    labels = table(spark, folder, "labels")
    return kneser_ney.judge(table(spark, folder, "documents"), kneser_ney.trusted_ids(labels), poor=kneser_ney.poor_ids(labels))


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _manifest_sql(levels: int, upper: int) -> str:
    """Trees of up to 8 ** levels leaves a language, and 8 ** upper languages, level by level."""

    def level(made: str, path: str, k: int) -> str:
        run = "PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
        return f""",
{made}s{k} AS (
  SELECT *, count(*) OVER (PARTITION BY tree) AS n,
         coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {made}{k}),
{made}{k + 1} AS (
  SELECT tree, pos // 8 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d
  FROM {made}s{k} GROUP BY tree, pos // 8),
{path}{k + 1} AS (
  SELECT p.* REPLACE (p.pos // 8 AS pos, CASE WHEN n = 1 THEN folded ELSE sha256(before || folded || after) END AS folded,
                      CASE WHEN n = 1 THEN proof ELSE proof || before || after END AS proof)
  FROM {path}{k} AS p JOIN {made}s{k} USING (tree, pos))"""

    field = lambda x: f"coalesce(strlen(({x})::VARCHAR) || ':' || ({x}), '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    # One bit of the checksum a step; a byte of the id enters every eighth.
    byte = "(CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1))) ELSE c END)"
    return f"""
WITH crc AS (
  SELECT *, xor(4294967295, list_reduce(range(8 * strlen(doc_id::VARCHAR)), lambda c, i:
      xor({byte} // 2, CASE WHEN {byte} % 2 = 1 THEN 3988292384 ELSE 0 END), 4294967295::BIGINT)) % 3 = 0 AS tampered
  FROM documents),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf("text")} AS d,
         CASE WHEN tampered THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS fresh
  FROM crc),
p0 AS (
  SELECT doc_id, tree, d AS leaf, coalesce(fresh, d) AS folded, '' AS proof,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS pos
  FROM leaves),
t0 AS (SELECT tree, pos, leaf AS d FROM p0){"".join(level("t", "p", k) for k in range(levels))},
u0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, d FROM t{levels}),
named AS (SELECT tree AS language, row_number() OVER (ORDER BY tree) - 1 AS pos, d AS subroot FROM t{levels}),
q0 AS (
  SELECT doc_id, leaf, folded, proof, subroot, '' AS tree, named.pos AS pos
  FROM p{levels} AS p JOIN named ON named.language = p.tree){"".join(level("u", "q", k) for k in range(upper))}
SELECT doc_id, leaf, subroot, u.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = u.d AS verified
FROM q{upper} CROSS JOIN u{upper} AS u
"""


@query(_manifest_sql(8, 2))
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, checked after a third of the texts was changed."""
    return merkle_manifest.audit(table(spark, folder, "documents"))


@query(
    """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN n < 100 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM p
"""
)
def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page after it was written to an archive and read back."""
    return warc_archive.archived(table(spark, folder, "pages"))


@query(
    r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
kept AS (SELECT lang, t FROM (SELECT lang, unnest(list_distinct(w)) AS t FROM d) GROUP BY ALL HAVING count(*) >= 10),
seen AS (SELECT lang, source, t, count(*) AS c FROM (SELECT lang, source, unnest(w) AS t FROM d) JOIN kept USING (lang, t) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cells AS (
  SELECT g.lang, g.source, kept.t, coalesce(c, 0) AS c, v, sum(coalesce(c, 0)) OVER (PARTITION BY g.lang, g.source) AS n
  FROM groups AS g JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN seen ON (seen.lang, seen.source, seen.t) = (g.lang, g.source, kept.t)),
p AS (SELECT *, (1 + 1000000000::HUGEINT * (c + 2) // (n + 2 * v))::BIGINT AS p FROM cells),
whole AS (SELECT lang, t, v, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY lang) AS n FROM cells GROUP BY lang, t, v),
q AS (SELECT lang, t, (1 + 1000000000::HUGEINT * (c + 2) // (n + 2 * v))::BIGINT AS q FROM whole),
met AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN met ON (met.lang, met.source, met.item) = (a.lang, a.source, b.source)),
terms AS (
  SELECT lang, source, 'term' AS part, t AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q USING (lang, t) WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (FROM pairs UNION ALL FROM terms))
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
)
def op12_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence of every two sources of a language, and the terms that stand out in each source."""
    return source_audit.audit(table(spark, folder, "documents"))
