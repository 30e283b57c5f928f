"""The ``opN_<name>`` queries: thin digests of the operators' results over the
whole ``documents`` and ``pages`` tables, at production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html_extract, langid, lexical_search, line_dedup, merkle, pii, quality_rules, simhash, token_counts, toxicity, warc
from .common import crc_bucket, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def keep(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return keep


@_query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query("op2_pii_weak_supervision")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read_table(spark, sf_dir, "documents"))


@_query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), limit=4096)


@_query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


@_query("op5_bpe_encode_decode")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read_table(spark, sf_dir, "documents"))


@_query("op6_html_extraction")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(read_table(spark, sf_dir, "pages"))


# The hit positions of each document word, window lengths taken from the items.
_OP7_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[k : k + least(len(w), 13) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS k FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT r, n, k, array_to_string(w[k : k + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM doc_words, sizes WHERE len(w) >= n)),
found AS (SELECT g.r, g.n, g.k, x.item_id FROM grams g JOIN windows x ON g.phrase = x.phrase AND g.n = x.n),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS p FROM found) GROUP BY r),
listed AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hits USING (r) LEFT JOIN listed USING (r)
"""


@_query("op7_benchmark_decontamination", _OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


@_query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


# Base32 of the SHA-1: each five hexadecimal digits are four letters.
_OP9_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_page FROM pages),
letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS a)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
  list_reduce([
    substr(a, 1 + CAST((v >> 15) & 31 AS INT), 1) || substr(a, 1 + CAST((v >> 10) & 31 AS INT), 1) ||
    substr(a, 1 + CAST((v >> 5) & 31 AS INT), 1) || substr(a, 1 + CAST(v & 31 AS INT), 1)
    FOR v IN [CAST('0x' || substr(h, 1 + 5 * k, 5) AS BIGINT) FOR k IN range(8)]], lambda x, y : x || y) AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first_page THEN NULL ELSE first_page END AS refers_to
FROM p, letters
"""


@_query("op9_warc_round_trip", _OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"), min_revisit_bytes=0)


@_query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


# Whole-number scores; a document's terms are counted from its text.
_OP11_SQL = r"""
WITH item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
doc_terms AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM doc_terms WHERE len(t) > 0),
counts AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS term FROM doc_terms) GROUP BY r, term),
wanted AS (SELECT * FROM counts SEMI JOIN item_terms USING (term)),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM wanted, totals GROUP BY term, docs),
parts AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * CAST(len(t) AS BIGINT) * docs) // total))) AS part
  FROM wanted JOIN weights USING (term) JOIN doc_terms USING (r), totals),
scored AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts JOIN item_terms USING (term) GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


@_query("op11_ranked_lexical_search", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), top=50)


_OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS k FROM d),
keyed AS (
  SELECT r, k, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
told AS (
  SELECT r, count(*) AS n_lines, count(s.key) AS n_dropped, string_agg(line, chr(10) ORDER BY k) FILTER (WHERE s.key IS NULL) AS kept
  FROM keyed LEFT JOIN shared s ON s.key = keyed.key GROUP BY r)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d JOIN told USING (r)
"""


@_query("op12_line_dedup", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(read_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


# The tree level by level in one recursion; siblings as '<' (before) or '>'
# (after) and the digest, or '=' where a run has one node.  crc32 by its table.
_OP13_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b : list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
         lambda c, z : CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
rows_in AS (
  SELECT doc_id, lang, CASE WHEN doc_id IS NULL THEN '-' ELSE octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id END
      || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
    n_chars, coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail,
    CASE WHEN doc_id IS NULL THEN false ELSE xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d : CAST(ascii(d) AS BIGINT))),
      lambda c, b : xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0 END AS changed
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN changed THEN sha256(head || coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS other
  FROM rows_in),
placed AS (
  SELECT *, coalesce('=' || lang, '-') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM leaves),
low(g, lvl, idx, n, node) AS (
  SELECT g, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT a.g, a.lvl + 1, a.idx // 2, (a.n + 1) // 2, sha256(a.node || coalesce(b.node, ''))
  FROM low a LEFT JOIN low b ON a.g = b.g AND a.lvl = b.lvl AND b.idx = a.idx + 1 WHERE a.n > 1 AND a.idx % 2 = 0),
subs AS (
  SELECT g, lvl AS height, node AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, idx, n, node) AS (
  SELECT 0, pos, n, subroot FROM subs
  UNION ALL
  SELECT a.lvl + 1, a.idx // 2, (a.n + 1) // 2, sha256(a.node || coalesce(b.node, ''))
  FROM high a LEFT JOIN high b ON a.lvl = b.lvl AND b.idx = a.idx + 1 WHERE a.n > 1 AND a.idx % 2 = 0),
steps AS (
  SELECT p.g, p.pos, l.lvl, CASE WHEN s.node IS NULL THEN '=' WHEN s.idx > l.idx THEN '>' || s.node ELSE '<' || s.node END AS step
  FROM placed p JOIN low l ON l.g = p.g AND l.idx = p.pos >> l.lvl AND l.n > 1
  LEFT JOIN low s ON s.g = l.g AND s.lvl = l.lvl AND s.idx = xor(l.idx, 1)
  UNION ALL
  SELECT p.g, p.pos, q.height + l.lvl, CASE WHEN s.node IS NULL THEN '=' WHEN s.idx > l.idx THEN '>' || s.node ELSE '<' || s.node END
  FROM placed p JOIN subs q ON q.g = p.g JOIN high l ON l.idx = q.pos >> l.lvl AND l.n > 1
  LEFT JOIN high s ON s.lvl = l.lvl AND s.idx = xor(l.idx, 1)),
paths AS (SELECT g, pos, list(step ORDER BY lvl) AS path FROM steps GROUP BY g, pos),
told AS (
  SELECT doc_id, leaf, subroot, (SELECT node FROM high WHERE n = 1) AS root,
    sha256(coalesce(array_to_string(list_transform(path, lambda s : s[2:]), ''), '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(other, leaf), coalesce(path, [])), lambda a, s : CASE s[1] WHEN '<' THEN sha256(s[2:] || a) ELSE sha256(a || s[2:]) END) AS folded_root
  FROM placed JOIN subs USING (g) LEFT JOIN paths ON paths.g = placed.g AND paths.pos = placed.pos)
SELECT *, folded_root = root AS verified FROM told
"""


@_query("op13_merkle_manifest", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(read_table(spark, sf_dir, "documents"), tampered=crc_bucket("doc_id", 7) == 0)
