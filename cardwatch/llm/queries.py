"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardwatch.llm import decontaminate, exactdup, linedup, longmatch, merkle, mixing, neardup, prefixtrie, quality, secretscan, sharding, toxicity, warc
from cardwatch.llm.store import table
from cardwatch.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_ngram_jaccard_join(spark, sf):
    return neardup.components_of(table(spark, sf, "documents"), k=4, percent=85)


@query
def op2_warc_capture_index(spark, sf):
    records = warc.round_trip(table(spark, sf, "pages"), scratch_path(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op2_warc_capture_index"] = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
         CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= {warc.LEAST} THEN min(page_id) OVER (PARTITION BY payload_digest)
            ELSE page_id END AS first_id
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


@query
def op3_line_dedup(spark, sf):
    return linedup.remove_boilerplate(table(spark, sf, "documents"))


SQL["op3_line_dedup"] = rf"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS place
  FROM documents
), spread AS (
  SELECT line FROM lines WHERE trim(line) <> '' GROUP BY line 
  HAVING count(DISTINCT source) >= (SELECT greatest(2, least({linedup.MOST_SITES}, ceil(count(DISTINCT source) / 2))) FROM documents)
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE line IN (SELECT line FROM spread)) AS n_removed,
         string_agg(line, chr(10) ORDER BY place) FILTER (WHERE line NOT IN (SELECT line FROM spread)) AS text
  FROM lines GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)
"""


@query
def op4_toxicity_noisy_or(spark, sf):
    return toxicity.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op5_rendezvous_sharding(spark, sf):
    return sharding.assign(table(spark, sf, "documents"), [1.0] * 16)


@query
def op6_pivotal_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


@query
def op7_exact_dedup(spark, sf):
    return exactdup.refine(table(spark, sf, "documents"), digest_all=True)


SQL["op7_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents
), g AS (
  SELECT doc_id, sha256(plain) AS text_sha256, count(*) OVER w AS group_size,
         first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id) AS keep_id
  FROM n WINDOW w AS (PARTITION BY plain)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


@query
def op8_run_length_index(spark, sf):
    return longmatch.remove_repeats(table(spark, sf, "documents")).drop("kept")


@query
def op9_quality_trees(spark, sf):
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_simhash_decontamination(spark, sf):
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def tampered_by_id() -> tuple[Column, Column]:
    """Which rows are tampered with, and what text they then have: rows without id never are."""
    chosen = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    return F.coalesce(chosen, F.lit(False)), F.translate("text", string.ascii_uppercase, string.ascii_lowercase)


@query
def op11_merkle_manifest(spark, sf):
    found = merkle.manifest(table(spark, sf, "documents"), *tampered_by_id())
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
        F.size("copied").cast("long").alias("n_copied"),
    )


@query
def op12_secret_scan(spark, sf):
    return secretscan.secrets(table(spark, sf, "documents"))


@query
def op13_conversation_prefix_trie(spark, sf):
    return prefixtrie.trie(table(spark, sf, "conversations")).drop("prefix")


#: CRC-32 of a number's decimal text, byte by byte with the reflected polynomial.
CRC32 = """
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries
)"""


def crc32_sql(digits: str) -> str:
    codes = f"list_transform(string_split({digits}, ''), lambda d: CAST(ascii(d) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, entries[1 + (xor(c, b) & 255)])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {step}), 4294967295)"


SQL["op13_conversation_prefix_trie"] = f"""
WITH {CRC32}, t AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         sha256(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT conv_id, digest, octet_length(encode(text)) AS bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS place
  FROM t
), names AS (
  SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS shared
  FROM (SELECT DISTINCT conv_id FROM t), crc_table
), parts AS (
  SELECT n.conv_id, 0 AS part, place, digest, bytes
  FROM names n JOIN turns t ON t.conv_id = n.conv_id - n.conv_id % 5 AND place < shared
  UNION ALL
  SELECT n.conv_id, 1, place, digest, bytes FROM names n JOIN turns t ON t.conv_id = n.conv_id AND place >= shared
), prefixes AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS bytes FROM names
  UNION ALL
  SELECT conv_id, row_number() OVER w, string_agg(digest, '') OVER w, bytes
  FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
), spans AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ended FROM prefixes
), nodes AS (
  SELECT path, depth, count(*) AS n_convs, min(conv_id) AS conv_id, (count(*) - 1) * any_value(bytes) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM spans GROUP BY path, depth
), above AS (
  SELECT c.path, p.path AS parent, p.conv_id AS parent_conv_id
  FROM nodes c JOIN nodes p ON c.depth = p.depth + 1 AND starts_with(c.path, p.path)
), childless AS (
  SELECT n.path, count(a.path) AS n_children FROM nodes n LEFT JOIN above a ON a.parent = n.path GROUP BY n.path
), subtrees AS (
  SELECT v.path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(s.saved) AS BIGINT) AS saved_tokens
  FROM nodes v JOIN nodes s ON s.depth >= v.depth AND starts_with(s.path, v.path) JOIN childless c ON c.path = s.path
  GROUP BY v.path
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM nodes JOIN childless USING (path) JOIN subtrees USING (path) LEFT JOIN above USING (path)
"""
