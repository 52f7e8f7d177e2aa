"""The registered queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from wheelpace.llm import contain, gear, golay, impact, langid, lines, lm, packing, quality, resample, trie, warc, winnow
from wheelpace.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contain.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprint_edits(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.with_language(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gear.repeated_spans(table(spark, sf_dir, "documents"), whole_texts=True).drop("text_hash")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.passage_report(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture_no")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay.near_groups(table(spark, sf_dir, "documents"))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact.top_rows(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_decontamination, op2_fingerprints, op3_language, op4_lm_scoring, op5_substring_dedup, op6_packing,
        op7_line_dedup, op8_warc, op9_quality, op10_simhash, op11_topk, op12_prefix_trie, op13_resampling)} | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    found = {"op1_decontamination": _CONTAINED, "op8_warc": _CAPTURES, "op11_topk": _BEST, "op12_prefix_trie": _TRIE,
             "op13_resampling": _DRAWN, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: sql for name, sql in found.items() if sql}


_CONTAINED = r"""
WITH item AS (
  SELECT min(item_id) AS item_id, count(*) AS n_items, w, least(len(w), 5) AS g
  FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark)
  WHERE len(w) > 0 GROUP BY w
), item_shingle AS (
  SELECT DISTINCT item_id, n_items, g, array_to_string(w[i:i + g - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - g + 2)) AS i FROM item)
), sized AS (SELECT item_id, count(*) AS item_shingles FROM item_shingle GROUP BY item_id
), doc AS (
  SELECT doc_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), doc_shingle AS (
  SELECT DISTINCT doc_id, text, g, array_to_string(w[i:i + g - 1], ' ') AS s
  FROM (SELECT doc_id, text, w, g, unnest(range(1, len(w) - g + 2)) AS i
        FROM doc CROSS JOIN (SELECT DISTINCT g FROM item) WHERE len(w) >= g)
), shared AS (
  SELECT doc_id, text, item_id, n_items, count(*) AS shared_shingles
  FROM doc_shingle JOIN item_shingle USING (g, s) GROUP BY ALL
)
SELECT doc_id, item_id, n_items, item_shingles, max(shared_shingles) AS shared_shingles,
       max(shared_shingles) / item_shingles AS containment
FROM shared JOIN sized USING (item_id)
WHERE shared_shingles >= 0.8 * item_shingles
GROUP BY doc_id, item_id, n_items, item_shingles
"""

_CAPTURES = r"""
WITH page AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest, coalesce(url, '') AS url FROM pages
), decided AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS largest FROM page
), keyed AS (
  SELECT *, payload_bytes >= 1000 AND page_id IS DISTINCT FROM largest AS again,
         array_to_string(list_reverse(string_split(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)),
                                                   '.')), ',')
         || ')' || lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1)) AS url_key
  FROM decided
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN largest END AS refers_to, url_key,
       row_number() OVER (ORDER BY encode(url_key), page_id) - 1 AS capture_no
FROM keyed
"""

_BEST = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(q.v, lambda x, i: x * c.v[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

#: crc32 of the bytes of ``x``, by the table of the remainders of all bytes in the list ``r`` of the row.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode({x}))),
             lambda i: ('0x' || substr(hex({x}), 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, r[xor(c & 255, b) + 1])))"""

#: The list ``r``: remainders by the reversed polynomial 0xEDB88320, 8 halvings for each byte.
_REMAINDERS = """crc AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, _:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY b) AS r
  FROM range(256) bytes(b)
)"""

_TRIE = f"""
WITH {_REMAINDERS}, turn AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS own FROM turn GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:h], c.own[h + 1:]) AS turns
  FROM (SELECT conv_id, own, {_CRC32.format(x="CAST(conv_id AS VARCHAR)")} % 9 AS h FROM conv, crc) c
  LEFT JOIN conv b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefix AS (
  SELECT conv_id, d AS depth, turns[1:d] AS p, d = len(turns) AS ends
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, count(*) FILTER (ends) AS n_ends,
         (count(*) - 1) * coalesce(strlen(p[depth].text), 0) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefix GROUP BY p, depth
), below AS (
  SELECT a.p, a.depth, count(*) FILTER (b.depth = a.depth + 1) AS n_children,
         count(*) FILTER (b.n_convs = b.n_ends) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens
  FROM (SELECT p, depth, unnest(list_transform(range(depth + 1), lambda d: {{'p': p[1:d], 'depth': d}})) AS a, n_convs, n_ends, saved
        FROM node) b JOIN node a ON a.p = b.a.p AND a.depth = b.a.depth
  GROUP BY a.p, a.depth
)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, w.n_children, w.n_leaves, w.saved_tokens, n.ends_sha256
FROM node n JOIN below w ON w.p = n.p AND w.depth = n.depth
LEFT JOIN node m ON n.depth > 0 AND m.depth = n.depth - 1 AND m.p = n.p[1:n.depth - 1]
"""

_DRAWN = rf"""
WITH {_REMAINDERS}, spoken AS (
  SELECT true AS target, NULL AS doc_id, text FROM benchmark UNION ALL SELECT false, doc_id, text FROM documents
), worded AS (
  SELECT target, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM spoken
), word AS (
  SELECT w, {_CRC32.format(x="w")} % 10000 AS bucket FROM (SELECT DISTINCT unnest(w) AS w FROM worded), crc
), met AS (
  SELECT target, doc_id, bucket FROM (SELECT target, doc_id, unnest(w) AS w FROM worded) JOIN word USING (w)
), total AS (
  SELECT count(*) FILTER (NOT target) AS s_all, count(*) FILTER (target) AS t_all FROM met
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(
           (CAST(count(*) FILTER (target) AS DOUBLE) + 1) * (any_value(s_all) + 10000)
           / ((CAST(count(*) FILTER (NOT target) AS DOUBLE) + 1) * (any_value(t_all) + 10000)))) AS BIGINT) AS gain
  FROM met, total GROUP BY bucket
), weighed AS (
  SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight
  FROM (SELECT doc_id, w FROM worded WHERE NOT target) LEFT JOIN (
    SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM met JOIN gain USING (bucket) WHERE NOT target GROUP BY doc_id
  ) USING (doc_id)
), scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln(
           (('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weighed
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
