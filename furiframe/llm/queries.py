"""Registered queries of this subpackage, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furiframe.llm.bpe import encode_documents, load_ranks
from furiframe.llm.common import text_batches
from furiframe.llm.exact_dedup import exact_dedup
from furiframe.llm.langid import fit_language_id, predict_language
from furiframe.llm.lexical_search import ranked_search
from furiframe.llm.line_dedup import dedup_lines
from furiframe.llm.packing import pack_documents
from furiframe.llm.prefix_trie import prefix_trie
from furiframe.llm.quality_model import fit_quality, score_quality
from furiframe.llm.quality_rules import quality_rules
from furiframe.llm.sharding import shard_documents
from furiframe.llm.simhash import simhash_dedup
from furiframe.llm.toxicity import fit_toxicity, score_toxicity
from furiframe.llm.winnowing import edited_fingerprints


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), shards=8)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model, threshold=0.3)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir), min_docs=10, min_chars=1, keep="none")
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    tokens = encode_documents(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, decoded=True)
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(documents(spark, sf_dir), shingle=3, bits=3).select("doc_id", "fingerprint", "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), host_limit=0.5, host_floor=0.2, host_multiple=3.0, prior_rows=200.0)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict_language(docs, fit_language_id(docs))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_quality(docs, fit_quality(docs), threshold=0.5)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), family=20, heads=4, container_turns=4096)


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir), k=5, window=8)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)


# Jump hashing, iterated by a recursive CTE in 128-bit integers modulo 2^64; CRC-32
# (polynomial 0xEDB88320, reflected) folded over the UTF-8 bytes with a derived table.
_CRC_TABLE = """
crc_bits AS (
  SELECT range AS i, range::BIGINT AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc_bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
          regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda a, b: xor(a // 256, t[(xor(a, b) & 255) + 1])), 4294967295)"""


_OP1 = f"""
WITH RECURSIVE {_CRC_TABLE},
jump AS (
  SELECT doc_id, n, ((coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616) AS k,
         -1::BIGINT AS b, 0::BIGINT AS j
  FROM (SELECT DISTINCT doc_id FROM documents), (VALUES (8), (9)) s(n)
  UNION ALL
  SELECT doc_id, n, k2, j,
         floor((j + 1) * (2147483648::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM jump WHERE j < n)
), shards AS (
  SELECT doc_id, max(b) FILTER (n = 8)::INT AS shard, max(b) FILTER (n = 9)::INT AS grown_shard
  FROM jump WHERE j >= n GROUP BY doc_id
), sized AS (
  SELECT doc_id, (coalesce(strlen(text), 0) + 1)::BIGINT AS size,
    {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, crc_table
)
SELECT d.doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM sized d JOIN shards s ON d.doc_id IS NOT DISTINCT FROM s.doc_id
"""

_LINES = """
lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
)"""

_OP3 = f"""
WITH {_LINES}, common AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k
GROUP BY doc_id
"""

_OP10 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

# Word counts as in the rules; the host verdict repeats the moment fit of the beta prior.
_OP7 = """
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows), range(3) r(k)
  WHERE n > 1 GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), counts AS (
  SELECT doc_id, source, len(w) AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), rules AS (
  SELECT *, unnest([{'r': 1, 'f': n_words < 50}, {'r': 2, 'f': 100 * n_repeat_words > 50 * n_words},
                    {'r': 3, 'f': 10 * n_symbols > n_words}, {'r': 4, 'f': 100 * n_dup_lines > 30 * n_lines}], recursive := true)
  FROM counts WHERE source IS NOT NULL
), hosts AS (
  SELECT source, r, count(*) AS n, count(*) FILTER (f) AS k FROM rules GROUP BY ALL
), others AS (
  SELECT h.source, h.r, h.n, h.k, coalesce(avg(o.k / o.n), any_value(h.k / h.n)) AS m, avg(o.k * o.k / (o.n * o.n)) AS q, avg(1 / o.n) AS inv
  FROM hosts h LEFT JOIN hosts o ON o.r = h.r AND o.source <> h.source GROUP BY ALL
), prior AS (
  SELECT source, n, k, m, least(greatest(m * (1 - m) / greatest(coalesce(q - m * m - m * (1 - m) * inv, 0), 1e-6) - 1, 1.0), 200.0) AS s FROM others
), shrunk AS (
  SELECT source, n, m, s, (k + m * s) / (n + s) AS mean FROM prior
), bad AS (
  SELECT DISTINCT source FROM shrunk
  WHERE mean - 2 * sqrt(mean * (1 - mean) / (n + s + 1)) > least(0.5, greatest(0.2, 3 * m))
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       bad.source IS NOT NULL AS host_rejected,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND bad.source IS NULL AS kept
FROM counts LEFT JOIN bad USING (source)
"""

# A node is the path of the digests of its turns; a path is a prefix of those of its subtree.
_OP11 = f"""
WITH RECURSIVE {_CRC_TABLE}, t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, n, {_crc32("conv_id::VARCHAR")} % 4 AS h
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY 1), crc_table
), rebuilt AS (
  SELECT c.conv_id, t.p AS d, k, w FROM convs c JOIN t ON t.conv_id = c.base AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, t.p - c.h + least(c.h, coalesce(b.n, 0)), k, w
  FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.p > c.h LEFT JOIN convs b ON b.conv_id = c.base
), paths AS (
  SELECT conv_id, d, w, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(w) AS own,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = last), '') AS ends
  FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM paths) GROUP BY path, d
), children AS (
  SELECT left(path, 32 * (d - 1)::INT) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), sums AS (
  SELECT left(path, 32 * up::INT) AS path, sum(own) AS saved, count(*) FILTER (NOT has) AS leaves
  FROM (SELECT nodes.path, own, children.path IS NOT NULL AS has, unnest(range(0, d + 1)) AS up FROM nodes LEFT JOIN children USING (path))
  GROUP BY 1
)
SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n_convs, coalesce(c.n, 0) AS n_children,
       s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM nodes a JOIN sums s USING (path) LEFT JOIN children c USING (path)
LEFT JOIN nodes b ON a.d > 0 AND b.path = left(a.path, 32 * (a.d - 1)::INT)
"""

_OP13 = """
WITH terms AS (
  SELECT d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
  FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)
), counted AS (
  SELECT d, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), sized AS (
  SELECT d, sum(tf)::BIGINT AS n FROM counted GROUP BY d
), corpus AS (
  SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM sized
), weighted AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, corpus GROUP BY term, nd
), asked AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)
), scored AS (
  SELECT i, item_id, d, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weighted USING (term) JOIN sized USING (d), corpus
  GROUP BY ALL
)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_packing": op4_packing,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_simhash": op6_simhash,
    "op7_quality_rules": op7_quality_rules,
    "op8_language_id": op8_language_id,
    "op9_quality_model": op9_quality_model,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_winnowing": op12_winnowing,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES = {"op1_sharding": _OP1, "op3_line_dedup": _OP3, "op7_quality_rules": _OP7, "op10_exact_dedup": _OP10, "op11_prefix_trie": _OP11, "op13_lexical_search": _OP13}
