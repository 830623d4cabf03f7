"""Registered queries: corpus scan, segmentation, budget, keys, sets, top-k.

Every query reads the driver tables under ``sf_dir`` whole; ``documents``
plays the landed corpus (delimiter '.', since it holds no Japanese text).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furiframe.functions import text as T
from furiframe.operators import evaluate as ev
from furiframe.operators import segment as seg
from furiframe.plans import sqltext as S
from furiframe.plans.tables import table
from furiframe.session import ensure_checkpoint_dir
from furiframe.streaming.segments import stream_segments

DELIM = "."


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def q_corpus_scan(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    return docs.select(F.col("doc_id").cast("string").alias("id"), "text",
                       F.length("text").cast("long").alias("n_chars"))


def q_segment_sentences(spark, sf_dir):
    return seg.segment_sentences(corpus(spark, sf_dir), "doc_id", "text", DELIM, max_chars=T.SEGMENT_MAX_CHARS)


def q_stream_segments(spark, sf_dir):
    """The documents as a file stream, read to its end; the segment table it wrote, under the shared checkpoint folder."""
    source = f"{sf_dir}/documents.parquet"
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(source).select("doc_id", "text").schema
    # The star also matches a table of one file; a stream reads folders or patterns.
    query = stream_segments(spark, source + "*", schema, f"{out}/segments", f"{out}/progress", "doc_id", "text", DELIM)
    query.awaitTermination()
    return spark.read.parquet(f"{out}/segments").select("doc_id", "seq", "text")


def q_segment_summary(spark, sf_dir):
    return seg.segment_summary(corpus(spark, sf_dir), "text", DELIM)


def q_segment_write_counts(spark, sf_dir):
    """The counts that the job writing the segment table (under the shared checkpoint folder) observed."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/segments-{uuid.uuid4().hex}"
    counts = seg.write_segments(corpus(spark, sf_dir), out, "doc_id", "text", DELIM)
    written = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("written"))
    return written.select(*[F.lit(n).cast("long").alias(c) for c, n in counts.items()], "written")


def q_char_budget(spark, sf_dir):
    return seg.char_budget(corpus(spark, sf_dir), "doc_id", "text", DELIM)


def q_fallback_key(spark, sf_dir):
    """Corpus ids exist only for labelled documents; the rest get
    ``unknown_id_<ordinal>``; keys are sliced ``[10:-1]`` for all (as the
    reference does, which also hits the fallback)."""
    docs = corpus(spark, sf_dir).select("doc_id")
    ids = table(spark, sf_dir, "labels").select(
        "doc_id", F.concat(F.lit("<urn:uuid:"), F.col("doc_id").cast("string"), F.lit(">")).alias("id"))
    withid = docs.join(ids, "doc_id", "left").withColumn("ordinal", F.col("doc_id") + 1)
    keyed = seg.fallback_ids(withid, "id", "ordinal", "entry_id")
    return keyed.select("doc_id", "entry_id", seg.segment_key("entry_id", F.lit(0)).alias("key"))


def q_slice_key(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", T.slice_key("url").alias("key"))


def q_upsert_latest(spark, sf_dir):
    docs = corpus(spark, sf_dir).select(F.md5("text").alias("text_key"), "doc_id", "source")
    return seg.upsert_latest(docs, ["text_key"], "doc_id")


def q_take_first(spark, sf_dir):
    docs = corpus(spark, sf_dir).select("doc_id", F.length("text").cast("long").alias("n_chars"))
    return seg.take_first(docs, 1010, ["doc_id"])


def q_sample_sorted(spark, sf_dir):
    names = corpus(spark, sf_dir).select(F.concat(F.col("doc_id").cast("string"), F.lit(".png")).alias("name"))
    return seg.take_first(names, 10, ["name"])


def q_common_keys(spark, sf_dir):
    return ev.common_keys(corpus(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id")


def q_unmatched_keys(spark, sf_dir):
    return ev.unmatched_keys(corpus(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id")


def q_stem_suffix(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        T.stem("url").alias("stem"),
        T.suffix("url").alias("suffix"),
        T.with_suffix(T.file_name("url"), ".md").alias("md_name"),
    )


def q_escape_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", T.escape_text("html").alias("escaped"))


def q_charset_filter(spark, sf_dir):
    """Analyzer input as the pipes see it: escaped, then only EUC-JP characters."""
    docs = corpus(spark, sf_dir)
    return docs.select("doc_id", T.charset_filter(T.escape_text("text"), "euc_jp").alias("analyzer_text"))


QUERIES = {
    "corpus_scan": q_corpus_scan,
    "charset_filter": q_charset_filter,
    "segment_sentences": q_segment_sentences,
    "stream_segments": q_stream_segments,
    "segment_summary": q_segment_summary,
    "segment_write_counts": q_segment_write_counts,
    "char_budget": q_char_budget,
    "fallback_key": q_fallback_key,
    "slice_key": q_slice_key,
    "upsert_latest": q_upsert_latest,
    "take_first": q_take_first,
    "sample_sorted": q_sample_sorted,
    "common_keys": q_common_keys,
    "unmatched_keys": q_unmatched_keys,
    "stem_suffix": q_stem_suffix,
    "escape_text": q_escape_text,
}

_PIECES = f"""
  SELECT doc_id, idx, {S.strip('part')} AS s
  FROM (SELECT doc_id,
               unnest(string_split(coalesce(text, ''), '{DELIM}')) AS part,
               generate_subscripts(string_split(coalesce(text, ''), '{DELIM}'), 1) AS idx
        FROM documents)
"""

_SUMMARY = f"""
        WITH n AS (
          SELECT d.doc_id, count(p.s) AS n
          FROM documents d LEFT JOIN ({_PIECES}) p ON p.doc_id = d.doc_id AND length(p.s) > 0
          GROUP BY d.doc_id)
        SELECT count(*) AS processed, count(*) FILTER (WHERE n > 0) AS with_segments,
               count(*) FILTER (WHERE n = 0) AS skipped, CAST(coalesce(sum(n), 0) AS BIGINT) AS segments
        FROM n"""

ORACLES = {
    "segment_write_counts": f"SELECT *, segments AS written FROM ({_SUMMARY})",
    "stream_segments": f"SELECT doc_id, seq, text FROM ({S.segments(DELIM)})",
    "corpus_scan": "SELECT CAST(doc_id AS VARCHAR) AS id, text, CAST(length(text) AS BIGINT) AS n_chars FROM documents",
    "segment_sentences": S.segments(DELIM, max_chars=100),
    "segment_summary": _SUMMARY,
    "char_budget": f"""
        SELECT doc_id, pos, phrase, n_chars, cum_chars FROM (
          SELECT doc_id,
                 CAST(row_number() OVER w - 1 AS BIGINT) AS pos,
                 s AS phrase,
                 CAST(length(s) AS BIGINT) AS n_chars,
                 CAST(sum(length(s)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_chars
          FROM ({_PIECES}) WHERE length(s) >= 2
          WINDOW w AS (PARTITION BY doc_id ORDER BY idx))
        WHERE cum_chars <= 2000""",
    "fallback_key": """
        SELECT d.doc_id, coalesce('<urn:uuid:' || CAST(l.doc_id AS VARCHAR) || '>',
                                  'unknown_id_' || CAST(d.doc_id + 1 AS VARCHAR)) AS entry_id,
               substr(entry_id, 11, greatest(length(entry_id) - 11, 0)) || '_0' AS key
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "slice_key": "SELECT page_id, substr(url, 11, greatest(length(url) - 11, 0)) AS key FROM pages",
    "upsert_latest": """
        SELECT md5(text) AS text_key, max(doc_id) AS doc_id, arg_max(source, doc_id) AS source
        FROM documents GROUP BY md5(text)""",
    "take_first": "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents ORDER BY doc_id LIMIT 1010",
    "sample_sorted": "SELECT CAST(doc_id AS VARCHAR) || '.png' AS name FROM documents ORDER BY name LIMIT 10",
    "common_keys": "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels",
    "unmatched_keys": "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
    "charset_filter": f"""
        WITH e AS (SELECT doc_id, regexp_replace(translate(text, chr(10) || chr(65374), ' ~'), '<br( /)?>', '<br>', 'g') AS t
                   FROM documents),
        ok AS MATERIALIZED (SELECT DISTINCT unnest(string_split({S.sql_lit(T.encodable('euc_jp'))}, '')) AS c),
        used AS (SELECT DISTINCT unnest(string_split(t, '')) AS c FROM e),
        bad AS (SELECT coalesce(string_agg(c, ''), '') AS drop_chars FROM used WHERE c NOT IN (SELECT c FROM ok))
        SELECT doc_id, translate(t, drop_chars, '') AS analyzer_text FROM e, bad""",
    "stem_suffix": r"""
        SELECT page_id,
               regexp_replace(url, '(.)\.[^.]+$', '\1') AS stem,
               regexp_extract(url, '.(\.[^.]+)$', 1) AS suffix,
               regexp_replace(regexp_extract(url, '[^/]*$', 0), '(.)\.[^.]+$', '\1') || '.md' AS md_name
        FROM pages""",
    "escape_text": """
        SELECT page_id, regexp_replace(translate(html, chr(10) || chr(65374), ' ~'), '<br( /)?>', '<br>', 'g') AS escaped
        FROM pages""",
}
