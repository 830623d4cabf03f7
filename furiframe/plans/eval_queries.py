"""Registered queries: recognition scoring over segments of ``documents``.

Truth = the whole sentences of every document. Recognised transcripts are
derived deterministically from the truth, standing in for model output:
a vowel rotation, a two-character cut, or an exact copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furiframe.operators import evaluate as ev
from furiframe.operators import segment as seg
from furiframe.plans import sqltext as S
from furiframe.plans.tables import table

DELIM = "."
KEYS = ["doc_id", "seq"]

# Three recognition runs over the same files: (model, temperature, corruption).
RUNS = (("ocr:s", 0.1, "rotate"), ("ocr:m", 0.8, "cut"), ("ocr:l", 0.1, "copy"))


def truth_segments(spark, sf_dir) -> DataFrame:
    return seg.segment_sentences(table(spark, sf_dir, "documents"), "doc_id", "text", DELIM)


def _corrupt(kind: str, text: F.Column) -> F.Column:
    if kind == "rotate":
        return F.translate(text, "aeo", "eoa")
    if kind == "cut":
        return F.left(text, F.length(text) - 2)
    return text


def recognized_single(truth: DataFrame) -> DataFrame:
    """One run: the corruption is chosen by ``doc_id % 3``."""
    m = F.pmod(F.col("doc_id"), F.lit(3))
    t = F.col("text")
    hyp = F.when(m == 0, _corrupt("rotate", t)).when(m == 1, _corrupt("cut", t)).otherwise(t)
    return truth.select(*KEYS, hyp.alias("text"))


def recognized_runs(truth: DataFrame) -> DataFrame:
    """Transcript table of several runs ``(model, temperature, doc_id, seq, text)``,
    produced from one scan (an explode over the runs, not a union of scans)."""
    runs = F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(temp).cast("double").alias("temperature"),
                 _corrupt(kind, F.col("text")).alias("text"))
        for model, temp, kind in RUNS])
    ex = truth.select(*KEYS, F.explode(runs).alias("_r"))
    return ex.select("_r.model", "_r.temperature", *KEYS, "_r.text")


def q_eval_cer(spark, sf_dir):
    truth = truth_segments(spark, sf_dir)
    return ev.score_pairs(truth, recognized_single(truth), KEYS, ordered=True)


def _scores(spark, sf_dir):
    truth = truth_segments(spark, sf_dir)
    return ev.score_pairs(truth, recognized_single(truth), KEYS)


def q_eval_summary(spark, sf_dir):
    return ev.eval_summary(_scores(spark, sf_dir)).select("n_files", "cer_macro", "accuracy")


def q_eval_micro(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.agg(F.sum("edits").alias("edits"), F.sum("ref_len").alias("ref_len"),
                 F.round(F.sum("edits") / F.sum("ref_len"), 6).alias("cer_micro"))


def q_eval_by_run(spark, sf_dir):
    truth = truth_segments(spark, sf_dir)
    scores = ev.score_pairs(truth, recognized_runs(truth), KEYS, extra_cols=["model", "temperature"])
    return ev.eval_summary(scores, ["model", "temperature"])


def q_eval_report(spark, sf_dir):
    s = _scores(spark, sf_dir).withColumn(
        "name", F.concat_ws("_", F.col("doc_id").cast("string"), F.col("seq").cast("string")))
    s = s.withColumn("name", F.concat("name", F.lit(".md")))
    return ev.eval_report(s, "name")


def q_run_slug(spark, sf_dir):
    runs = recognized_runs(truth_segments(spark, sf_dir))
    return (runs.groupBy("model", "temperature")
            .agg(F.count(F.lit(1)).alias("n_files"))
            .select("model", "temperature", ev.run_slug("model", "temperature").alias("run_dir"), "n_files"))


QUERIES = {
    "eval_cer": q_eval_cer,
    "eval_summary": q_eval_summary,
    "eval_micro": q_eval_micro,
    "eval_by_run": q_eval_by_run,
    "eval_report": q_eval_report,
    "run_slug": q_run_slug,
}

_SEG = S.segments(DELIM)
_REC_SINGLE = f"""
    SELECT doc_id, seq,
           CASE (doc_id % 3 + 3) % 3 WHEN 0 THEN translate(text, 'aeo', 'eoa')
                WHEN 1 THEN left(text, greatest(length(text) - 2, 0)) ELSE text END AS text
    FROM ({_SEG})"""
_RUNS = f"""
    SELECT 'ocr:s' AS model, CAST(0.1 AS DOUBLE) AS temperature, doc_id, seq, translate(text, 'aeo', 'eoa') AS text FROM ({_SEG})
    UNION ALL
    SELECT 'ocr:m', CAST(0.8 AS DOUBLE), doc_id, seq, left(text, greatest(length(text) - 2, 0)) FROM ({_SEG})
    UNION ALL
    SELECT 'ocr:l', CAST(0.1 AS DOUBLE), doc_id, seq, text FROM ({_SEG})"""

_PAIRS_SINGLE = f"""
    SELECT g.doc_id, g.seq, {S.normalize('g.text')} AS t, {S.normalize('r.text')} AS h
    FROM ({_SEG}) g JOIN ({_REC_SINGLE}) r ON g.doc_id = r.doc_id AND g.seq = r.seq"""
_SCORES = S.score_pairs(_PAIRS_SINGLE, "doc_id, seq")

_PAIRS_RUNS = f"""
    SELECT r.model, r.temperature, g.doc_id, g.seq, {S.normalize('g.text')} AS t, {S.normalize('r.text')} AS h
    FROM ({_SEG}) g JOIN ({_RUNS}) r ON g.doc_id = r.doc_id AND g.seq = r.seq"""
_SCORES_RUNS = S.score_pairs(_PAIRS_RUNS, "model, temperature, doc_id, seq")

ORACLES = {
    "eval_cer": _SCORES,
    "eval_summary": f"""
        SELECT count(*) AS n_files, round(avg(cer), 6) AS cer_macro, round(1.0 - avg(cer), 6) AS accuracy
        FROM ({_SCORES})""",
    "eval_micro": f"""
        SELECT CAST(sum(edits) AS BIGINT) AS edits, CAST(sum(ref_len) AS BIGINT) AS ref_len,
               round(CAST(sum(edits) AS DOUBLE) / CAST(sum(ref_len) AS DOUBLE), 6) AS cer_micro
        FROM ({_SCORES})""",
    "eval_by_run": f"""
        SELECT model, temperature, count(*) AS n_files, round(avg(cer), 6) AS cer_macro,
               round(1.0 - avg(cer), 6) AS accuracy,
               round(CAST(sum(edits) AS DOUBLE) / CAST(sum(ref_len) AS DOUBLE), 6) AS cer_micro
        FROM ({_SCORES_RUNS}) GROUP BY model, temperature""",
    "eval_report": f"""
        WITH s AS ({_SCORES}), m AS (SELECT avg(cer) AS m FROM s),
        parts AS (
          SELECT 0 AS section, NULL AS name, 'Filename' AS a, 'Character Error Rate (CER)' AS b
          UNION ALL SELECT 1, CAST(doc_id AS VARCHAR) || '_' || CAST(seq AS VARCHAR) || '.md',
                           CAST(doc_id AS VARCHAR) || '_' || CAST(seq AS VARCHAR) || '.md',
                           printf('%.2f%%', round_even(cer * 100.0, 2)) FROM s
          UNION ALL SELECT 2, NULL, 'Average CER:', printf('%.2f%%', round_even(m * 100.0, 2)) FROM m
          UNION ALL SELECT 3, NULL, 'Overall Accuracy:', printf('%.2f%%', round_even((1 - m) * 100.0, 2)) FROM m)
        SELECT section, name, rpad(a, CAST(greatest(30, length(a)) AS INTEGER), ' ') || ' | ' ||
                              lpad(b, CAST(greatest(20, length(b)) AS INTEGER), ' ') AS line
        FROM parts""",
    "run_slug": f"""
        SELECT model, temperature, replace(model, ':', '_') || '_t' || CAST(temperature AS VARCHAR) AS run_dir,
               count(*) AS n_files
        FROM ({_RUNS}) GROUP BY model, temperature""",
}
