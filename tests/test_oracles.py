"""Every registered query vs. its DuckDB oracle on sf0.001 (the driver's gate, small)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from furiframe.plans import registry
from furiframe.plans.tables import TABLES
from tools.oracle_check import rows_of

from .conftest import SF001

NAMES = sorted(registry.all_queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert sorted(registry.all_oracles()) == NAMES and set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, srows) == rows_of(rel.columns, drows)


def test_entry_smoke(spark):
    out = E.entry(spark)
    rows = out.collect()
    assert out.columns == ["n_files", "cer_macro", "accuracy"] and len(rows) == 1


def test_charset_filter_against_python(spark):
    import pandas as pd

    got = {r["doc_id"]: r["analyzer_text"] for r in E.queries()["charset_filter"](spark, SF001).collect()}
    docs = pd.read_parquet(os.path.join(SF001, "documents.parquet"))
    for doc_id, text in zip(docs["doc_id"], docs["text"]):
        esc = text.replace("\n", " ").replace("\uff5e", "~")
        import re
        esc = re.sub("<br( /)?>", "<br>", esc)
        assert got[doc_id] == esc.encode("euc_jp", "ignore").decode("euc_jp")


def test_every_arm_of_the_main_operation_has_rows(spark):
    from pyspark.sql import functions as F

    from furiframe.functions.text import NUMERALS
    from furiframe.operators import annotate as A
    from furiframe.plans import annotate_queries as Q
    from furiframe.plans.tables import table

    docs = table(spark, SF001, "documents").select("doc_id", Q.to_japanese(F.col("text")).alias("text"))
    phrases = A.document_phrases(docs, "doc_id", "text").where(F.col("text").isNotNull())
    toks = A.lexicon_tokenize(phrases, ["doc_id", "phrase"], Q.jp_lexicon(spark, SF001), "text")
    marked = A.annotate_tokens(toks, ["doc_id", "phrase", "pos"], Q.jp_char_readings(spark, SF001))
    s, r, m, e = (F.col(c) for c in ("surface", "reading", "markup", "error"))
    spans = F.size(F.regexp_extract_all("markup", F.lit(r"\[[^]]*\]"), F.lit(0)))
    row = marked.agg(
        F.count_if(r.isNull()).alias("no_entry"),
        F.count_if(r == "").alias("no_reading"),
        F.count_if((s == r) & (F.length(s) > 1)).alias("reading_is_the_surface"),
        F.count_if((s != r) & (s == A.kana_fold(r))).alias("kana_already"),
        F.count_if(F.lit(NUMERALS).contains(s) & (F.length(r) > 0)).alias("numeral"),
        F.count_if(s.startswith("2") & (F.length(r) > 0) & (m == s)).alias("digit_first"),
        F.count_if(F.rlike(m, F.lit(r"^[^\[]+\["))).alias("prefix"),
        F.count_if(F.rlike(m, F.lit(r"\}[^\[]+$"))).alias("suffix"),
        F.count_if((spans > 1) & (F.length(s) != F.length(r))).alias("split_by_candidates"),
        F.count_if((spans > 1) & (F.length(s) == F.length(r))).alias("one_kana_a_character"),
        F.count_if((spans == 1) & r.startswith("ゾ")).alias("no_candidate_fits"),
        F.count_if(e == "reading exhausted in prefix").alias("exhausted_prefix"),
        F.count_if(e.isNotNull()).alias("errors"),
        F.count_if(F.rlike(m, F.lit(r"\[[^\]]{2,}\]"))).alias("rest_as_one"),
    ).first().asDict()
    assert [k for k, n in row.items() if n == 0] == []


@pytest.mark.parametrize("name", ["annotate_tokens", "ruby_markup"])
def test_annotation_scans_documents_once_and_runs_no_job_while_built(spark, capsys, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "building a query")
    before = len(tracker.getJobIdsForGroup("build"))
    df = E.queries()[name](spark, SF001)
    jobs = tracker.getJobIdsForGroup("build")[before:]
    df.explain()
    plan = capsys.readouterr().out
    assert plan.count("sf0.001/documents.parquet") == 1
    assert len(jobs) <= 2  # reading the Parquet schemas only
