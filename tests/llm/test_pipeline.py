"""Stages of the corpus pipeline, each on what its predecessor kept, against brute force."""

from collections import defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from furiframe.llm.simhash import fingerprint

from .edge import edge_docs, edge_texts, empty_docs
from .test_line_dedup import brute as brute_lines
from .test_packing import check as check_packing
from .test_simhash import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "line_dedup", "near_dedup", "packing"]
    assert all(s.columns == steps[0].columns and s.schema == steps[0].schema for s in steps[1:5])


def test_filters_only_drop_rows_and_keep_good_ones(spark, steps):
    docs, spoken, good = (dict(texts(s)) for s in steps[:3])
    assert set(good.items()) <= set(spoken.items()) <= set(docs.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(i in good for i, q in labels.items() if q == 1 and i in docs)
    assert sum(i in good for i, q in labels.items() if q == 0) <= 0.3 * sum(q == 0 for q in labels.values())


def test_line_dedup_near_dedup_and_packing(steps):
    _, _, good, lines, near, packed = steps
    assert sorted((str(i), t) for i, t in texts(lines)) == [(i, t) for i, t, _, _ in brute_lines(texts(good), 10, keep="first")]
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    groups = defaultdict(list)
    for i, root in brute_components({i: fingerprint(t, 3) for i, t in texts(lines)}, 3).items():
        groups[root].append(i)
    assert [i for i, _ in texts(near)] == sorted(min(g) for g in groups.values())
    check_packing(packed.collect(), texts(near), 2048)


def test_run_gives_the_last_stage(spark, steps):
    key = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(steps[-1])


def test_edge_rows_pass_every_stage(spark):
    docs = edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES[2:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == edge_docs(spark).columns
    for _, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, edge_docs(spark), SF)
        assert kept.columns == docs.columns and kept.count() <= len(edge_texts())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
    assert public_tokenizers.path("word_bpe_49k.json")


def test_empty_table_passes_every_stage(spark):
    docs = empty_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_copied_texts_outlive_line_dedup(spark):
    lines = [f"line {k} of the copied text, number {k * k}" for k in range(20)]
    copy, own = "\n".join(lines), " ".join(f"word{i}" for i in range(40))
    near = ["\n".join([*lines[:k], f"changed in copy {k}", *lines[k + 1:]]) for k in range(12)]
    rows = [(i, copy) for i in range(12)] + [(100 + i, t) for i, t in enumerate(near)]
    rows += [(200 + i, f"All rights reserved\n{own} {i}") for i in range(12)] + [(300 + i, f"Nothing but boilerplate\n{i % 2}") for i in range(10)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.line_dedup(spark, docs, SF)
    want = {i: "" for i in range(12)} | {100 + i: f"changed in copy {i}" for i in range(12)}
    want |= {200 + i: f"{own} {i}" for i in range(12)} | {300 + i: str(i % 2) for i in range(10)}
    want |= {0: copy, 200: rows[24][1], 300: rows[36][1]}
    assert dict(texts(out)) == want
    assert all(r.n_chars == len(r.text) for r in out.collect())
    kept = [t for _, t in texts(corpus_pipeline.near_dedup(spark, out, SF))]
    assert kept.count(copy) == 1 and kept.count("") == 1


def test_texts_in_no_learnt_language_go_and_those_in_two_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r["lang"]: r["text"] for r in docs.where("length(text) > 2000").orderBy("doc_id").collect()}
    two = found["en"][:1500] + "\n" + found["de"][:1500]
    planted = {-1: "Это обычный текст на языке, которого нет в таблицах. " * 40, -2: "これは表にない言語で書かれた普通の文章です。" * 40,
               -3: two, -4: two + "\nЭто цитата."}
    rows = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in planted.items()], docs.schema)
    out = {i for i, _ in texts(corpus_pipeline.language_id(spark, docs.unionByName(rows), SF))}
    assert out & planted.keys() == {-3, -4}


def test_without_a_language_model_only_letterless_texts_go(spark):
    rows = [(1, "some words"), (2, "Слова"), (3, "123 !"), (4, ""), (5, None), (None, "a")]
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id long, text string, lang string")
    out = corpus_pipeline.language_id(spark, docs, SF)
    assert out.schema == docs.schema and {r.text for r in out.collect()} == {"some words", "Слова", "a"}
