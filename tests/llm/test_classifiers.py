"""Held-out quality of the three classifiers, and their edge rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from furiframe.llm import langid, quality_model, toxicity

from .edge import edge_docs, edge_texts, empty_docs

SF = "/root/testdata/sf0.01"
INSULTS = ("idiot", "scum", "moron", "loser")


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def auc(y, score):
    rank = pd.Series(score).rank().to_numpy()
    n1 = int((y == 1).sum())
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_label_model_counts_correlated_voters_once():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.1
    own = y[:, None] & (rng.random((4000, 6)) < 0.4)
    noise = (rng.random((4000, 1)) < 0.02) & ~y[:, None]
    votes = np.column_stack([own, own[:, :1], own[:, :1], noise])
    q = toxicity.label_model(votes)
    assert q[own.any(axis=1)].min() > 0.8 and q[~votes.any(axis=1)].max() < 0.1


def test_toxicity_held_out(spark, tables):
    docs, labels = tables
    model = toxicity.fit_toxicity(docs, labels)
    out = toxicity.score_toxicity(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    hit = out.predicted.to_numpy() == 1
    assert auc(out.toxic.to_numpy(), out.score.to_numpy()) > 0.75 and (out.toxic[hit] == 1).mean() > 0.9
    # What held-out labels say changes nothing.
    other = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit_toxicity(docs, other) == model


def test_toxicity_edge_rows(spark, tables):
    docs, labels = tables
    model = toxicity.fit_toxicity(docs, labels)
    rows = toxicity.score_toxicity(edge_docs(spark), model).collect()
    assert len(rows) == len(edge_texts()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert toxicity.score_toxicity(empty_docs(spark), model).collect() == []
    none = toxicity.fit_toxicity(empty_docs(spark), labels)
    text = " ".join(["fine words"] * 50)
    some = spark.createDataFrame([(1, f"{text} you {INSULTS[0]} {text}"), (2, text), (3, None)], "doc_id long, text string")
    assert [r.predicted for r in toxicity.score_toxicity(some, none).orderBy("doc_id").collect()] == [1, 0, 0]


def test_language_held_out(spark, tables):
    docs, _ = tables
    model = langid.fit_language_id(docs)
    out = langid.predict_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()
    rows = langid.predict_language(edge_docs(spark), model).collect()
    by_text = dict(zip(map(str, [i for i, _ in edge_texts()]), [t for _, t in edge_texts()]))
    assert len(rows) == len(edge_texts())
    for r in rows:
        if r.doc_id is not None and r.doc_id != 11:
            letters = any(c.isalpha() for c in by_text[str(r.doc_id)] or "")
            assert (r.lang_pred == "und") == (not letters) and (r.score > 0) == letters
    assert langid.predict_language(empty_docs(spark), model).collect() == []
    assert langid.fit_language_id(empty_docs(spark)) is None
    assert {r.lang_pred for r in langid.predict_language(edge_docs(spark), None).collect()} == {"und"}


def test_table_scorer_is_the_convolution():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (5, langid.WINDOW), dtype=np.uint8)
    model = langid.train_cnn(x, np.array([0, 1, 0, 1, 1]), ["a", "b"], steps=3)
    e = model.embed[x]
    pooled = []
    for w, f, b in zip(langid.WIDTHS, model.filters, model.shift):
        h = sum(e[:, j: langid.WINDOW - w + 1 + j] @ f[j] for j in range(w))
        pooled.append(np.maximum(h.max(axis=1) + b, 0))
    want = langid._softmax(np.concatenate(pooled, axis=1) @ model.dense + model.dense_shift)
    assert np.allclose(langid._Scorer(model)(x), want, atol=1e-5)


def test_quality_against_labels_it_never_saw(spark, tables):
    docs, labels = tables
    model = quality_model.fit_quality(docs)
    out = quality_model.score_quality(docs, model).join(labels, "doc_id").toPandas()
    assert auc(out.quality.to_numpy(), out.score.to_numpy()) > 0.95
    assert out.kept[out.quality == 1].mean() > 0.99 and out.kept[out.quality == 0].mean() < 0.2
    rows = quality_model.score_quality(edge_docs(spark), model).collect()
    assert len(rows) == len(edge_texts()) and all(0 <= r.score <= 1 for r in rows)
    empty = quality_model.fit_quality(empty_docs(spark))
    assert quality_model.score_quality(empty_docs(spark), empty).collect() == []


def test_em_finds_the_accuracies_of_noisy_labellers():
    rng = np.random.default_rng(2)
    n, k = 20000, quality_model.N_LABELLERS
    good = rng.random(n) < 0.85
    miss = rng.uniform(0.3, 0.7, k)
    bad_vote = np.where(good[:, None], rng.random((n, k)) < 0.01, rng.random((n, k)) < miss)
    votes = np.where(bad_vote, -1, 1)
    patterns = np.array([quality_model.pattern_of(v) for v in votes])
    counts = dict(zip(*(a.tolist() for a in np.unique(patterns, return_counts=True))))
    posterior, table = quality_model.fit_label_model(counts)
    q = np.array([posterior[p] for p in patterns.tolist()])
    assert ((q > 0.5) == good).mean() > 0.99 and np.abs(table[:, 0, 0] - miss).max() < 0.15


def test_repeated_ids_do_not_grow_the_samples(spark, monkeypatch):
    """One sampled id on 5,000 rows: no fit collects more rows than its bound (times windows)."""
    from pyspark.sql.classic.dataframe import DataFrame

    most = []
    collect = DataFrame.collect

    def counted(self):
        rows = collect(self)
        most.append(len(rows))
        return rows

    base = spark.range(60).select((F.col("id") * 4).alias("doc_id"), F.concat(F.lit("some words here idiot number "), F.col("id").cast("string")).alias("text"))
    again = spark.range(5000).select(F.lit(8).cast("long").alias("doc_id"), F.concat(F.lit("row "), F.col("id").cast("string"), F.lit(" of one id")).alias("text"))
    docs = base.unionByName(again).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    labels = base.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 8 == 0).cast("int").alias("toxic"))
    monkeypatch.setattr(DataFrame, "collect", counted)
    toxicity.fit_toxicity(docs, labels, fit_rows=70, max_tokens=50)
    langid.fit_language_id(docs, fit_rows=70, windows_a_row=2)
    quality_model.fit_quality(docs, fit_rows=70)
    assert max(most) < 5000


def test_scores_recomputed_row_by_row(spark):
    texts = ["You idiot!!! stupidity", "plain words here", "", "idiot " * 300, "Bonjour le monde " * 40, "x" * 700 + " é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weights = {"idiot": 2.0, "p4:stup": 1.0, "~shout": 0.5, "plain": -1.5}
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, toxicity.ToxicityModel(weights, -0.7)).collect()}
    hits = [("idiot", "p4:stup", "~shout"), ("plain",), (), ("idiot",), (), ()]
    for i, names in enumerate(hits):
        assert got[i] == pytest.approx(1 / (1 + np.exp(0.7 - sum(weights[n] for n in names))))

    rng = np.random.default_rng(3)
    model = quality_model.QualityModel(rng.normal(size=quality_model.BUCKETS).astype(np.float32), 0.3, np.zeros((0, 3, 2)))
    got = {r.doc_id: r.score for r in quality_model.score_quality(docs, model).collect()}
    for i, t in enumerate(texts):
        _, at, value = quality_model.describe(t)
        z = 0.3 + sum(float(model.weights[a]) * float(v) for a, v in zip(at, value))
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)

    w = langid.WINDOW
    cnn = langid.train_cnn(rng.integers(32, 122, (8, w), dtype=np.uint8), np.array([0, 1] * 4), ["a", "b"], steps=3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict_language(docs, cnn).collect()}
    for i, t in enumerate(texts):
        raw = t.encode()
        total = np.zeros(2)
        for at in range(0, len(raw), w):
            part = raw[at: at + w]
            total += len(part) * langid._Scorer(cnn)(np.frombuffer(part.ljust(w, b"\0"), np.uint8)[None])[0]
        if raw:
            assert got[i][0] == "ab"[total.argmax()] and got[i][1] == pytest.approx(total.max() / total.sum(), abs=1e-4)
        else:
            assert got[i] == ("und", 0.0)
