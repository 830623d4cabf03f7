import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from furiframe.llm.exact_dedup import exact_dedup, frequent_digests

from .edge import edge_docs, edge_texts, empty_docs


def check(rows, source):
    groups = defaultdict(list)
    for i, t in source:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    got = defaultdict(list)
    for r in rows:
        got[r.text_sha256].append(r)
    assert set(got) == set(groups)
    for k, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        assert sorted(str(r.doc_id) for r in got[k]) == sorted(map(str, ids))
        assert {(r.keep_id, r.group_size) for r in got[k]} == {(best, len(ids))}
        assert [r.doc_id for r in got[k] if r.kept] == [best]


def test_edge_rows(spark):
    check(exact_dedup(edge_docs(spark)).collect(), edge_texts())


def test_all_rows_through_either_way(spark):
    source = [(i, f"text {i % 3}" if i % 2 else f"text {i}") for i in range(400)]
    docs = spark.createDataFrame(source, "doc_id long, text string").repartition(6)
    for counters in (1, 3, 1000):
        check(exact_dedup(docs, counters=counters).collect(), source)


def test_misra_gries_finds_what_is_frequent(spark):
    rows = spark.createDataFrame([(f"h{i % 3}" if i % 2 else f"r{i}",) for i in range(3000)], "d string").repartition(7)
    digests = rows.select(F.col("d").cast("binary").alias("d"))
    got = {bytes(r.d) for r in frequent_digests(digests, "d", 16).collect()}
    assert {b"h0", b"h1", b"h2"} <= got and len(got) <= 16


def test_empty_table(spark):
    assert exact_dedup(empty_docs(spark)).collect() == []
