import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from furiframe.llm.line_dedup import _positions, dedup_lines, dropped_lines, keep_bitmaps

from .edge import CLASHING, edge_docs, edge_texts, empty_docs

SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(source, min_docs, min_chars=1, keep="none"):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    found = defaultdict(int)
    for _, t in source:
        for k in {key(x) for x in (t or "").split("\n")}:
            found[k] += len(k) >= min_chars
    gone = {k for k, n in found.items() if n >= min_docs}
    first = {}
    if keep == "first":
        for n, (i, t) in sorted(enumerate(source), key=lambda x: x[1][0]):
            for p, x in enumerate((t or "").split("\n")):
                first.setdefault(key(x), (n, p))
    out = []
    for n, (i, t) in enumerate(source):
        lines = (t or "").split("\n")
        stay = [x for p, x in enumerate(lines) if key(x) not in gone or first.get(key(x)) == (n, p)]
        out.append((str(i), "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out)


def rows_of(df):
    return sorted((str(r["row"]["doc_id"]), r.text, r.n_lines, r.n_dropped) for r in df.collect())


def test_edge_rows_keep_all_their_columns(spark):
    out = dedup_lines(edge_docs(spark), min_docs=10)
    assert rows_of(out) == brute(edge_texts(), 10)
    row = out.select("row.*").first()
    assert [row[c] for c in CLASHING] == CLASHING


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("min_docs,min_chars", [(2, 1), (3, 2), (12, 0), (1, 1)])
def test_random_lines(spark, keep, min_docs, min_chars):
    rng = random.Random(min_docs)
    pool = ["", "a", "A ", " b", "cc", "É", "é", "dd\t", "long common line"] + [f"rare {i}" for i in range(60)]
    source = [(i, "\n".join(rng.choice(pool[:9] if rng.random() < 0.5 else pool) for _ in range(rng.randrange(1, 12)))) for i in range(150)]
    docs = spark.createDataFrame(source, "doc_id long, text string").repartition(9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # runs cross batches as well as partitions
    try:
        assert rows_of(dedup_lines(docs, min_docs=min_docs, min_chars=min_chars, keep=keep)) == brute(source, min_docs, min_chars, keep)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_line_spreads_and_bitmap_reads_back(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("common\nown "), "id", F.lit("\nCommon")).alias("text"))
    maps = keep_bitmaps(docs, min_docs=10).collect()
    assert len(maps) == 600
    bits = {tuple(np.unpackbits(np.frombuffer(zlib.decompress(m.keep_bitmap), np.uint8), count=m.n_lines).tolist()) for m in maps}
    assert bits == {(0, 1, 0)}


def test_empty_table(spark):
    assert dedup_lines(empty_docs(spark)).collect() == []


def test_repeated_rows_are_held_once(spark):
    docs = spark.range(500).select(F.lit(None).cast("long").alias("_ff_id"), F.lit(1).cast("long").alias("_ff_t"),
                                   F.lit("a\nb\na\nc").alias("_ff_text"))
    row = _positions(dropped_lines(docs, 10, 1, "none")).collect()
    assert [(r.n_lines, sorted(r["_ff_lists"])) for r in row] == [(4, [[0, 2], [1], [3]])]
