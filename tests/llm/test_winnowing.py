import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from furiframe.llm import winnowing as W

from .edge import edge_docs, edge_texts, empty_docs

SPACE = "[ \t-\r]"


def brute_units(text):
    return [x for word in re.split(f"{SPACE}+", text or "") for x in re.findall("[฀-႟ក-៿⺀-꓏豈-﫿𠀀-𿿿]|[^฀-႟ក-៿⺀-꓏豈-﫿𠀀-𿿿]+", word)]


def gram_hash(words):
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), h)
    return (h >> 32) - (1 << 32 if h >> 63 else 0)


def brute(text, k, window):
    units = brute_units(text)
    if not units:
        return []
    grams = [gram_hash(units[i: i + k]) for i in range(max(1, len(units) - k + 1))]
    out = []
    for s in range(max(1, len(grams) - window + 1)):
        h, p = min((h, -i) for i, h in enumerate(grams[s: s + window], s))
        if not out or out[-1] != (h, -p):
            out.append((h, -p))
    return out


@pytest.mark.parametrize("k,window", [(5, 8), (2, 5), (1, 1), (3, 2)])
def test_chosen_grams(spark, k, window):
    texts = [t for _, t in edge_texts()] + ["a b a b a b a b a b a b", "漢字 kana かな abc漢x  q ", "x " * 40]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    for r in W.fingerprints(df, k=k, window=window).collect():
        assert [(g.hash, g.position) for g in r.grams] == brute(r.text, k, window), r.text


def brute_rows(rows, k, window):
    """Distinct (id, text) in descending id; ids that repeat are left to the caller."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, t), (j, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        a, b, c = ({h for h, _ in brute(x, k, window)} for x in (t, edited, u))
        like = [len(a & x) / len(a | x) if a | x else 1.0 for x in (b, c)]
        text = [" ".join(f"{h & 0xFFFFFFFF if h >= 0 else h & 0xFFFFFFFFFFFFFFFF:X}@{p}" for h, p in brute(x, k, window)) for x in (t, edited)]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), *text, *like, j)
    return out


def test_edited_fingerprints(spark):
    seen, rows = set(), []
    for i, t in edge_texts():
        if i is not None and i not in seen:
            seen.add(i)
            rows.append((i, t))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("grams", F.lit(1)).withColumn("copies", F.lit("x"))
    want = brute_rows(rows, 5, 8)
    got = {r.doc_id: tuple(r)[1:] for r in W.edited_fingerprints(df.repartition(4)).collect()}
    assert got == want


def test_edge_rows(spark):
    docs = edge_docs(spark)
    got = W.edited_fingerprints(docs).collect()
    assert len(got) == docs.count()
    assert len({(r.fingerprint, r.n_chars) for r in got if r.n_chars == 9 and r.doc_id in (None, 11)}) == 1
    repeated = [r for r in got if r.doc_id == 11 and r.n_chars == 9]
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    alone = W.edited_fingerprints(docs.where("doc_id = 14")).collect()
    assert [(r.next_id, r.near_next) for r in alone] == [(14, 1.0)]
    assert W.edited_fingerprints(empty_docs(spark)).count() == 0


def test_match_guarantee(spark):
    shared = " ".join(f"s{i}" for i in range(12))  # window + k - 1 words
    df = spark.createDataFrame([(1, "p q " * 30 + shared), (2, shared + " " + " ".join(f"z{i}" for i in range(77)))], "doc_id long, text string")
    a, b = ({g.hash for g in r.grams} for r in W.fingerprints(df).collect())
    assert a & b


def test_native_plan(spark):
    plan = W.edited_fingerprints(edge_docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions", plan)
