import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from furiframe.llm import lexical_search as L

from .edge import edge_docs, edge_texts, empty_docs


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_words = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 50 + (50 * n * n_docs) // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "the AND Über x1"), (2, "東京 of3 the5 same text"), (2, "one two"), (None, "naïve5 a b c"), (4, None), (5, ""), (6, "nothing holds qqqq"), (7, "the7 the7")]


@pytest.mark.parametrize("k,per_block,cells", [(50, 512, 8_000_000), (3, 2, 64)])
def test_matches_brute_force(spark, k, per_block, cells):
    items = spark.createDataFrame([(i, t, "extra") for i, t in ITEMS], "item_id long, text string, score string")
    got = L.ranked_search(edge_docs(spark), items, k=k, items_per_block=per_block, cells=cells)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(edge_texts(), ITEMS, k)


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert L.ranked_search(empty_docs(spark), items).count() == 0
    assert L.ranked_search(edge_docs(spark), items.where(F.lit(False))).count() == 0


def test_blocks_are_skipped_without_loss():
    """Documents on few topics: with a floor most blocks are not looked at, and the best are the same."""
    rng = random.Random(1)
    n_terms, n = 120, 1500
    scores = np.zeros((n, n_terms), np.int64)
    for d in range(n):
        topic = rng.randrange(12) * 10
        for t in rng.sample(range(topic, topic + 10), 6):
            scores[d, t] = rng.randrange(1, 1000)
    queries = [np.array(sorted(rng.sample(range(t * 10, t * 10 + 10), 4) + [rng.randrange(n_terms)])) for t in range(12)]
    queries = [np.unique(q) for q in queries]
    asked = L.asked_coordinates(queries)
    ids = np.arange(n)[::-1].copy()
    total = np.array([scores[:, q].sum(axis=1) for q in queries])
    floor = np.array([np.sort(t)[-20] for t in total])
    for q, rows, got in L.search_shard(ids, scores, queries, asked, floor, 20, 64):
        want = sorted(((-s, ids[d]) for d, s in enumerate(total[q]) if s >= floor[q]))[:20]
        assert sorted(zip(-got, ids[rows])) == want


def test_block_bounds_hold():
    rng = np.random.default_rng(0)
    scores = rng.integers(0, 50, (300, 20)) * rng.integers(0, 2, (300, 20))
    pivots = scores[::10].astype(np.float32)
    postings = np.flatnonzero(scores[:, 3])
    listed, starts = L.blocks_of(postings, scores.astype(np.float32) @ pivots[pivots[:, 3] > 0].T)
    assert sorted(listed) == list(postings) and len(starts) > 5
    summary = np.maximum.reduceat(scores[listed], starts, axis=0)
    for block, top in zip(np.split(listed, starts[1:]), summary):
        assert (scores[block] <= top).all()
