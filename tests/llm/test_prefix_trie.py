import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from furiframe.llm.prefix_trie import prefix_trie, sweep

SCHEMA = "conv_id long, turn long, role string, text string, depth string, rep string, level string"


def fixture():
    rng = random.Random(3)
    rows = []
    texts = ["hello there", "x", "", None, "  a  b\tc ", "long " * 3000, "\x1c y", "東京 に"]

    def conv(c, turns):
        rows.extend((c, t, role, text, "d", "r", "l") for t, (role, text) in enumerate(turns))

    common = [("user", "the one first turn"), ("assistant", "same answer"), ("user", "again")]
    for c in range(0, 140):
        conv(c, (common if c % 3 else []) + [(rng.choice(["user", "assistant", None, ""]), rng.choice(texts)) for _ in range(rng.randrange(0, 6))])
    for c in range(200, 260):  # exact copies
        conv(c, common + [("user", "copy"), ("user", "copy")])
    conv(300, [("user", f"turn {i}") for i in range(90)])  # one long chain, and one that leaves it late
    conv(301, [("user", f"turn {i}") for i in range(70)] + [("user", "other")])
    conv(407, [("user", "one turn only")])  # its family's first is absent
    conv(-7, [("user", "negative")])
    rows += [(None, 0, "user", "no conversation", "d", "r", "l"), (500, None, "user", "null first", "d", "r", "l"), (500, 0, "user", "then", "d", "r", "l")]
    rows += [(501, 3, "user", "repeated", "d", "r", "l")] * 2
    rng.shuffle(rows)
    return rows


def brute(rows, family=20, heads=4):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    seqs = {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in seqs.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        built[c] = tuple(seqs.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len([w for w in p[-1][1].translate({i: " " for i in range(9, 14)}).split(" ") if w]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * words
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))).encode()).hexdigest())
                  for p, m in list(members.items()))


@pytest.mark.parametrize("bound", [8, 4096])
def test_matches_brute_force(spark, bound):
    rows = fixture()
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(6), container_turns=bound)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_conversation_spread_over_partitions(spark):
    rows = [(1, i, "user", f"t {i % 7}", "", "", "") for i in range(400)] + [(2, i, "user", f"t {i % 7}", "", "", "") for i in range(390)]
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(8), family=1, heads=2, container_turns=16)
    assert sorted(map(tuple, got.collect())) == brute(rows, 1, 2)


def test_no_conversations(spark):
    df = spark.createDataFrame([(None, 0, "user", "x", "", "", "")], SCHEMA)
    assert prefix_trie(df).count() == 0
    assert prefix_trie(df.where(F.lit(False))).count() == 0


def test_sweep_sums():
    a, b = (1, 1), (2, 2)
    nodes = sweep([([a, b], [3, 4], 5, 2), ([a], [3], 9, 1), ([b], [7], 1, 1)], 1)
    assert [n[:8] for n in nodes] == [[1, 0, -1, 4, 2, 2, 10, None], [5, 1, 0, 3, 1, 1, 10, 9], [5, 2, 1, 2, 0, 1, 4, 5], [1, 1, 0, 1, 0, 1, 0, 1]]
