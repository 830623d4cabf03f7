import zlib
from collections import defaultdict

import numpy as np

from furiframe.llm.sharding import jump_hash, shard_documents

from .edge import edge_docs, edge_texts, empty_docs


def scalar_jump(key: int, shards: int) -> int:
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_matches_the_scalar_definition_and_moves_only_into_the_new_shard():
    keys = np.concatenate([np.arange(3000, dtype=np.int64), np.array([-1, -5, 2**62, -(2**63)])])
    before = None
    for n in (1, 2, 8, 9, 64):
        got = jump_hash(keys.view(np.uint64), n)
        assert got.tolist() == [scalar_jump(int(k), n) for k in keys]
        if before is not None:
            moved = got != before[1]
            assert (got[moved] >= before[0]).all()
        before = (n, got)
    eight, nine = jump_hash(keys.view(np.uint64), 8), jump_hash(keys.view(np.uint64), 9)
    assert set(nine[eight != nine].tolist()) == {8} and 0.07 < (eight != nine).mean() < 0.16


def test_edge_rows_get_gapless_slots(spark):
    rows = shard_documents(edge_docs(spark), 8).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in edge_texts())
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.shard == scalar_jump(r.doc_id or 0, 8) and r.grown_shard == scalar_jump(r.doc_id or 0, 9) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_hot_id_and_empty_table(spark):
    hot = spark.createDataFrame([(3, "same")] * 500 + [(i, str(i)) for i in range(100)], "doc_id long, text string").repartition(7)
    rows = shard_documents(hot, 4).collect()
    own = [r.slot for r in rows if r.shard == scalar_jump(3, 4)]
    assert sorted(own) == list(range(len(own))) and len(rows) == 600
    assert shard_documents(empty_docs(spark)).collect() == []


def test_string_ids(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z"), ("a", "x")], "doc_id string, text string")
    rows = shard_documents(docs, 5).collect()
    assert len(rows) == 4 and len({r.shard for r in rows if r.doc_id == "a"}) == 1
