import random
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from furiframe.llm import simhash
from furiframe.llm.simhash import components, fingerprint, fingerprint_links, keep_one, mix, simhash_dedup, spanning_links

from .edge import edge_docs, edge_texts, empty_docs


def brute_fingerprint(text, k):
    words, word = [], ""
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] if word else words, ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    words += [word] if word else []
    if not words:
        return 0
    grams = [" ".join(words[i: i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    keys = sorted(prints)
    up = {k: k for k in keys}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    x = np.array([prints[k] for k in keys], np.uint64)
    for i, k in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= bits):
            a, b = root(k), root(keys[j])
            up[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def near_prints(n, seed):
    """Random fingerprints with chains, dense balls and pairs at 3 and 4 bits."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for i in range(0, n, 3):
        x = out[rng.randrange(n)]
        for b in rng.sample(range(64), rng.randrange(1, 6)):
            x ^= 1 << b
        out.append(x)
    chain = rng.getrandbits(64)
    for _ in range(60):
        for b in rng.sample(range(64), 3):
            chain ^= 1 << b
        out.append(chain)
    centre = rng.getrandbits(64)
    out += [centre ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(300)]
    low = rng.getrandbits(32)
    return out + [low | rng.getrandbits(32) << 32 for _ in range(400)]  # alike in one half


def test_fingerprints_match_the_definition():
    for _, t in edge_texts():
        if t is not None and len(t) < 5000:
            for k in (1, 3, 5):
                assert fingerprint(t, k) == brute_fingerprint(t, k)


def test_xxh64_is_sparks(spark):
    row = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t").alias("h")).first()
    assert row.h % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_local_search_loses_no_link():
    x = np.unique(np.array(near_prints(1500, 1), np.uint64))
    want = brute_components(dict(enumerate(x.tolist())), 3)
    for metrics in simhash.link_metrics(3):
        own = spanning_links(x, np.empty(0, np.uint64), 3, [metrics[1]])  # the whole fingerprint alone must find all
        at = {v: i for i, v in enumerate(x.tolist())}
        got = {i: i for i in range(len(x))} | {at[a]: at[b] for a, b in own.tolist()}
        assert got == want
        assert len(own) < len(x)


def test_distributed_search_and_components(spark):
    prints = dict(enumerate(near_prints(3000, 2)))
    rows = [(v - 2**64 if v >= 2**63 else v,) for v in set(prints.values())]
    nodes = spark.createDataFrame(rows, "fp long").repartition(6)
    links = fingerprint_links(nodes, 3, shard_rows=200)
    found = {r.node % 2**64: r.root % 2**64 for r in components(links).collect()}
    node = {k: int(mix(np.array([v], np.uint64))[0]) for k, v in prints.items()}
    want, got = defaultdict(set), defaultdict(set)
    for k, r in brute_components(prints, 3).items():
        want[r].add(k)
        got[found.get(node[k], node[k])].add(k)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_long_chain_and_star_of_links(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)]
    rows = components(spark.createDataFrame(chain, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in rows:
        groups[r.root].add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(301)), list(range(1000, 1301))]


def test_edge_rows(spark):
    rows = simhash_dedup(edge_docs(spark)).collect()
    source = edge_texts()
    prints = {n: brute_fingerprint(t or "", 3) for n, (_, t) in enumerate(source) if len(t or "") < 5000}
    # The two long texts are copies of each other and of nothing else.
    long = [n for n in range(len(source)) if n not in prints]
    prints |= {n: fingerprint(source[n][1], 3) for n in long}
    root = brute_components(prints, 3)
    lowest = defaultdict(list)
    for n, r in root.items():
        lowest[r] += [source[n][0]] if source[n][0] is not None else []
    want = sorted((str(source[n][0]), f"{prints[n]:016x}", str(min(lowest[r], default=None))) for n, r in root.items())
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want
    kept = keep_one(edge_docs(spark)).collect()
    assert len(kept) == len(lowest) and kept[0].row == "row"
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(min(v, default=None)) for v in lowest.values())


def test_empty_table(spark):
    assert simhash_dedup(empty_docs(spark)).collect() == [] and keep_one(empty_docs(spark)).collect() == []
