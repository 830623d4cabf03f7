"""SimHash near-duplicates: fingerprints, vantage-point trees and components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furiframe.llm.common import bounded_sample, frozen, shuffle_partitions, text_or_empty

SEED = 42
HOT = 256
_LOW, _HIGH = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, shingle: int) -> int:
    """64-bit SimHash of a whole text: A-Z lower-cased, words between ASCII white space, ``shingle``-word
    windows with repeats, XXH64 (seed 42); a bit is set when it is in over half of the hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, 1 << 16):
        s, e = starts[at: min(at + (1 << 16), n)].tolist(), ends[at + shingle - 1: at + shingle - 1 + (1 << 16)].tolist()
        h = np.array([digest(line[a:b], SEED) for a, b in zip(s, e)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers (the splitmix64 finaliser): node numbers in random order."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class VpNode:
    """Inside: masked distance to ``point`` at most ``radius``. ``reach``: how far a partner can be under ``mask``."""

    leaf: int = -1
    point: np.uint64 = np.uint64(0)
    mask: np.uint64 = _ALL
    radius: int = 0
    reach: int = 0
    inside: "VpNode | None" = None
    outside: "VpNode | None" = None


def build_tree(points: np.ndarray, leaf_size: int, metrics: list[tuple[np.uint64, int]], tries: int = 4) -> tuple[VpNode, int]:
    """Vantage-point tree over ``points``; (root, number of leaves).

    ``metrics``: masks with the distance that two partners can have under
    them, best first; a later one is used where the first can't split (points
    alike under it). Of ``tries`` vantage points the one that leaves the
    fewest points within reach of the boundary is taken.
    """
    leaves = 0

    def grow(own: np.ndarray, depth: int) -> VpNode:
        nonlocal leaves
        if len(own) > leaf_size and depth < 40:
            best = None
            for mask, reach in metrics:
                some = own if len(own) <= 4096 else own[:: len(own) // 4096]
                for p in own[np.linspace(0, len(own) - 1, tries).astype(int)]:
                    d = np.bitwise_count((some ^ p) & mask).astype(np.int64)
                    radius = int(np.median(d))
                    if radius == d.max():
                        radius -= 1
                    if radius < d.min():
                        continue
                    both = np.count_nonzero((d <= radius + reach) & (d > radius - reach))
                    larger = max(np.count_nonzero(d <= radius), np.count_nonzero(d > radius))
                    cost = (both + larger) / len(some)
                    if best is None or cost < best[0]:
                        best = cost, p, mask, radius, reach
                if best is not None and best[0] < 1.2:
                    break
            if best is not None and best[0] < 1.8:
                _, p, mask, radius, reach = best
                d = np.bitwise_count((own ^ p) & mask)
                a, b = own[d <= radius], own[d > radius]
                if len(a) and len(b):
                    return VpNode(-1, p, mask, radius, reach, grow(a, depth + 1), grow(b, depth + 1))
        leaves += 1
        return VpNode(leaves - 1)

    return grow(points, 0), leaves


def visit(root: VpNode, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, indexes, is it their own leaf) for all points that a leaf must see: its own ones, and those
    that the triangle inequality lets have a partner in it."""
    todo = [(root, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        node, at, own = todo.pop()
        if not len(at):
            continue
        if node.leaf >= 0:
            yield node.leaf, at, own
            continue
        d = np.bitwise_count((points[at] ^ node.point) & node.mask).astype(np.int64)
        near = d <= node.radius
        a, b = d <= node.radius + node.reach, d > node.radius - node.reach
        todo.append((node.inside, at[a], own[a] & near[a]))
        todo.append((node.outside, at[b], own[b] & ~near[b]))


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union the components of i[k] and j[k]; ``label`` holds each node's root."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, up := label[label]):
            label[:] = up


def spanning_links(own: np.ndarray, seen: np.ndarray, bits: int, metrics: list[tuple[np.uint64, int]]) -> np.ndarray:
    """Links (point, root) that connect what pairs of an own and a seen point within ``bits`` connect.

    At most one link a point, however many pairs a dense group has. A local
    tree prunes; its leaves are compared in full, in pieces of bounded size.
    """
    points = np.unique(np.concatenate([own, seen]))
    label = np.arange(len(points))
    root, leaves = build_tree(own, 128, metrics)
    members: list[np.ndarray] = [np.empty(0, np.int64)] * leaves
    for leaf, at, mine in visit(root, own):
        members[leaf] = at[mine]
    where = np.searchsorted(points, own)
    for leaf, at, _ in visit(root, points):
        mine = members[leaf]
        for k in range(0, len(mine), 1024):
            some = mine[k: k + 1024]
            step = max(1, (1 << 20) // len(some))
            for s in range(0, len(at), step):
                q = at[s: s + step]
                r, c = np.nonzero(np.bitwise_count(points[q][:, None] ^ own[some][None, :]) <= bits)
                _merge(label, q[r], where[some[c]])
    moved = np.flatnonzero(label != np.arange(len(label)))
    return np.stack([points[moved], points[label[moved]]], axis=1) if len(moved) else np.empty((0, 2), np.uint64)


def link_metrics(bits: int) -> list[list[tuple[np.uint64, int]]]:
    """One forest per 32-bit half: of ``bits`` differing bits, one half has at most bits // 2. Where a
    half can't split (its values are alike), the whole fingerprint does, at the full distance."""
    return [[(half, bits // 2), (_ALL, bits)] for half in (_LOW, _HIGH)]


def fingerprint_links(nodes: DataFrame, bits: int, shard_rows: int = 30_000, sample_a_shard: int = 64,
                      max_sample: int = 262_144) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``bits`` of each other; ``nodes`` has distinct ``fp``.

    The top of each tree is built on the driver from a bounded sample (a
    fixed hash order, at most ``max_sample`` fingerprints); every fingerprint
    is sent to its own leaf (shard) and to those shards whose boundary its
    ball overlaps. A shard searches its own part exactly.
    """
    shards = max(1, -(-nodes.count() // shard_rows))
    take = min(max_sample, sample_a_shard * shards)
    sample = np.array(sorted(r["fp"] for r in bounded_sample(nodes.select("fp"), F.col("fp"), take).collect()), np.int64).view(np.uint64)
    leaf_size = max(1, -(-len(sample) // shards))
    forests = [build_tree(sample, leaf_size, m)[0] for m in link_metrics(bits)]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy().view(np.uint64)
            for f, root in enumerate(forests):
                for leaf, at, own in visit(root, x):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), leaf * len(forests) + f, np.int64)),
                        pa.array(x[at].view(np.int64)), pa.array(own)], ["shard", "fp", "own"])

    def search(group: pa.Table) -> pa.Table:
        x = group.column("fp").to_numpy().view(np.uint64)
        own = group.column("own").to_numpy().astype(bool)
        metrics = link_metrics(bits)[group.column("shard")[0].as_py() % len(forests)]
        links = spanning_links(x[own], x[~own], bits, metrics) if own.any() else np.empty((0, 2), np.uint64)
        return pa.table({"a": pa.array(mix(links[:, 0]).view(np.int64)), "b": pa.array(mix(links[:, 1]).view(np.int64))})

    return (nodes.select("fp").mapInArrow(send, "shard long, fp long, own boolean")
            .groupBy("shard").applyInArrow(search, "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, by contraction.

    Each round joins every node to the first of its neighbours and itself, in
    the order of a hash, and replaces links by those between the joined
    nodes, without loops and repeats. That order is as good as random, so a
    round removes a fixed share of the nodes, long chains included. Every
    round is checkpointed; only whether links are left comes to the driver.
    """
    def place(c: str) -> Column:
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))

    left = frozen(links.where("a <> b").distinct())
    maps: list[DataFrame] = []
    while left.limit(1).count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = frozen(both.groupBy("a").agg(F.min(place("b")).alias("m")).select(
            F.col("a").alias("node"), F.least(place("a"), F.col("m"))["n"].alias("up")))
        maps.append(up)
        a = up.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        b = up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        left = frozen(left.join(a, "a").join(b, "b").where("ua <> ub").select(
            F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct())
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0]
    for up in maps[1:]:
        nxt = up.select(F.col("node").alias("up"), F.col("up").alias("nxt"))
        out = out.join(nxt, "up", "left").select("node", F.coalesce("nxt", "up").alias("up"))
    return out.select("node", F.col("up").alias("root"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id, kept) of every row.

    Fingerprints link at ``bits`` or fewer differing bits; ``component_id`` is
    the smallest id reachable over links (null only if all of its ids are).
    Texts without words (null, empty) have fingerprint zero and link like any
    other; texts shorter than a shingle hash their whole word sequence.
    ``kept`` marks a component's first row, by smallest id, null ids last,
    then smallest ``text_hash`` (rows equal in both share the mark; see
    :func:`keep_one`). Repeated rows link as equal fingerprints. An empty
    table gives an empty result; other columns are not read.

    Equal fingerprints are merged by a partial aggregate first, so a group of
    exact copies costs one node; the components of the most frequent ones are
    broadcast back to the rows, those of the others are joined by a shuffle.
    """
    id_type = docs.schema[id_col].dataType

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fp.view(np.int64)), pa.array(mix(fp).view(np.int64))],
                ["doc_id", "text_hash", "fp", "node"])

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("text_hash", T.LongType()),
                           T.StructField("fp", T.LongType()), T.StructField("node", T.LongType())])
    text = text_or_empty(text_col)
    rows = frozen(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("_ff_text"))
                  .mapInArrow(prints, schema))
    # The first row of a group: smallest id (null ids last), then smallest text hash.
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = frozen(rows.groupBy("node", "fp").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n")))
    parts = shuffle_partitions(docs.sparkSession)
    found = frozen(components(fingerprint_links(nodes.select("fp").repartition(parts, "fp"), bits)))
    linked = nodes.join(found, "node").select("node", "root", "first")
    lowest = linked.groupBy("root").agg(F.min("first").alias("_ff_first"))
    named = linked.join(lowest, "root").select("node", "_ff_first")
    whole = nodes.join(named, "node", "left").select("node", "n", F.coalesce("_ff_first", "first").alias("_ff_first"))
    # Fingerprints of one row in HOT or more: at most HOT of them, a proven bound. Their rows don't shuffle.
    whole = frozen(whole)
    is_hot = F.col("n") * HOT >= rows.count()
    hot, cold = (whole.where(c).select("node", "_ff_first") for c in (is_hot, ~is_hot))
    spread = rows.join(F.broadcast(hot), "node", "left")
    named_rows = spread.where(F.col("_ff_first").isNotNull()).unionByName(
        spread.where(F.col("_ff_first").isNull()).drop("_ff_first").join(cold, "node"))
    return named_rows.select(
        "doc_id", "text_hash", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("_ff_first.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("_ff_first.doc_id")) & (F.col("text_hash") == F.col("_ff_first.text_hash"))).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3) -> DataFrame:
    """The rows of ``docs``, whole, that :func:`simhash_dedup` keeps: one of each group.

    Rows alike in id (null ids among them) and text are one document: one row
    of them stays, any one if they differ in other columns.
    """
    kept = (simhash_dedup(docs, id_col, text_col, shingle, bits).where("kept")
            .select(F.col("doc_id").alias("_ff_id"), F.col("text_hash").alias("_ff_kept")).distinct())
    rows = docs.withColumns({"_ff_hash": F.xxhash64(text_or_empty(text_col))})
    one = rows.join(kept, F.col(id_col).eqNullSafe(F.col("_ff_id")) & (F.col("_ff_hash") == F.col("_ff_kept")), "left_semi")
    return one.dropDuplicates([id_col, "_ff_hash"]).drop("_ff_hash")
