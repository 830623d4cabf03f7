"""Conversation prefix trie, built as a burst trie.

Conversations that share their first turns share trie nodes. Distinct turn
sequences are suffixes in containers under trie heads, one container (the
root's) at first. A container with more turns than a bound bursts: its head
becomes a node and its suffixes move to one container for each next turn id
(a round of Spark jobs bursts up to ``_LEVELS`` turns deep).
Containers within the bound are sorted and swept into nodes by one task each;
a container of a single suffix is a chain of nodes and needs no task of its
own, however long. Sums over subtrees go up the suffixes' paths, each node
counted by its smallest conversation.

Sequences that occur in many conversations are one suffix with a count, found
by a range sort of narrow rows, so a hot sequence spreads over tasks; a
conversation of any length spreads by turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furiframe.llm.common import frozen, shuffle_partitions, text_or_empty, with_columns

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_CHUNK = 4096
_LEVELS = 64
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, end_id long"


def numbered(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, t1, t2, w`` -> with ``p`` (place in the conversation from 1) and ``upto`` (words up to and with it).

    Rows are range-sorted, so a conversation of any length spreads over
    partitions; each partition numbers its own runs, and only runs that
    continue one of an earlier partition (at most one a partition) need an offset.
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen, words = None, 0, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            conv = b.column(b.schema.get_field_index("conv_id")).to_numpy()
            w = b.column(b.schema.get_field_index("w")).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
            lengths = np.diff(np.append(starts, n))
            total = np.cumsum(w)
            p = np.arange(n) - np.repeat(starts, lengths) + 1
            upto = total - np.repeat(total[starts] - w[starts], lengths)
            if last is not None and conv[0] == last:
                p[: lengths[0]] += seen
                upto[: lengths[0]] += words
            last, seen, words = conv[-1], int(p[-1]), int(upto[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p), pa.array(upto)], [*b.schema.names, "p", "upto"])

    order = ["conv_id", "turn", "t1", "t2"]
    dealt = turns.repartitionByRange(shuffle_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("part", F.spark_partition_id())
    runs = frozen(dealt.mapInArrow(number, with_columns(dealt.schema, ("p", T.LongType()), ("upto", T.LongType()))))
    sizes = runs.groupBy("conv_id", "part").agg(F.max("p").alias("n"), F.max("upto").alias("words"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "part", F.sum("n").over(before).alias("n0"), F.sum("words").over(before).alias("w0")).where("n0 is not null")
    return runs.join(F.broadcast(offsets), ["conv_id", "part"], "left").select(
        "conv_id", "t1", "t2", "w", (F.col("p") + F.coalesce("n0", F.lit(0))).alias("p"),
        (F.col("upto") + F.coalesce("w0", F.lit(0))).alias("upto"))


def rebuilt_turns(turns: DataFrame, family: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Rebuild every conversation c: the first h turns of conversation c - c % family, then c's own after its first h;
    h is crc32(decimal c) % heads.

    Returns ``(rows, convs)``: rows ``conv_id, d, t1, t2, w, rest`` (place from
    1, turn id, words, words from this turn to the end) and convs
    ``conv_id, n_turns`` with all conversations, also turnless ones.
    """
    own = frozen(numbered(turns))
    first = [F.max(F.when(F.col("p") == i, F.struct("t1", "t2", "w"))).alias(f"f{i}") for i in range(1, heads)]
    convs = own.groupBy("conv_id").agg(F.max("p").alias("n_own"), F.max("upto").alias("words"), *first)
    convs = convs.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)))
    base = convs.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"), *[F.col(f"f{i}").alias(f"b{i}") for i in range(1, heads)])
    plan = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(base, "base", "left")

    def words_of(name: str, upto: str) -> F.Column:
        return sum((F.when(F.col(upto) >= i, F.coalesce(F.col(f"{name}{i}.w"), F.lit(0))).otherwise(0) for i in range(1, heads)), F.lit(0).cast("long"))

    plan = plan.withColumn("nb", F.least(F.col("h"), F.coalesce("n_base", F.lit(0))))
    plan = frozen(plan.select(
        "conv_id", "h", "nb", "words", *[f"b{i}" for i in range(1, heads)], words_of("b", "nb").alias("base_words"),
        (F.col("words") - words_of("f", "h")).alias("own_words"), (F.col("nb") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n_turns")))
    taken = plan.select("conv_id", "nb", "base_words", "own_words", F.posexplode(F.array(*[f"b{i}" for i in range(1, heads)])).alias("i", "x")).where("i < nb") \
        if heads > 1 else None
    after = own.where(F.col("p") > F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)))
    rows = after.join(plan.select("conv_id", "h", "nb", "words"), "conv_id").select(
        "conv_id", (F.col("p") - F.col("h") + F.col("nb")).alias("d"), "t1", "t2", "w", (F.col("words") - F.col("upto") + F.col("w")).alias("rest"))
    if taken is not None:
        behind = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)  # at most heads - 1 rows
        rows = rows.unionByName(taken.select("conv_id", (F.col("i") + 1).cast("long").alias("d"), "x.t1", "x.t2", "x.w", (
            F.col("base_words") + F.col("own_words") - F.coalesce(F.sum("x.w").over(behind), F.lit(0))).alias("rest")))
    return frozen(rows), plan.select("conv_id", "n_turns")


def sequence_classes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Conversations with equal sequences as one: ``rep`` (smallest id), ``copies``, ``n_turns``, ``ends_sha256``.

    Equal sequences have equal digests (128 bits, summed over places). The
    conversations are range-sorted by digest and id; partitions write their
    ids in chunks, and a second, sorted pass streams the chunks of a class
    through SHA-256, so that no list of ids is held whole.
    """
    digest = rows.groupBy("conv_id").agg(F.expr("bit_xor(xxhash64(d, t1, t2))").alias("x1"), F.expr("bit_xor(xxhash64(t2, d, t1))").alias("x2"))
    key = ["n_turns", "x1", "x2"]
    keyed = convs.join(digest, "conv_id", "left").select("n_turns", F.coalesce("x1", F.lit(0)).alias("x1"), F.coalesce("x2", F.lit(0)).alias("x2"), "conv_id")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, x1, x2, conv = (b.column(i).to_numpy() for i in range(4))
            if not len(n):
                continue
            cut = np.flatnonzero((n[1:] != n[:-1]) | (x1[1:] != x1[:-1]) | (x2[1:] != x2[:-1])) + 1
            starts = np.union1d(np.concatenate([[0], cut]), np.arange(0, len(n), _CHUNK))
            ends = np.append(starts[1:], len(n))
            ids = [",".join(map(str, conv[i:j].tolist())) for i, j in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(n[starts]), pa.array(x1[starts]), pa.array(x2[starts]), pa.array(conv[starts]),
                                              pa.array(ends - starts), pa.array(ids)], [*key, "first", "copies", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        at, rep, copies, sha = None, None, 0, None
        for b in batches:
            for n, x1, x2, first, size, ids in zip(*(c.to_pylist() for c in b.columns)):
                if at != (n, x1, x2):
                    if at is not None:
                        done.append((rep, copies, at[0], sha.hexdigest()))
                    at, rep, copies, sha = (n, x1, x2), first, 0, hashlib.sha256()
                sha.update(((b"," if copies else b"") + ids.encode()))
                copies += size
            yield batch(done)
            done = []
        if at is not None:
            yield batch([(rep, copies, at[0], sha.hexdigest())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                          ["rep", "copies", "n_turns", "ends_sha256"])

    n = shuffle_partitions(rows.sparkSession)
    listed = (keyed.repartitionByRange(n, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
              .mapInArrow(chunks, "n_turns long, x1 long, x2 long, first long, copies long, ids string"))
    return frozen(listed.repartition(n, *key).sortWithinPartitions(*key, "first")
                  .mapInArrow(hashed, "rep long, copies long, n_turns long, ends_sha256 string"))


def sweep(suffixes: list[tuple[list[tuple[int, int]], list[int], int, int]], head: int) -> list[list]:
    """One pass over the sorted suffixes of a container: its nodes, parents before their children.

    A suffix is (turn ids, words, id, copies); ``head`` is the id of the head,
    node 0. A node: [id, place below the head, parent's number, conversations,
    children, leaves, saved tokens, id of the sequence that ends there, words].
    """
    nodes: list[list] = [[head, 0, -1, 0, 0, 0, 0, None, 0]]
    path = [0]

    def close() -> None:
        node = nodes[path.pop()]
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * node[8]
        up = nodes[node[2]]
        up[0] = min(up[0], node[0])
        for i, x in ((3, node[3]), (4, 1), (5, node[5]), (6, node[6])):
            up[i] += x

    before: list[tuple[int, int]] = []
    for ids, words, conv, copies in sorted(suffixes):
        same = next((i for i, (a, b) in enumerate(zip(before, ids)) if a != b), min(len(before), len(ids)))
        while len(path) - 1 > same:
            close()
        for d in range(same, len(ids)):
            nodes.append([conv, d + 1, path[-1], 0, 0, 0, 0, None, words[d]])
            path.append(len(nodes) - 1)
        nodes[path[-1]][3] += copies
        nodes[path[-1]][7] = conv
        before = ids
    while len(path) > 1:
        close()
    return nodes


def _swept(container: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one container (rows ``level, head_id, rep, copies, d, t1, t2, w``), and its head with ``is_head``."""
    container = container.sort_values(["rep", "d"])
    level, head = int(container["level"].iloc[0]), int(container["head_id"].iloc[0])
    suffixes: list[tuple] = []
    for rep, copies, t1, t2, w in zip(*(container[c].tolist() for c in ("rep", "copies", "t1", "t2", "w"))):
        if not suffixes or suffixes[-1][2] != rep:
            suffixes.append(([], [], rep, copies))
        suffixes[-1][0].append((t1, t2))
        suffixes[-1][1].append(w)
    nodes = sweep(suffixes, head)
    out = pd.DataFrame([[n[0], level + n[1], None if n[2] < 0 else nodes[n[2]][0], *n[3:8]] for n in nodes],
                       columns=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_id"])
    for c in ("parent_conv_id", "end_id"):
        out[c] = out[c].astype("Int64")
    return out.assign(is_head=out.index == 0)


def prefix_trie(turns: DataFrame, family: int = 20, heads: int = 4, container_turns: int = 4096) -> DataFrame:
    """Trie nodes of the rebuilt conversations (see :func:`rebuilt_turns`) of ``conv_id, turn, role, text``.

    Returns ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` for each distinct sequence of first turns, from
    the root (depth 0). ``container_turns`` bounds the turns a container of two
    or more suffixes is swept with.

    Null roles and texts count as empty, a null turn comes first; rows that tie
    in conversation and turn are ordered by a hash of role and text, repeated
    rows are turns of their own. Rows without a conv_id belong to no
    conversation and are left out. Texts of any length are read whole and
    shuffled as a 128-bit turn id and a word count. An empty table has no
    sequences, so no root: no rows. Other columns are not read.
    """
    role, text = text_or_empty(F.col("role").cast("string")), text_or_empty(F.col("text").cast("string"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    narrow = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(1), role, text).alias("t2"), words.alias("w"))
    rows, convs = rebuilt_turns(narrow, family, heads)
    classes = sequence_classes(rows, convs)
    turns_of = frozen(rows.withColumnRenamed("conv_id", "rep").join(classes.select("rep", "copies", "n_turns"), "rep"))

    none = F.lit(None).cast("long")
    total = classes.agg(F.count(F.lit(1)).alias("k"), F.sum("n_turns").alias("below"), F.min("rep").alias("id")).first()
    bursts = total.k > 1 and total.below > container_turns
    # Paths: each suffix's heads from the root to its container; own_id is the id of a head that bursts.
    at = [F.lit(0).cast("long").alias(c) for c in ("d", "h1", "h2", "w")]
    path = classes.select("rep", "copies", "n_turns", *at, none.alias("parent"), (F.lit(total.id) if bursts else none).cast("long").alias("own_id"))
    paths, level = path, 0
    active = path.where(F.col("own_id").isNotNull() & (F.col("n_turns") > 0)).select("rep", "h1", "h2", F.col("own_id").alias("head_id"))
    while bursts:
        path = _burst(turns_of, active, level, container_turns)
        paths, level = paths.unionByName(path), level + _LEVELS
        active = path.where((F.col("d") == level) & F.col("own_id").isNotNull() & (F.col("n_turns") > level)).select(
            "rep", "h1", "h2", F.col("own_id").alias("head_id"))
        bursts = active.limit(1).count() > 0

    head = ["d", "h1", "h2"]
    heads_all = frozen(paths.groupBy(*head).agg(
        F.min("rep").alias("conv_id"), F.sum("copies").alias("n_convs"), F.min("w").alias("w"), F.min("parent").alias("parent_conv_id"),
        F.max(F.when(F.col("n_turns") == F.col("d"), F.col("rep"))).alias("end_id"), F.count(F.lit(1)).alias("k")))
    # A container has one suffix or at most container_turns turns: no hot key.
    closed = paths.where("own_id is null").select("rep", *head).join(
        heads_all.select(*head, F.col("conv_id").alias("head_id"), "k"), head).withColumnRenamed("d", "level")
    held = frozen(turns_of.join(closed, "rep").where(F.col("d") > F.col("level")))
    one = F.lit(1).cast("long")
    saved = (F.col("copies") - 1) * F.col("rest")
    chains = held.where("k = 1").select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.col("rep").alias("parent_conv_id"), F.col("copies").alias("n_convs"),
        (F.col("d") < F.col("n_turns")).cast("long").alias("n_children"), one.alias("n_leaves"), saved.alias("saved_tokens"),
        F.when(F.col("d") == F.col("n_turns"), F.col("rep")).alias("end_id"))
    swept = frozen(held.where("k > 1").select("h1", "h2", "level", "head_id", "rep", "copies", "d", "t1", "t2", "w").groupBy("level", "h1", "h2").applyInPandas(
        _swept, _NODE + ", is_head boolean"))

    # What hangs below a head: from its sweep, or from the first turn of its chain. Ids are unique at a depth.
    below = swept.where("is_head").select(F.col("conv_id").alias("rep"), F.col("depth").alias("d"), "n_children", "n_leaves", "saved_tokens").unionByName(
        held.where("k = 1 and d = level + 1").select("rep", F.col("level").alias("d"), one.alias("n_children"), one.alias("n_leaves"), saved.alias("saved_tokens")))
    owned = heads_all.select("d", F.col("conv_id").alias("rep"), ((F.col("n_convs") - 1) * F.col("w")).alias("own"))
    here = F.col("own_id").isNull() & F.col("own").isNotNull()  # a container, at its smallest conversation
    sums = paths.join(owned, ["rep", "d"], "left").join(below, ["rep", "d"], "left").select(
        "rep", *head, F.when(here, F.coalesce("n_children", F.lit(0))).alias("n_children"), F.when(here, F.coalesce("n_leaves", F.lit(1))).alias("n_leaves"),
        (F.coalesce("own", F.lit(0)) + F.when(here, F.coalesce("saved_tokens", F.lit(0))).otherwise(0)).alias("saved_tokens"))
    up = Window.partitionBy("rep").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select(*head, "n_children", F.sum("n_leaves").over(up).alias("n_leaves"), F.sum("saved_tokens").over(up).alias("saved_tokens"))
    sums = sums.groupBy(*head).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    children = heads_all.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("parent_conv_id").alias("conv_id")).agg(F.count(F.lit(1)).alias("n"))
    tops = heads_all.join(sums, head).join(children, ["d", "conv_id"], "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n", "n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", "end_id")
    nodes = tops.unionByName(swept.where("not is_head").drop("is_head")).unionByName(chains)
    # A sequence ends at one node; other nodes get keys of their own, so that they spread.
    ends = classes.select(F.col("rep").alias("key"), F.lit(True).alias("ended"), "ends_sha256")
    nodes = nodes.withColumn("ended", F.col("end_id").isNotNull()).withColumn("key", F.coalesce("end_id", F.xxhash64("conv_id", "depth")))
    return nodes.join(ends, ["key", "ended"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def _burst(turns: DataFrame, active: DataFrame, level: int, container_turns: int) -> DataFrame:
    """Move the active suffixes (``rep, h1, h2, head_id``, at depth ``level``) up to ``_LEVELS`` turns down.

    Returns their path rows: a row for each head met, the last one either a
    container within the bound (``own_id`` null) or one that bursts too.
    """
    step = turns.where((F.col("d") > level) & (F.col("d") <= level + _LEVELS)).join(active, "rep")
    down = Window.partitionBy("rep").orderBy("d")  # at most _LEVELS rows
    run = down.rowsBetween(Window.unboundedPreceding, 0)
    x1, x2 = F.xxhash64("d", "t1", "t2"), F.xxhash64("t2", "d", "t1")
    rows = frozen(step.select(
        "rep", "copies", "n_turns", "d", "w", "head_id", F.col("h1").bitwiseXOR(F.bit_xor(x1).over(run)).alias("h1"),
        F.col("h2").bitwiseXOR(F.bit_xor(x2).over(run)).alias("h2")))
    sizes = rows.groupBy("d", "h1", "h2").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("n_turns") - F.col("d")).alias("below"), F.min("rep").alias("own_id"))
    # At most turns / container_turns heads a depth; AQE broadcasts them by their measured size.
    marked = rows.join(sizes.where((F.col("k") > 1) & (F.col("below") > container_turns)).drop("k", "below"), ["d", "h1", "h2"], "left")
    # What is under a container within the bound is within it too: a path goes on below a head that bursts.
    parent = F.when(F.col("d") == level + 1, F.col("head_id")).otherwise(F.lag("own_id").over(down))
    return frozen(marked.withColumn("parent", parent).where(F.col("parent").isNotNull()).select(
        "rep", "copies", "n_turns", "d", "h1", "h2", "w", "parent", "own_id"))
