"""Ranked lexical search: per-term geometric blocking with exact summary bounds.

Documents become sparse vectors over the terms that the queries ask for, in
one pass over the texts. Shards of a bounded number of documents then hold the
posting lists: each term's list is cut into blocks of similar documents, a
block stores the coordinatewise maximum of its documents' term scores, and a
block is skipped only when the sum of its maxima over a query's terms lies
under the query's threshold, so no document of the best ``k`` is lost.

Nothing is shuffled but candidates: a shard searches its own lists, and only
documents at or over the threshold leave it. The threshold of a query is the
score of the k-th best document of a hash sample of the shards (a lower bound
of the true one), so the candidates a query gets do not grow with the corpus.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furiframe.llm.common import frozen

# ASCII letters and digits and all that is not ASCII: the same runs in UTF-8 bytes as in code points.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SAMPLE_SHARE = 64
FORWARD = "doc_id long, n long, terms array<int>, tfs array<int>"


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order, A-Z lower-cased; none for null."""
    return TERM.findall(text.lower()) if text else []


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs``: number of terms of each text, and the vocabulary's terms in it with their counts."""
    ids = vocabulary

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, terms, tfs, ends = [], [], [], [0]
            for text in b.column(1).cast(pa.binary()).to_pylist():
                words = terms_of(text)
                n.append(len(words))
                for w, c in Counter(words).items():
                    if (i := ids.get(w)) is not None:
                        terms.append(i)
                        tfs.append(c)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(index, FORWARD)


def corpus_counts(forward: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each vocabulary term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for b in batches:
            df += np.bincount(b.column(0).flatten().to_numpy(), minlength=n_terms)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(df[seen])], ["term", "df"])

    total = forward.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(n_terms, np.int64)
    # One row a vocabulary term: bounded by the terms of one block of queries.
    for r in forward.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    return int(total[0]), int(total[1]), df


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def shard_scores(n: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray,
                 n_docs: int, n_words: int) -> np.ndarray:
    """(documents x terms) matrix of what each term adds to a document's score."""
    m = 50 + (50 * n * n_docs) // n_words
    of = np.repeat(np.arange(len(n)), np.diff(ends))
    tf = tfs.astype(np.int64)
    out = np.zeros((len(n), len(weights)), np.int64)
    out[of, terms] = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[of]))
    return out


def blocks_of(postings: np.ndarray, likeness: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut one posting list into blocks of documents nearest to the same pivot.

    ``likeness`` holds the inner products of all documents of the shard with
    those pivots that are in the list themselves (fewer than two: one block).
    Returns the list in block order and the blocks' starts in it.
    """
    if likeness.shape[1] < 2 or len(postings) < 2:
        return postings, np.zeros(1, np.int64)
    nearest = likeness[postings].argmax(axis=1)
    order = np.argsort(nearest, kind="stable")
    nearest = nearest[order]
    return postings[order], np.concatenate([[0], np.flatnonzero(nearest[1:] != nearest[:-1]) + 1])


def asked_coordinates(queries: list[np.ndarray]) -> list[tuple[int, np.ndarray, list[tuple[int, np.ndarray]]]]:
    """For each term some query has: the terms of all queries that have it, and where each of these queries' are in them."""
    asked_by: dict[int, list[int]] = {}
    for q, terms in enumerate(queries):
        for t in terms:
            asked_by.setdefault(int(t), []).append(q)
    out = []
    for t, asking in asked_by.items():
        coords = np.unique(np.concatenate([queries[q] for q in asking]))
        out.append((t, coords, [(q, np.searchsorted(coords, queries[q])) for q in asking]))
    return out


def search_shard(doc_ids: np.ndarray, scores: np.ndarray, queries: list[np.ndarray], asked: list, floor: np.ndarray, k: int,
                 n_pivots: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the best ``k`` documents of one shard with a score of at least its floor: (query, rows, scores).

    ``floor`` is at least 1. Blocks are looked at from the highest bound down;
    the floor rises to the k-th best score met so far. Summaries hold the
    coordinates that some query with the list's term asks for (``asked``).
    """
    pivots = np.unique(np.linspace(0, len(scores) - 1, n_pivots).astype(np.int64))
    as_float = scores.astype(np.float32)
    likeness = as_float @ as_float[pivots].T
    del as_float
    holds = scores[pivots] > 0
    of, in_list = np.nonzero(scores.T)  # all posting lists, term by term
    ends = np.searchsorted(of, np.arange(scores.shape[1] + 1))
    lists, starts, sizes = [], [], []
    found: list[tuple[list[np.ndarray], list[np.ndarray]]] = [([], []) for _ in queries]
    n_blocks, n_listed = 0, 0
    for t, coords, asking in asked:
        postings = in_list[ends[t]: ends[t + 1]]
        if not len(postings):
            continue
        listed, first = blocks_of(postings, likeness[:, holds[:, t]])
        summary = np.maximum.reduceat(scores[listed[:, None], coords], first, axis=0)
        used = False
        for q, at in asking:
            bound = summary[:, at].sum(axis=1)
            kept = np.flatnonzero(bound >= floor[q])
            if len(kept):
                found[q][0].append(kept + n_blocks)
                found[q][1].append(bound[kept])
                used = True
        if used:
            lists.append(listed)
            starts.append(first + n_listed)
            sizes.append(np.diff(np.append(first, len(listed))))
            n_blocks, n_listed = n_blocks + len(first), n_listed + len(listed)
    if not lists:
        return
    listed, starts, sizes = np.concatenate(lists), np.concatenate(starts), np.concatenate(sizes)
    for q, terms in enumerate(queries):
        if not found[q][0]:
            continue
        blocks, bounds = np.concatenate(found[q][0]), np.concatenate(found[q][1])
        order = np.argsort(-bounds, kind="stable")
        blocks, bounds = blocks[order], bounds[order]
        bar, done = int(floor[q]), np.zeros(len(scores), bool)
        rows, got = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, width = 0, 16
        while at < len(blocks) and bounds[at] >= bar:
            some = blocks[at: at + width][bounds[at: at + width] >= bar]
            size = sizes[some]
            place = np.repeat(starts[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
            new = np.zeros(len(scores), bool)
            new[listed[place]] = True
            new = np.flatnonzero(new & ~done)
            done[new] = True
            s = scores[new[:, None], terms].sum(axis=1)
            rows, got = np.concatenate([rows, new[s >= bar]]), np.concatenate([got, s[s >= bar]])
            if len(got) > k:
                best = np.lexsort((doc_ids[rows], -got))[:k]
                rows, got = rows[best], got[best]
            if len(got) == k:
                bar = max(bar, int(got.min()))
            at, width = at + width, 4 * width
        yield q, rows, got


def shard_candidates(forward: DataFrame, queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_words: int,
                     floor: np.ndarray, k: int, n_pivots: int, cells: int) -> DataFrame:
    """Candidates ``query, doc_id, score`` of all shards; a shard has at most ``cells`` matrix cells."""
    size = max(64, min(4096, cells // max(1, len(weights))))
    none = np.iinfo(np.int64).max
    asked = asked_coordinates(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows).combine_chunks()
            ids, n = t.column("doc_id").combine_chunks(), t.column("n").to_numpy()
            terms, tfs = t.column("terms").combine_chunks(), t.column("tfs").combine_chunks()
            ends = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy())])
            scores = shard_scores(n, ends, terms.flatten().to_numpy(), tfs.flatten().to_numpy(), weights, n_docs, n_words)
            order_ids = ids.fill_null(none).to_numpy()  # a null id comes last among equal scores
            qs, at, got = [], [], []
            for q, r, s in search_shard(order_ids, scores, queries, asked, floor, k, n_pivots):
                qs.append(np.full(len(r), q)), at.append(r), got.append(s)
            at = np.concatenate(at) if at else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(qs) if qs else [], pa.int32()), ids.take(pa.array(at)),
                 pa.array(np.concatenate(got) if got else [], pa.int64())], ["query", "doc_id", "score"])

        held: list[pa.RecordBatch] = []
        room = size
        for b in batches:
            while b.num_rows:
                held.append(b.slice(0, room))
                b = b.slice(held[-1].num_rows)
                room -= held[-1].num_rows
                if not room:
                    yield shard(held)
                    held, room = [], size
        if held:
            yield shard(held)

    return forward.mapInArrow(search, "query int, doc_id long, score long")


def best(candidates: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query with their rank from 1: first in slices of the documents, then of the slices' best."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_tie")]
    sliced = candidates.withColumn("_tie", F.monotonically_increasing_id()).withColumn(
        "_slice", F.pmod(F.xxhash64("doc_id", "_tie"), F.lit(32)))
    first = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("query", "_slice").orderBy(*order))).where(F.col("rank") <= k)
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
            .where(F.col("rank") <= k).drop("_tie", "_slice"))


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, items_per_block: int = 512, n_pivots: int = 64,
                  cells: int = 8_000_000) -> DataFrame:
    """For each row of ``items`` (``item_id, text``) the ``k`` documents (``doc_id, text``) of highest score.

    Returns ``item_id, rank, doc_id, score``; scores are above 0, equal ones in
    ascending ``doc_id``. Queries go in blocks of about ``items_per_block``
    items, which bounds what the driver and the tasks hold of them (ids and
    distinct terms); each block makes one pass over the texts.

    Null and empty texts have no terms: such items get no rows, such documents
    never appear, and only documents with a term count in N. Texts of any
    length are read whole. Repeated rows are documents of their own and may
    both be ranked; a null doc_id comes last among equal scores. Items that
    repeat, also in their id, get rows each. Empty tables give no rows. Other
    columns of either table are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select("item_id", F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    n_blocks = max(1, math.ceil(items.count() / items_per_block))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    out = None
    for b in range(n_blocks):
        found = _search_block(spark, docs, items.where(block == b), k, n_pivots, cells)
        out = found if out is None else out.unionByName(found)
    return out


def _search_block(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int, n_pivots: int, cells: int) -> DataFrame:
    rows = items.collect()  # about items_per_block rows
    vocabulary: dict[bytes, int] = {}
    queries = [np.array(sorted({vocabulary.setdefault(w, len(vocabulary)) for w in terms_of(r.text.encode())}), np.int64) for r in rows]
    numbered = spark.createDataFrame([(q, r.item_id) for q, r in enumerate(rows)], f"query int, item_id {items.schema['item_id'].dataType.simpleString()}")
    forward = frozen(forward_index(docs, vocabulary))
    n_docs, n_words, df = corpus_counts(forward, len(vocabulary))
    weights = np.array([term_weight(n_docs, int(d)) for d in df], np.int64)
    holding = forward.where(F.size("terms") > 0)
    floor = np.ones(len(queries), np.int64)

    def candidates(part: DataFrame) -> DataFrame:
        return best(shard_candidates(part, queries, weights, n_docs, max(n_words, 1), floor.copy(), k, n_pivots, cells), k)

    # A lower bound of each query's k-th best score: that of a share of the documents, by hash.
    share = holding.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SAMPLE_SHARE)) == 0)
    for r in candidates(share).where(F.col("rank") == k).collect():  # at most a row a query
        floor[r.query] = max(1, r.score)
    return candidates(holding).join(F.broadcast(numbered), "query").select("item_id", "rank", "doc_id", "score")
