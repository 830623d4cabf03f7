"""Line de-duplication: range-partitioned line hashes, keep bitmaps, one pass over the texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furiframe.llm.common import ASCII_SPACE, frozen, shuffle_partitions, text_or_empty


def line_keys(text: str) -> list[bytes]:
    """Each line's key in UTF-8: ASCII white space stripped at both ends, A-Z lower-cased (as bytes.lower does)."""
    space = ASCII_SPACE.encode()
    return [line.strip(space) for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode("utf-8", "surrogatepass")) >= min_chars


def _explode_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per row of ``docs`` and distinct key: 128-bit key hash, id, text hash,
    number of lines, positions of the key's lines."""
    id_type = docs.schema["_ff_id"].dataType

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, source, counts, flat, sizes = [], [], [], [], []
            for i, text in enumerate(b.column(2)):
                at: dict[bytes, list[int]] = {}
                lines = line_keys(text.as_py())
                for p, key in enumerate(lines):
                    if _long_enough(key, min_chars):
                        at.setdefault(key, []).append(p)
                for key, where in at.items():
                    digests.append(xxhash.xxh3_128_digest(key))
                    flat += where
                    sizes.append(len(where))
                source += [i] * len(at)
                counts += [len(lines)] * len(at)
                if len(flat) > 200_000 or i == b.num_rows - 1:
                    k = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
                    take = pa.array(source, pa.int64())
                    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(k[:, 0]), pa.array(k[:, 1]), b.column(0).take(take), b.column(1).take(take),
                        pa.array(counts, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())),
                    ], ["_ff_k1", "_ff_k2", "_ff_id", "_ff_t", "_ff_lines", "_ff_at"])
                    digests, source, counts, flat, sizes = [], [], [], [], []

    schema = T.StructType([
        T.StructField("_ff_k1", T.LongType()), T.StructField("_ff_k2", T.LongType()),
        T.StructField("_ff_id", id_type), T.StructField("_ff_t", T.LongType()),
        T.StructField("_ff_lines", T.IntegerType()), T.StructField("_ff_at", T.ArrayType(T.IntegerType()))])
    return docs.select("_ff_id", "_ff_t", "_ff_text").mapInArrow(explode, schema)


def _runs(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1])
    return starts, np.diff(np.append(starts, len(k)))


def _keys(t: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.stack([np.asarray(t.column("_ff_k1")), np.asarray(t.column("_ff_k2"))], axis=1)


def _edge_runs(ordered: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """(rows, first partition) over all partitions of each key that is the first or the last of one.

    At most two rows a partition, whatever the input: only such keys can span partitions.
    """

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for b in batches:
            if not b.num_rows:
                continue
            k = _keys(b)
            starts, sizes = _runs(k)
            runs = [(tuple(map(int, k[s])), int(n)) for s, n in ((starts[0], sizes[0]), (starts[-1], sizes[-1]))]
            if last is not None and last[0] == runs[0][0]:
                joined = (last[0], last[1] + runs[0][1])
                first = joined if first[0] == joined[0] else first
                last = joined if len(starts) == 1 else runs[1]
            else:
                first, last = first or runs[0], runs[1]
            part = b.column("_ff_part")[0].as_py()
        if first is not None:
            found = [first] if first[0] == last[0] else [first, last]
            yield pa.RecordBatch.from_pydict({
                "k1": [x[0][0] for x in found], "k2": [x[0][1] for x in found],
                "n": [x[1] for x in found], "part": pa.array([part] * len(found), pa.int32())})

    rows = (ordered.select("_ff_k1", "_ff_k2", "_ff_part")
            .mapInArrow(edges, "k1 long, k2 long, n long, part int")
            .groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.min("part").alias("part")).collect())
    return {(r.k1, r.k2): (r.n, r.part) for r in rows}


def dropped_lines(docs: DataFrame, min_docs: int, min_chars: int, keep: str) -> DataFrame:
    """(_ff_id, _ff_t, _ff_lines, _ff_at): positions that go, from a sorted stream of line hashes."""
    lines = _explode_lines(docs, min_chars)
    order = ["_ff_k1", "_ff_k2", "_ff_id", "_ff_t"]
    # The id is part of the range key, so the rows of a very common line spread over partitions.
    ordered = frozen(lines.repartitionByRange(shuffle_partitions(docs.sparkSession), *order)
                     .sortWithinPartitions(*order).withColumn("_ff_part", F.spark_partition_id()))
    edges = _edge_runs(ordered)
    out = T.StructType([ordered.schema[c] for c in ("_ff_id", "_ff_t", "_ff_lines", "_ff_at")])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the open run's rows while they are fewer than min_docs
        known: tuple[int, int] | None = None  # the open run's key once it is known to go

        def decide(t: pa.Table, more: bool) -> tuple[pa.Table, pa.Table | None, tuple[int, int] | None]:
            k = _keys(t)
            starts, sizes = _runs(k)
            total, lead = sizes.copy(), np.ones(len(starts), bool)
            part = t.column("_ff_part")[0].as_py()
            for i in {0, len(starts) - 1}:
                key = tuple(map(int, k[starts[i]]))
                if key in edges:
                    total[i], lead[i] = max(total[i], edges[key][0]), edges[key][1] == part
                if key == known:
                    total[i], lead[i] = max(total[i], min_docs), False
            goes = np.repeat(total >= min_docs, sizes)
            open_key = tuple(map(int, k[-1]))
            waiting = more and total[-1] < min_docs and open_key not in edges
            end = starts[-1] if waiting else t.num_rows
            at = np.flatnonzero(goes[:end])
            gone = t.take(pa.array(at))
            if keep == "first":
                firsts = set(starts[lead & (total >= min_docs)].tolist())
                where = [x[1:] if i in firsts else x for i, x in zip(at.tolist(), gone.column("_ff_at").to_pylist())]
                gone = gone.set_column(gone.schema.get_field_index("_ff_at"), "_ff_at",
                                       pa.array(where, pa.list_(pa.int32())))
            return gone, t.slice(end) if waiting else None, open_key if total[-1] >= min_docs else None

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            gone, held, known = decide(t, True)
            yield from gone.select(out.names).combine_chunks().to_batches()
        if held is not None:
            yield from decide(held, False)[0].select(out.names).combine_chunks().to_batches()

    return ordered.mapInArrow(stream, out)


@F.pandas_udf(T.BinaryType())
def _bitmap(lines: pd.Series, at: pd.Series) -> pd.Series:
    """Compressed keep bitmap: bit p is 1 when line p stays."""
    def one(n: int, gone: np.ndarray) -> bytes:
        bits = np.ones(n, np.uint8)
        bits[np.asarray(gone, np.int64)] = 0
        return zlib.compress(np.packbits(bits).tobytes(), 1)

    return pd.Series([one(n, a) for n, a in zip(lines, at)])


@F.pandas_udf(T.StringType())
def _apply_bitmap(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def one(t: str | None, b: bytes | None) -> str | None:
        if b is None or t is None:
            return None
        lines = t.split("\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8), count=len(lines))
        return "\n".join(x for x, keep in zip(lines, bits.tolist()) if keep)

    return pd.Series([one(t, b) for t, b in zip(text, bitmap)], dtype=object)


def _positions(gone: DataFrame) -> DataFrame:
    """All dropped positions of an id and text hash; rows alike in both bring the same lists, and one of each is held."""
    return gone.groupBy("_ff_id", "_ff_t").agg(F.first("_ff_lines").alias("n_lines"), F.collect_set("_ff_at").alias("_ff_lists"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                 min_chars: int = 1, keep: str = "none") -> DataFrame:
    """Keep bitmaps of the documents that lose lines: (_ff_id, _ff_t, n_lines, n_dropped, keep_bitmap),
    one row per id and text hash. ``keep_bitmap`` is zlib over packed bits, bit p for line p."""
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    rows = docs.select(F.col(id_col).alias("_ff_id"), F.xxhash64(text_or_empty(text_col)).alias("_ff_t"),
                       text_or_empty(text_col).alias("_ff_text"))
    gone = dropped_lines(rows, min_docs, min_chars, keep)
    return (_positions(gone).withColumn("_ff_at", F.array_distinct(F.flatten("_ff_lists")))
            .select("_ff_id", "_ff_t", "n_lines", F.size("_ff_at").alias("n_dropped"),
                    _bitmap("n_lines", "_ff_at").alias("keep_bitmap")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                min_chars: int = 1, keep: str = "none") -> DataFrame:
    """Every row of ``docs`` with its text rid of common lines: (row, text, n_lines, n_dropped).

    ``row`` is a struct of all input columns (so no name can clash), ``text``
    the kept lines joined by \\n. A line's key is the line stripped of ASCII
    white space with A-Z lower-cased. A key of at least ``min_chars`` code
    points found in at least ``min_docs`` rows loses its lines everywhere
    (``keep="none"``) or everywhere but at its first place by (id, position)
    (``keep="first"``). Null or empty text is one empty line, and the result
    is an empty text; every row counts as a document of its own, also with a
    null or repeated id; equal rows get equal results (with ``keep="first"``
    the first place is then in all of them). An empty table gives an empty one.

    Line hashes (128 bits) are range-partitioned and sorted by (hash, id);
    tasks stream the runs, and only keys at partition edges (two a partition)
    are summed across tasks. Bitmaps, not texts, come back, and one join on
    (id, text hash) brings them to the texts.
    """
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_docs, min_chars, keep)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       F.col(id_col).alias("_ff_i"), F.xxhash64(text_or_empty(text_col)).alias("_ff_h"))
    text = text_or_empty(F.col("row")[text_col])
    both = rows.join(bitmaps, F.col("_ff_i").eqNullSafe(F.col("_ff_id")) & (F.col("_ff_h") == F.col("_ff_t")), "left")
    cut = _apply_bitmap(F.when(F.col("keep_bitmap").isNotNull(), text), F.col("keep_bitmap"))
    return both.select(
        "row", F.coalesce(cut, text).alias("text"),
        F.coalesce(F.col("n_lines").cast("long"),
                   F.octet_length(text).cast("long") - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n_lines"),
        F.coalesce(F.col("n_dropped").cast("long"), F.lit(0).cast("long")).alias("n_dropped"))
