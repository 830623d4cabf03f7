"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ASCII white space of the contracts: \x20 and \x09-\x0D.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Have the session checkpoint into the shared folder ``spark.checkpoint.dir`` names.

    Where nothing is set, a single-process session (tests) gets a scratch
    folder; a cluster session raises, as its executors share no local disk.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-ckpt-")
    sc.setCheckpointDir(folder)


def frozen(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint (survives lost executors)."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """For the queries and the pipeline: Arrow batches of at most ``rows`` texts, unless the session
    has a setting of its own, whatever it is (the default of 10,000 whole texts is tens to hundreds of MB
    a task). The operators read no such setting; it stays set for the session's later queries."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(rows))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def id_crc_mod(id_col: str = "doc_id", n: int = 4) -> Column:
    """crc32 of the id written as text, modulo ``n`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(n))


def held_out(id_col: str = "doc_id") -> Column:
    """True for the quarter of ids that no model may learn from."""
    return id_crc_mod(id_col) == 2


def with_columns(schema: T.StructType, *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in more)])


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hashes of ``key``: a fixed sample for fitting models.

    The rows are counted first, and only hashes in the lowest share that
    should hold ``rows`` rows (and a half more) are sorted, however large the table.
    """
    total = df.count()
    place = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 40))
    near = df.where(place < min(1 << 40, int(1.5 * rows / max(total, 1) * (1 << 40)) + (1 << 30)))
    return near.orderBy(place, key).limit(rows)


def one_text_each(df: DataFrame, *keys: str) -> DataFrame:
    """``keys..., _ff_text`` with one row a key, the smallest text of rows that repeat it: a sample of keys bounds the rows."""
    return df.groupBy(*keys).agg(F.min("_ff_text").alias("_ff_text"))


def ranked(df: DataFrame, group: str, order: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: the 0-based gapless position of each row inside its ``group``.

    ``group`` is a non-null integer column. The rows are range-sorted by
    (group, order), so a group of any size spreads over as many partitions as
    it needs; each partition numbers its own runs, and the runs' offsets (at
    most partitions + groups rows, a proven bound) are broadcast. ``df`` is
    read twice (range sampling, then the sort): pass a frozen one if it is
    expensive.
    """
    keys = [group, *order]
    part, pos = "_ff_part", "_ff_pos"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            g = b.column(b.schema.get_field_index(group)).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1])
            lengths = np.diff(np.append(starts, n))
            p = np.arange(n) - np.repeat(starts, lengths)
            if last is not None and g[0] == last:
                p[: lengths[0]] += seen
            last, seen = g[-1], int(p[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(p, pa.int64())], [*b.schema.names, pos])

    n = shuffle_partitions(df.sparkSession)
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(
        part, F.spark_partition_id())
    runs = frozen(dealt.mapInArrow(number, with_columns(dealt.schema, (pos, T.LongType()))))
    sizes = runs.groupBy(group, part).agg(F.count(F.lit(1)).alias("_ff_n"))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, part, F.coalesce(F.sum("_ff_n").over(before), F.lit(0)).alias("_ff_o"))
    return (runs.join(F.broadcast(offsets), [group, part])
            .withColumn(out, F.col("_ff_o") + F.col(pos)).drop(part, pos, "_ff_o"))
