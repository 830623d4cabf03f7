"""Lookup joins with optional salting, and ranks without a global sort.

A lookup table (lexicon, per-character readings, vocabulary) is joined
plainly: AQE broadcasts it when its measured bytes are under the threshold
and otherwise shuffles, splitting hot keys. Nothing is counted while a query
is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furiframe.session import cut_lineage


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left",
                salt_buckets: int = 0, salt_cols: Sequence[str] | None = None) -> DataFrame:
    """Join a large table to a lookup table (unique on ``on``).

    ``salt_buckets > 0`` salts the shuffle join: the big side gets a salt from
    a hash of ``salt_cols`` (default: all its columns) and the small side is
    replicated ``salt_buckets`` times, so a hot key is split where AQE's
    skew-join handling is off or can't (the join feeds an aggregate).
    """
    on = list(on)
    if salt_buckets > 0:
        cols = list(salt_cols) if salt_cols else big.columns
        salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salt_buckets)))
        salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        return salted_big.join(salted_small, on + ["_salt"], how).drop("_salt")
    return big.join(small, on, how)


def hash32(c: Column) -> Column:
    """First 32 bits of the md5 of a string, as a non-negative long (engine independent)."""
    return F.conv(F.substr(F.md5(c), F.lit(1), F.lit(8)), 16, 10).cast("long")


def hash_rank(df: DataFrame, hash_col: str, tie_cols: Sequence[str], out_col: str, buckets: int | None = None) -> DataFrame:
    """0-based rank of every row in the order of a 32-bit hash (then ``tie_cols``), without a global sort.

    The hash range is cut into ``buckets`` equal parts (default: the number
    of shuffle partitions), rows are ranked inside their part and offset by
    the sizes of the parts before it. The ranks do not depend on ``buckets``;
    the table of sizes has at most ``buckets`` rows, so it is broadcast.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = df.withColumn("_b", F.floor(F.col(hash_col) * n / 2**32).cast("int"))
    ranked = part.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(hash_col, *tie_cols)) - 1)
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (part.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
               .select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o")))
    return (ranked.join(F.broadcast(offsets), "_b")
            .withColumn(out_col, (F.col("_o") + F.col("_r")).cast("long")).drop("_b", "_r", "_o"))


def dense_ids(df: DataFrame, col: str, out_col: str = "id", buckets: int | None = None) -> DataFrame:
    """Dense 0-based ids for the distinct values of ``col``, in the order of their hash (see ``hash_rank``)."""
    vals = df.select(col).distinct().withColumn("_h", hash32(F.col(col).cast("string")))
    return hash_rank(vals, "_h", [col], out_col, buckets).select(col, out_col)


def range_rank(df: DataFrame, order_cols: Sequence[str], out_col: str) -> DataFrame:
    """0-based rank of every row in the order of ``order_cols`` (unique together).

    Rows are range-sorted once (checkpointed, so that both uses below see the
    same partitions); each partition is numbered by itself and offset by the
    sizes of the partitions before it, at most one row a partition, broadcast.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(df.repartitionByRange(n, *order_cols).withColumn("_p", F.spark_partition_id()))
    ranked = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order_cols)) - 1)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
               .select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o")))
    return (ranked.join(F.broadcast(offsets), "_p")
            .withColumn(out_col, (F.col("_o") + F.col("_r")).cast("long")).drop("_p", "_r", "_o"))
