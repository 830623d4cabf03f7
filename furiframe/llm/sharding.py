"""Sharding by jump consistent hashing (Lamping & Veach, 2014)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furiframe.llm.common import frozen, ranked

_LCG = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key, without a ring table; ``shards`` >= 1.

    Going from n to n + 1 shards moves a key only into shard n.
    """
    key = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(key), np.int64)
    open_, jump = np.arange(len(key)), np.zeros(len(key), np.int64)
    while len(open_):
        shard[open_] = jump
        key[open_] = key[open_] * _LCG + np.uint64(1)
        step = float(1 << 31) / ((key[open_] >> np.uint64(33)).astype(np.float64) + 1.0)
        jump = ((shard[open_] + 1) * step).astype(np.int64)
        more = jump < shards
        open_, jump = open_[more], jump[more]
    return shard


def jump_shard(key: Column, shards: int) -> Column:
    """Column form of :func:`jump_hash` over a 64-bit integer key."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.pandas_udf(T.IntegerType())
    def of(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return of(key)


def stable_key(df: DataFrame, id_col: str) -> Column:
    """64-bit key of an id: an integer id itself, else XXH64 of it; null ids have key 0."""
    kind = df.schema[id_col].dataType
    col = F.col(id_col).cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(F.col(id_col))
    return F.when(F.col(id_col).isNull(), F.lit(0).cast("long")).otherwise(col)


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every row: (id, size, text_crc32, law, shard, slot, grown_shard).

    The id and the shard count alone decide the shard; ``grown_shard`` is the
    shard with one more shard, which takes rows only into itself. ``size`` is
    the UTF-8 length of the text (null: none) plus 1. ``slot`` numbers a
    shard's rows gaplessly from 0 by (id, crc, size), nulls first. Only the
    narrow columns move. Null ids share the shard of key 0; rows with the
    same id (or fully equal rows) share a shard and get slots of their own,
    and a hot id still spreads over tasks, as slots come from a range sort
    that ends in a row number. An empty table gives an empty result; other
    columns are not read.
    """
    text = F.col(text_col)
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).cast("long").alias("text_crc32"),
        stable_key(docs, id_col).alias("_ff_key"),
        F.monotonically_increasing_id().alias("_ff_row"))
    placed = narrow.select(
        "doc_id", "size", "text_crc32", "_ff_row",
        jump_shard(F.col("_ff_key"), shards).alias("shard"),
        jump_shard(F.col("_ff_key"), shards + 1).alias("grown_shard"))
    slots = ranked(frozen(placed), "shard", ["doc_id", "text_crc32", "size", "_ff_row"], "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
