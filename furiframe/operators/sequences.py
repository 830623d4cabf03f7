"""Token-id tables: vocabulary, encode / decode by join, batch collation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furiframe.functions.arrays import attention_mask, mask_value, pad_truncate
from furiframe.operators.joins import dense_ids, lookup_join, range_rank


def build_vocab(pieces: DataFrame, piece_col: str = "piece", n_special: int = 3) -> DataFrame:
    """``(token_id, piece, special)`` with dense ids; the first ids are special."""
    ids = dense_ids(pieces, piece_col, "token_id")
    return ids.select(F.col("token_id").cast("int").alias("token_id"), F.col(piece_col).alias("piece"),
                      (F.col("token_id") < n_special).alias("special"))


def encode_pieces(df: DataFrame, keys: Sequence[str], pieces_col: str, vocab: DataFrame,
                  out_col: str = "input_ids") -> DataFrame:
    """ARRAY<STRING> of pieces -> ARRAY<INT> of vocabulary ids (unknown pieces dropped).

    Explode -> lookup join (AQE broadcasts a small vocabulary) -> ordered
    regroup per row.
    """
    keys = list(keys)
    ex = df.select(*keys, F.posexplode(pieces_col).alias("_pos", "piece"))
    joined = lookup_join(ex, vocab.select("piece", "token_id"), ["piece"], "inner")
    return (joined.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_pos"), F.col("token_id")))).alias("_s"))
            .select(*keys, F.transform("_s", lambda x: x["token_id"]).alias(out_col)))


def decode_ids(df: DataFrame, keys: Sequence[str], ids_col: str, vocab: DataFrame,
               skip_special: bool = True, sep: str = " ", out_col: str = "text") -> DataFrame:
    """ARRAY<INT> -> text by vocabulary join; special tokens skipped.

    Rows whose ids are all skipped come back with an empty text.
    """
    keys = list(keys)
    v = vocab.where(~F.col("special")) if skip_special else vocab
    ex = df.select(*keys, F.posexplode(ids_col).alias("_pos", "token_id"))
    joined = lookup_join(ex, v.select("token_id", "piece"), ["token_id"], "inner")
    dec = (joined.groupBy(*keys)
           .agg(F.array_sort(F.collect_list(F.struct(F.col("_pos"), F.col("piece")))).alias("_s"))
           .select(*keys, F.array_join(F.transform("_s", lambda x: x["piece"]), sep).alias(out_col),
                   F.size("_s").alias("_n")))
    base = df.select(*keys)
    return (base.join(dec, keys, "left")
            .select(*keys, F.coalesce(F.col(out_col), F.lit("")).alias(out_col),
                    F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n_tokens")))


def assign_batches(df: DataFrame, order_cols: Sequence[str], batch_size: int = 16,
                   out_col: str = "batch_id") -> DataFrame:
    """Batches of ``batch_size`` consecutive rows in the order of ``order_cols`` (unique together);
    the last one may be smaller. Only the keys are ranked; the rows get their batch by a join on them."""
    keys = list(order_cols)
    ranks = range_rank(df.select(*keys), keys, "_rank")
    return df.join(ranks, keys).withColumn(out_col, F.floor(F.col("_rank") / batch_size).cast("long")).drop("_rank")


def collate_batches(df: DataFrame, batch_col: str, ids_col: str, pad: int,
                    mask_pad: bool = True) -> DataFrame:
    """Pad every sequence to the longest of its batch; mask pad labels.

    The per-batch maximum is a partial aggregate (one row per batch and map
    task before the shuffle); it is joined back with a plain lookup join,
    so a huge batch is split instead of landing in one task.
    """
    longest = df.groupBy(batch_col).agg(F.max(F.size(ids_col)).alias("_longest"))
    j = lookup_join(df, longest, [batch_col], "inner")
    ids = pad_truncate(ids_col, F.col("_longest"), pad)
    out = (j.withColumn("input_ids", ids)
           .withColumn("attention_mask", attention_mask(ids_col, F.col("_longest")))
           .withColumn("labels", mask_value("input_ids", pad) if mask_pad else F.col("input_ids")))
    return out.drop("_longest")
