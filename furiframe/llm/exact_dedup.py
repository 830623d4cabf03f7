"""Exact de-duplication with a heavy-hitter split."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furiframe.llm.common import frozen, text_or_empty


def frequent_digests(rows: DataFrame, col: str, counters: int) -> DataFrame:
    """Misra-Gries candidates: at most ``counters`` digests, with every digest that makes up
    more than 2 / (counters + 1) of the rows.

    Each task keeps ``counters`` counters (an added batch of counts is merged,
    then the (counters + 1)-th largest count is taken off all of them), so it
    undercounts a digest by at most its rows / (counters + 1).
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for b in batches:
            for x in pc.value_counts(b.column(0)).to_pylist():
                held[x["values"]] = held.get(x["values"], 0) + x["counts"]
            if len(held) > counters:
                off = sorted(held.values(), reverse=True)[counters]
                held = {k: v - off for k, v in held.items() if v > off}
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], [col, "_ff_n"])

    parts = rows.select(col).mapInArrow(summarise, f"{col} binary, _ff_n long")
    return (parts.groupBy(col).agg(F.sum("_ff_n").alias("_ff_n"))
            .orderBy(F.desc("_ff_n"), col).limit(counters).select(col))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 256) -> DataFrame:
    """One row per input row: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical (null counts as empty); of equal texts the
    row with the largest id stays. Frequent digests are found by Misra-Gries,
    counted exactly, and their winners (at most ``counters`` rows) broadcast,
    so their rows never meet in one task; all other digests go through an
    ordinary shuffle. A null id loses against any id; where the largest id
    occurs on several equal rows, exactly one of them stays. An empty table
    gives an empty result; other columns are not read.
    """
    rows = frozen(docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("_ff_d"),
        F.monotonically_increasing_id().alias("_ff_row")))

    def winners(some: DataFrame) -> DataFrame:
        return some.groupBy("_ff_d").agg(
            F.count(F.lit(1)).alias("group_size"),
            F.max(F.struct("doc_id", "_ff_row")).alias("_ff_best"))

    frequent = frozen(frequent_digests(rows, "_ff_d", counters))
    heavy = frozen(winners(rows.join(F.broadcast(frequent), "_ff_d")))
    # At most ``counters`` rows each: a proven bound for both broadcasts.
    hot = rows.join(F.broadcast(heavy), "_ff_d")
    rest = rows.join(F.broadcast(frequent), "_ff_d", "left_anti")
    cold = rest.join(winners(rest), "_ff_d")
    return hot.unionByName(cold).select(
        "doc_id", F.col("_ff_best.doc_id").alias("keep_id"), "group_size",
        (F.col("_ff_best._ff_row") == F.col("_ff_row")).alias("kept"),
        F.lower(F.hex("_ff_d")).alias("text_sha256"))
