"""Sinks: keyed Parquet tables, JSON Lines, run-partitioned transcripts.

Files-per-row directories of the original tool chain become tables keyed by
``name``/``stem``; "overwrite by key" is ``operators.segment.upsert_latest``;
deletions become reject tables (``operators.clean``). Writers never collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """Parquet table (one task per partition, atomic commit by the job)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_jsonl(df: DataFrame, path: str, cols: Sequence[str] = ("messages",), mode: str = "overwrite") -> None:
    """One JSON object per line (null fields left out)."""
    df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value")).write.mode(mode).text(path)


RUN_COLS = ("model", "temperature", "run_ts")


def write_runs(transcripts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Recognition output partitioned by run: ``model / temperature / run_ts``.

    A run that is written again replaces its own partition and no other
    (dynamic partition overwrite), so a retry leaves no row twice.
    """
    transcripts.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*RUN_COLS).parquet(path)


def read_run(spark: SparkSession, path: str, **run) -> DataFrame:
    """Rows of the runs with these values of ``RUN_COLS``; other runs' folders are not read (partition filters)."""
    df = spark.read.parquet(path)
    for c, v in run.items():
        if c not in RUN_COLS:
            raise ValueError(f"not a run column: {c}")
        df = df.where(F.col(c) == F.lit(v))
    return df
