"""Streaming segmentation: landed corpus files -> segment table, take(n) and overwrite-by-key on a stream.

The corpus arrives as Parquet files in a folder; each micro-batch is
segmented with the same narrow operator as the batch path (no state, no
watermark needed) and appended to a Parquet table. Progress lives in the
checkpoint folder that the caller names (one of its own for each stream, on
shared storage), so a restarted or retried query resumes without duplicates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from furiframe.functions.text import SENTENCE_DELIMITER
from furiframe.operators.segment import segment_sentences, upsert_latest
from furiframe.session import cut_lineage


def stream_segments(spark: SparkSession, source_dir: str, schema: StructType | str, sink_dir: str,
                    checkpoint: str, id_col: str = "id", text_col: str = "text",
                    delimiter: str = SENTENCE_DELIMITER, max_chars: int | None = None,
                    max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the streaming segmentation; ``max_files_per_trigger`` bounds a micro-batch (all files are
    read in the end)."""
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder of its own")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_dir)
    seg = segment_sentences(src, id_col, text_col, delimiter, max_chars)
    w = seg.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint)
    w = w.outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _started(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool) -> StreamingQuery:
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder of its own")
    w = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def _table_or_none(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _replace_partitions(df: DataFrame, path: str, by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def stream_take(stream: DataFrame, n: int, sink_dir: str, checkpoint: str, order_cols: Sequence[str],
                available_now: bool = True) -> StreamingQuery:
    """``take(n)`` of a stream: the first ``n`` rows, micro-batch by micro-batch and in ``order_cols`` within one.

    Kept rows lie under ``sink_dir`` by ``batch_id``; they are the committed
    counter: a batch keeps what earlier batches left of ``n`` and replaces
    its own partition, so a batch that is delivered again, or a stream that
    is killed and started anew, gives the same rows and stops at exactly
    ``n``. At most ``n`` rows of a batch are sorted into one task.
    """
    schema = StructType(stream.schema.fields).add("batch_id", "long")

    def keep(batch: DataFrame, batch_id: int) -> None:
        kept = _table_or_none(batch.sparkSession, sink_dir, schema)
        before = 0 if kept is None else kept.where(F.col("batch_id") < batch_id).count()
        if before < n:
            first = batch.orderBy(*order_cols).limit(n - before)
            _replace_partitions(first.withColumn("batch_id", F.lit(batch_id).cast("long")), sink_dir, "batch_id")

    return _started(stream, keep, checkpoint, available_now)


def stream_upsert(stream: DataFrame, key_cols: Sequence[str], order_col: str, sink_dir: str, checkpoint: str,
                  buckets: int = 64, available_now: bool = True) -> StreamingQuery:
    """Overwrite-by-key on a stream: ``sink_dir`` holds for each key the row with the greatest ``order_col``.

    The table is partitioned by a hash of the key; a micro-batch reads and
    replaces only the buckets its keys fall in. A maximum taken twice is the
    same, so a batch that is delivered again leaves the same table.
    """
    schema = StructType(stream.schema.fields).add("bucket", "long")

    def merge(batch: DataFrame, batch_id: int) -> None:
        new = batch.withColumn("bucket", F.pmod(F.xxhash64(*key_cols), F.lit(buckets)))
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        old = _table_or_none(batch.sparkSession, sink_dir, schema)
        if not touched:
            return
        if old is not None:
            new = new.unionByName(old.where(F.col("bucket").isin(touched)))
        _replace_partitions(cut_lineage(upsert_latest(new, [*key_cols, "bucket"], order_col)), sink_dir, "bucket")

    return _started(stream, merge, checkpoint, available_now)
