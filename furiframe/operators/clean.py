"""Paired image/transcript dataset hygiene.

Inputs are manifests, never deleted files: ``texts(stem, size)`` and
``images(stem, size, valid)``. Spark file scans silently skip zero-byte
files, so sizes must come from a manifest (or ``binaryFile``'s ``length``).
Order matches the reference: empty transcripts go first, then images are
synced against what is left, so an emptied transcript makes its image an
orphan; a zero-size or undecodable image removes itself and its transcript.

Each step is a semi/anti join on the unique ``stem`` key (the summary and
the reject list take one full outer join): Catalyst broadcasts a side only
when its measured size is under the threshold (AQE re-plans at run time),
else it is a sort-merge join on a unique key, so no hot key exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_empty(texts: DataFrame) -> DataFrame:
    """Transcripts with ``size > 0``."""
    return texts.where(F.col("size") > 0)


def clean_orphans(images: DataFrame, texts_kept: DataFrame, key: str = "stem") -> DataFrame:
    """Images without a (non-empty) transcript."""
    return images.join(texts_kept.select(key), key, "left_anti")


def corrupt_images(images: DataFrame, texts_kept: DataFrame, key: str = "stem") -> DataFrame:
    """Paired images that are zero-size or fail to decode."""
    paired = images.join(texts_kept.select(key), key, "left_semi")
    return paired.where((F.col("size") == 0) | ~F.coalesce(F.col("valid"), F.lit(False)))


def clean_sync(images: DataFrame, texts_kept: DataFrame, key: str = "stem") -> DataFrame:
    """Surviving images: paired with a kept transcript, non-empty and decodable."""
    paired = images.join(texts_kept.select(key), key, "left_semi")
    return paired.where((F.col("size") > 0) & F.coalesce(F.col("valid"), F.lit(False)))


def surviving_texts(images: DataFrame, texts_kept: DataFrame, key: str = "stem",
                    two_way: bool = False) -> DataFrame:
    """Transcripts left after the corrupt images took theirs along.

    ``two_way=True`` also drops transcripts that have no image (the
    reference keeps them).
    """
    bad = corrupt_images(images, texts_kept, key).select(key)
    kept = texts_kept.join(bad, key, "left_anti")
    if two_way:
        kept = kept.join(images.select(key), key, "left_semi")
    return kept


def file_status(images: DataFrame, texts: DataFrame, key: str = "stem") -> DataFrame:
    """One row per stem with the fate of its image and its transcript.

    A single full outer join on the (unique) stem replaces the chain of
    anti/semi joins: ``image_status`` is orphan / corrupt / kept (null when
    there is no image), ``text_status`` is empty / corrupt_image / kept (null
    when there is no transcript), following the reference's order (empty
    transcripts first, then the image sync).
    """
    i = images.select(key, F.lit(True).alias("_img"), F.col("size").alias("_isize"),
                      F.coalesce(F.col("valid"), F.lit(False)).alias("_valid"))
    t = texts.select(key, F.lit(True).alias("_txt"), F.col("size").alias("_tsize"))
    j = i.join(t, key, "full_outer")
    has_img, has_txt = F.col("_img").isNotNull(), F.col("_txt").isNotNull()
    text_kept = has_txt & (F.col("_tsize") > 0)
    bad_img = (F.col("_isize") == 0) | ~F.col("_valid")
    image_status = (F.when(~has_img, F.lit(None).cast("string"))
                    .when(~text_kept, F.lit("orphan"))
                    .when(bad_img, F.lit("corrupt"))
                    .otherwise(F.lit("kept")))
    text_status = (F.when(~has_txt, F.lit(None).cast("string"))
                   .when(~text_kept, F.lit("empty"))
                   .when(has_img & bad_img, F.lit("corrupt_image"))
                   .otherwise(F.lit("kept")))
    return j.select(key, image_status.alias("image_status"), text_status.alias("text_status"))


def rejects(images: DataFrame, texts: DataFrame, key: str = "stem") -> DataFrame:
    """Everything removed, with a reason: ``(stem, kind, reason)``."""
    st = file_status(images, texts, key)
    # One pass over the joined files: a union would build both inputs and join them twice.
    out = F.array(
        F.when(F.col("image_status").isin("orphan", "corrupt"), F.struct(F.lit("image").alias("kind"), F.col("image_status").alias("reason"))),
        F.when(F.col("text_status").isin("empty", "corrupt_image"), F.struct(F.lit("text").alias("kind"), F.col("text_status").alias("reason"))))
    return st.select(key, F.explode(F.array_compact(out)).alias("_out")).select(key, "_out.*")


def clean_summary(images: DataFrame, texts: DataFrame, key: str = "stem") -> DataFrame:
    """One row of counts over the per-file status table, in one aggregate."""
    st = file_status(images, texts, key)
    i, t = F.col("image_status"), F.col("text_status")
    return st.agg(
        F.count_if(t.isNotNull()).alias("texts_total"),
        F.count_if(i.isNotNull()).alias("images_total"),
        F.count_if(t == "empty").alias("texts_empty"),
        F.count_if(i == "orphan").alias("images_orphaned"),
        F.count_if(i == "corrupt").alias("images_corrupt"),
        F.count_if(t == "corrupt_image").alias("texts_dropped_with_image"),
        F.count_if(i == "kept").alias("images_kept"),
        F.count_if(t == "kept").alias("texts_kept"),
    )
