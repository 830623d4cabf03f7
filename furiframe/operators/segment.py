"""Corpus segmentation, keys, character budget and last-write-wins upsert.

All operators here are narrow (no shuffle) except ``upsert_latest``,
which is one partially aggregated hash aggregate, and ``take_first``
(a top-k, whose limit is the feature).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from furiframe.functions.text import (
    ANNOTATION_BUDGET,
    FALLBACK_ID_PREFIX,
    SENTENCE_DELIMITER,
    py_strip,
    slice_key,
    split_literal,
)


def _text(c) -> Column:
    # A missing text is treated as the empty document.
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def sentence_pieces(text, delimiter: str = SENTENCE_DELIMITER) -> Column:
    """ARRAY of stripped, non-empty pieces of ``text`` split on ``delimiter``.

    Filtering happens inside the array, before any explode, so the index a
    piece gets after ``posexplode`` counts kept pieces only.
    """
    pieces = F.transform(split_literal(_text(text), delimiter), py_strip)
    return F.filter(pieces, lambda s: F.length(s) > 0)


def segment_sentences(corpus: DataFrame, id_col: str = "id", text_col: str = "text",
                      delimiter: str = SENTENCE_DELIMITER,
                      max_chars: int | None = None, suffix: str | None = None) -> DataFrame:
    """Document -> sentences ``(id, seq, text)``.

    Split on the literal delimiter, strip, drop empty pieces, append
    ``suffix`` (default: the delimiter) and, with ``max_chars``, cut to that
    many code points (so a long sentence loses its suffix and one already
    ending in it may carry it twice). One narrow Generate: no shuffle, no window.
    """
    return _segments(corpus, id_col, sentence_pieces(text_col, delimiter), delimiter if suffix is None else suffix, max_chars)


def _segments(corpus: DataFrame, id_col: str, pieces: Column, suffix: str, max_chars: int | None) -> DataFrame:
    exploded = corpus.select(F.col(id_col), F.posexplode(pieces).alias("seq", "_piece"))
    whole = F.concat(F.col("_piece"), F.lit(suffix))
    return exploded.select(
        F.col(id_col),
        F.col("seq").cast("long").alias("seq"),
        (whole if max_chars is None else F.left(whole, F.lit(max_chars))).alias("text"),
    )


def segment_summary(corpus: DataFrame, text_col: str = "text",
                    delimiter: str = SENTENCE_DELIMITER) -> DataFrame:
    """Processed / with-content / skipped documents and segment count, one pass."""
    n = F.size(sentence_pieces(text_col, delimiter))
    return corpus.select(n.alias("_n")).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("_n") > 0).alias("with_segments"),
        F.count_if(F.col("_n") == 0).alias("skipped"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("segments"),
    )


def write_segments(corpus: DataFrame, path: str, id_col: str = "id", text_col: str = "text",
                   delimiter: str = SENTENCE_DELIMITER, max_chars: int | None = None) -> dict[str, int]:
    """Write the segments of ``corpus`` to ``path`` and return the counts of ``segment_summary``, in the writing pass.

    The counts are observed where the documents enter the explode, so the
    corpus is read once; the write has no shuffle, so a task that runs again
    is counted once.
    """
    seen = Observation("segments")
    pieces = sentence_pieces(text_col, delimiter)
    n = F.size("_ff_pieces")
    observed = corpus.select(id_col, pieces.alias("_ff_pieces")).observe(
        seen, F.count(F.lit(1)).alias("processed"), F.count_if(n > 0).alias("with_segments"),
        F.count_if(n == 0).alias("skipped"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("segments"))
    _segments(observed, id_col, F.col("_ff_pieces"), delimiter, max_chars).write.mode("overwrite").parquet(path)
    return seen.get


def fallback_ids(corpus: DataFrame, id_col: str = "id", ordinal_col: str = "ordinal",
                 out_col: str = "entry_id") -> DataFrame:
    """Missing ids become ``unknown_id_<ordinal>`` (1-based source position)."""
    return corpus.withColumn(
        out_col,
        F.coalesce(F.col(id_col), F.concat(F.lit(FALLBACK_ID_PREFIX), F.col(ordinal_col).cast("string"))),
    )


def segment_key(entry_id, seq, legacy_slice: bool = True) -> Column:
    """File key of a segment: ``entry_id[10:-1] + '_' + seq``."""
    e = F.col(entry_id) if isinstance(entry_id, str) else entry_id
    base = slice_key(e) if legacy_slice else e
    return F.concat(base, F.lit("_"), (F.col(seq) if isinstance(seq, str) else seq).cast("string"))


def _phrases(text, delimiter: str, min_chars: int) -> Column:
    return F.filter(F.transform(split_literal(_text(text), delimiter), py_strip), lambda p: F.length(p) >= min_chars)


def _budget_fold(text, delimiter: str, budget: int, min_chars: int):
    phrases = _phrases(text, delimiter, min_chars)
    zero = F.struct(F.lit(0).cast("long").alias("total"),
                    F.array().cast("array<bigint>").alias("cums"))

    def step(acc, p):
        total = acc["total"] + F.length(p)
        cums = F.when(total <= budget, F.array_append(acc["cums"], total)).otherwise(acc["cums"])
        return F.struct(total.alias("total"), cums.alias("cums"))

    cums = F.aggregate(phrases, zero, step)["cums"]
    return phrases, cums


def budget_phrases(text, delimiter: str = SENTENCE_DELIMITER, budget: int | None = None,
                   min_chars: int = 2) -> Column:
    """ARRAY of the phrases of at least ``min_chars``, all of them or those under the budget (see ``char_budget``)."""
    if budget is None:
        return _phrases(text, delimiter, min_chars)
    phrases, cums = _budget_fold(text, delimiter, budget, min_chars)
    return F.slice(phrases, 1, F.size(cums))


def budget_text(text, delimiter: str = SENTENCE_DELIMITER, budget: int | None = None,
                min_chars: int = 2) -> Column:
    """Kept phrases, each with the delimiter re-added, joined by one space."""
    kept = budget_phrases(text, delimiter, budget, min_chars)
    return F.array_join(F.transform(kept, lambda p: F.concat(p, F.lit(delimiter))), " ")


def char_budget(corpus: DataFrame, id_col: str = "id", text_col: str = "text",
                delimiter: str = SENTENCE_DELIMITER, budget: int = ANNOTATION_BUDGET,
                min_chars: int = 2) -> DataFrame:
    """Phrases kept under a per-document running character budget.

    Phrases are split on the delimiter and stripped; those shorter than
    ``min_chars`` are dropped before counting; a phrase is kept while the
    running total (delimiter not counted) stays within ``budget``. Since all
    counted lengths are positive the kept set is a prefix, which equals the
    reference's early ``break``.

    The running sum is folded inside the phrase array (``aggregate``), so no
    shuffle or sort by document is needed; appends stop at the budget, so the
    fold's work is bounded by ``budget / min_chars`` kept phrases.
    Output: ``(id, pos, phrase, n_chars, cum_chars)``.
    """
    phrases, cums = _budget_fold(text_col, delimiter, budget, min_chars)
    kept = F.arrays_zip(F.slice(phrases, 1, F.size(cums)).alias("phrase"), cums.alias("cum"))
    exploded = corpus.select(F.col(id_col), F.posexplode(kept).alias("pos", "_k"))
    return exploded.select(
        F.col(id_col),
        F.col("pos").cast("long").alias("pos"),
        F.col("_k.phrase").alias("phrase"),
        F.length(F.col("_k.phrase")).cast("long").alias("n_chars"),
        F.col("_k.cum").alias("cum_chars"),
    )


def upsert_latest(df: DataFrame, key_cols: Sequence[str], order_col: str) -> DataFrame:
    """Overwrite-by-key: for each key keep the row with the greatest ``order_col`` (ties: the greatest
    other columns, in column order).

    ``max`` of a struct is a declarative aggregate, so each map task
    pre-aggregates to one row per key before the shuffle: a key holding a
    third of all rows costs one row per map task, not a third of the data in
    one task (which a ``row_number`` window would do). Its buffer is a struct,
    so the plan is a sort aggregate.
    """
    others = [order_col, *[c for c in df.columns if c not in (*key_cols, order_col)]]
    best = F.max(F.struct(*[F.col(c) for c in others])).alias("_best")
    return df.groupBy(*key_cols).agg(best).select(
        *[F.col(c) if c in key_cols else F.col(f"_best.{c}").alias(c) for c in df.columns])


def take_first(corpus: DataFrame, n: int, order_cols: Sequence[str]) -> DataFrame:
    """``take(n)`` with a stated order (top-k: the limit is the feature)."""
    return corpus.orderBy(*order_cols).limit(n)
