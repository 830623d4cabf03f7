"""Corpus pipeline: language ID, quality classifier, line dedup, near-dedup and packing of ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furiframe.llm.common import frozen, text_batches, text_or_empty
from furiframe.llm.langid import UNDETERMINED, fit_language_id, known_script, language_column
from furiframe.llm.line_dedup import dedup_lines
from furiframe.llm.packing import pack_documents
from furiframe.llm.quality_model import fit_quality, quality_column
from furiframe.llm.simhash import keep_one

MIN_LANGUAGE_SCORE = 0.35  # texts in two languages stay
MIN_QUALITY = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, with more than half of their letters outside those the
    model was trained on, or without a language of some probability (operator 8).

    Where no row can train a model (no language outside the held-out ids),
    only documents without a letter go. Null and empty texts hold no letter and
    go; a null or repeated id is judged row by row, equal texts alike, long
    texts over all their windows; an empty table gives an empty one.
    """
    text_batches(spark)
    model = fit_language_id(docs)
    if model is None:
        return docs.where(text_or_empty("text").rlike(r"\p{L}"))
    found = docs.withColumns({"_ff_l": language_column(F.col("text"), model)})
    sure = (F.col("_ff_l.lang") != UNDETERMINED) & (F.col("_ff_l.score") >= MIN_LANGUAGE_SCORE)
    return found.where(sure & known_script(F.col("text"), model.letters)).drop("_ff_l")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are likelier bad than good (operator 9); a score of exactly ``MIN_QUALITY`` stays.

    A null text is scored as an empty one; every row has a score, whatever its
    id, equal texts the same, long texts whole. An empty table gives an empty one.
    """
    text_batches(spark)
    scored = docs.withColumns({"_ff_q": quality_column(F.col("text"), fit_quality(docs))})
    return scored.where(F.col("_ff_q") >= MIN_QUALITY).drop("_ff_q")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents stay at their first place by (doc_id, line) alone (operator 3); n_chars follows the text.

    Of a text in ten or more copies the first keeps its lines and the others
    are left with the lines that are their own, none for exact copies: those
    become empty texts, of which near-dedup leaves one. Null texts lose no
    line and stay null; every row counts as a document, also with a null or
    repeated id (rows alike in id and text keep the line alike); an empty
    table gives an empty one.
    """
    text_batches(spark)
    out = dedup_lines(docs, min_docs=10, min_chars=1, keep="first")
    cut = F.col("n_dropped") > 0
    new = {"text": F.when(cut, F.col("text")).otherwise(F.col("row.text")),
           "n_chars": F.when(cut, F.length("text").cast("long")).otherwise(F.col("row")["n_chars"])
           if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays (operator 6).

    Texts without a word (null, empty, white space) have fingerprint zero and
    are one group; rows alike in id (null ids among them) and text are one
    document, of which one row stays. An empty table gives an empty one.
    """
    text_batches(spark)
    return keep_one(docs, shingle=3, bits=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens (operator 4): one row a piece, long texts in pieces.

    A null or empty text is its end id alone; rows with a null or repeated id
    are packed each on its own. An empty table gives no piece.
    """
    text_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

# The classifiers and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
