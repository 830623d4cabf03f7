"""Quality classifier: EM over overlapping heuristic labellers, and a hashed linear scorer on its posterior."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furiframe.llm.common import bounded_sample, one_text_each, text_or_empty
from furiframe.llm.linear import fit_logistic, sigmoid

# Byte classes. 0 other white space, 1 line feed, 2 lower case and bytes over 127, 3 upper
# case, 4 digit, 5 to 12 single marks, 13 brackets and quotes, 14 symbols, 15 control bytes.
_MARKS = ".,!?|-:;"
_CLASS = np.full(256, 14, np.uint8)
_CLASS[:32] = 15
for _c, _set in ((0, " \t\x0b\x0c\r"), (1, "\n"), (2, "abcdefghijklmnopqrstuvwxyz"),
                 (3, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (4, "0123456789"), (13, "()[]{}\"'")):
    _CLASS[list(_set.encode())] = _c
for _i, _m in enumerate(_MARKS):
    _CLASS[ord(_m)] = 5 + _i
_CLASS[128:] = 2

_SHAPES = 4096  # buckets of hashed class trigrams
_STATS = 11  # statistics of a text
_BINS = 16  # buckets of each statistic
BUCKETS = _SHAPES + _STATS * _BINS
_LONE = [m << 4 for m in range(5, 16)]
_TRIPLE = [m << 8 | m << 4 | m for m in range(5, 16)]


def describe(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(statistics, hashed features, their values) of one whole text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    c = _CLASS[raw]
    by_class = np.bincount(c, minlength=16)
    words = text.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    letters = max(by_class[2] + by_class[3], 1)
    lines = text.split("\n")
    shapes = np.zeros(_SHAPES, np.int64)
    for at in range(0, len(c) - 2, 1 << 20):
        part = c[at: at + (1 << 20) + 2].astype(np.intp)
        shapes += np.bincount((part[:-2] << 8) | (part[1:-1] << 4) | part[2:], minlength=_SHAPES)
    stats = np.array([
        by_class[14] / size,  # symbols
        by_class[3] / letters,  # upper case
        by_class[7] / n,  # exclamation marks a word
        sum(map(eq, words, words[1:])) / n,  # a word after itself
        1 - len(set(words)) / n ** 0.9 if n >= 50 else 0.0,  # few distinct words, for the length
        by_class[9] / n,  # separators a word
        1 - len(set(lines)) / len(lines),  # repeated lines
        abs(by_class[2] + by_class[3] + by_class[4] - 6.0 * n) / size if len(words) else 1.0,  # odd word length
        (by_class[5] + by_class[7] + by_class[8]) / n if n >= 10 else 0.1,  # sentence ends a word
        shapes[_LONE].sum() / n,  # marks between blanks, a word
        shapes[_TRIPLE].sum() / n,  # the same mark three times, a word
    ])
    some = np.flatnonzero(shapes)
    bins = np.minimum((np.sqrt(np.clip(stats, 0, 1)) * _BINS).astype(int), _BINS - 1)
    at = np.concatenate([some, _SHAPES + np.arange(_STATS) * _BINS + bins]).astype(np.int32)
    value = np.concatenate([np.sqrt(shapes[some] / (size + 64)), np.full(_STATS, 0.5)]).astype(np.float32)
    return stats, at, value


# (statistic, good up to, bad from): between the two a labeller abstains.
LABELLERS = ((0, 0.01, 0.06), (1, 0.25, 0.6), (2, 0.05, 0.3), (3, 0.05, 0.2), (4, 0.45, 0.75), (5, 0.05, 0.25),
             (6, 0.35, 0.5), (7, 0.35, 0.75), (8, 0.35, 0.9), (9, 0.02, 0.2), (10, 0.02, 0.2))
N_LABELLERS = len(LABELLERS)


def votes_of(stats: np.ndarray) -> np.ndarray:
    """-1 bad, 0 abstains, 1 good."""
    return np.array([1 if stats[i] <= good else -1 if stats[i] >= bad else 0 for i, good, bad in LABELLERS], np.int8)


def pattern_of(votes: np.ndarray) -> int:
    return int(sum((int(v) + 1) * 3**i for i, v in enumerate(votes)))


def votes_from(pattern: int) -> list[int]:
    return [(pattern // 3**i) % 3 - 1 for i in range(N_LABELLERS)]


def fit_label_model(counts: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], np.ndarray]:
    """P(good) for each vote pattern and P(vote | class) of each labeller, by EM over all rows' patterns.

    ``counts`` has at most 3 ** labellers entries, whatever the corpus. The
    prior of a labeller (half as heavy as the class itself) says that it
    seldom calls a good text bad; accuracies move from there with the data.
    """
    if not counts:
        return {}, np.full((N_LABELLERS, 3, 2), 1 / 3)
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], np.float64)
    votes = np.array([votes_from(p) for p in patterns]) + 1
    q = np.where((votes == 0).any(axis=1), 0.2, 0.95)
    prior = np.array([[0.3, 0.005], [0.1, 0.045], [0.6, 0.95]])  # vote bad, none, good; class bad, good
    table = np.empty((N_LABELLERS, 3, 2))
    for _ in range(rounds):
        mass = np.array([(n * (1 - q)).sum(), (n * q).sum()]) + 1.0
        for j in range(N_LABELLERS):
            for k in range(3):
                at = votes[:, j] == k
                table[j, k] = (n[at] * (1 - q[at])).sum(), (n[at] * q[at]).sum()
        table += 0.5 * mass * prior
        table /= table.sum(axis=1, keepdims=True)
        z = np.log(mass[1] / mass[0])
        for j in range(N_LABELLERS):
            z = z + np.log(table[j, votes[:, j], 1] / table[j, votes[:, j], 0])
        new = sigmoid(z)
        if np.abs(new - q).max() < 1e-7:
            break
        q = new
    return dict(zip(patterns, q.tolist())), table


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    accuracies: np.ndarray  # (labeller, vote, class)


def fit_quality(docs: DataFrame, fit_rows: int = 6000) -> QualityModel:
    """Fit the label model on the votes over all rows, and the scorer on at most ``fit_rows`` rows
    (a fixed hash sample of the ids); no label of the ``labels`` table is used.

    Without a row whose id is not null (an empty table as well) there is no
    sample: weights are zero and every text passes with the bias of 2.
    """
    rows = docs.select(text_or_empty("text").alias("_ff_text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(
                [pattern_of(votes_of(describe(t.as_py())[0])) for t in b.column(0)], pa.int32())], ["pattern"])

    counts = {r["pattern"]: r["n"] for r in rows.mapInArrow(vote, "pattern int").groupBy("pattern")
              .agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 3 ** labellers rows
    posterior, table = fit_label_model(counts)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [describe(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([
                pa.array([pattern_of(votes_of(s)) for s, _, _ in found], pa.int32()),
                pa.array([f for _, f, _ in found], pa.list_(pa.int32())),
                pa.array([v for _, _, v in found], pa.list_(pa.float32()))], ["pattern", "at", "value"])

    picked = bounded_sample(docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), F.col("doc_id"), fit_rows)
    sample = (one_text_each(docs.select("doc_id", text_or_empty("text").alias("_ff_text")).join(F.broadcast(picked), "doc_id"), "doc_id")
              .select("_ff_text").mapInArrow(features, "pattern int, at array<int>, value array<float>").collect())
    weights, bias = np.zeros(BUCKETS, np.float32), 2.0
    if sample:
        sample.sort(key=lambda r: (r["pattern"], r["at"], r["value"]))
        x = np.zeros((len(sample), BUCKETS), np.float32)
        for i, r in enumerate(sample):
            x[i, r["at"]] = r["value"]
        used = np.flatnonzero(x.any(axis=0))
        y = np.array([posterior[r["pattern"]] for r in sample])
        w, bias = fit_logistic(x[:, used], y, l2=1e-4)
        weights[used] = w
    return QualityModel(weights, bias, table)


def quality_column(text: Column, model: QualityModel) -> Column:
    """Column form: P(good) of a whole text."""
    weights, bias = model.weights, model.bias

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        z = np.empty(len(texts))
        for i, t in enumerate(texts):
            _, at, value = describe(t)
            z[i] = float(weights[at] @ value) + bias
        return pd.Series(sigmoid(z))

    return of(text_or_empty(text))


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.5, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, score, kept) of every row: P(good) from its whole text, kept from ``threshold`` on.

    A null or empty text has only the bias and the statistics of nothing. Null
    ids and repeated rows are scored row by row; an empty table gives an empty
    result; no other column is read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), quality_column(F.col(text_col), model).alias("score"))
    return rows.select("doc_id", "score", (F.col("score") >= threshold).alias("kept"))
