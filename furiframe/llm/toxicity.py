"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model,
and a linear classifier on its posterior labels."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furiframe.llm.common import bounded_sample, frozen, held_out, one_text_each, text_or_empty
from furiframe.llm.linear import fit_logistic, sigmoid

# Common English insults, the seed of the lexicon voters.
SEED_INSULTS = (
    "clown", "coward", "creep", "disgusting", "dumb", "filth", "fool", "garbage", "hate", "idiot", "imbecile",
    "jerk", "liar", "loser", "lunatic", "moron", "parasite", "pathetic", "pig", "psycho", "rat", "retard",
    "scum", "shit", "slut", "stupid", "trash", "ugly", "vermin", "whore", "worthless",
)

_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = {
    "~you": re.compile(r"\byou (?:are|re|all)\b"),
    "~masked": re.compile(r"\b[a-z]+\*+[a-z]*\b"),
    "~shout": re.compile(r"!{3,}"),
}
PREFIXES = (4, 5)


def tokens_of(text: str) -> set[str]:
    """What voters look at, once each: lower-cased words, word beginnings (``p4:``, ``p5:``) and patterns."""
    low = text.lower()
    words = set(_WORD.findall(low))
    out = set(words)
    for n in PREFIXES:
        out.update([f"p{n}:{w[:n]}" for w in words if len(w) > n])
    out.update(name for name, p in _PATTERNS.items() if p.search(low))
    return out


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by token and a bias; the score of a text is the sigmoid of the sum over its distinct tokens."""

    weights: dict[str, float]
    bias: float


def label_model(votes: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior P(toxic) of each row from its voters (0/1 per column), by EM over distinct vote patterns.

    A two-class mixture with P(voter fires | class) for every voter: its
    accuracy, with priors (half as heavy as the class) that voters seldom
    fire on clean rows. A voter that doesn't fire abstains; one more voter,
    for clean, fires where no other does. Correlations given the class are
    estimated from the residuals votes - E[votes | posterior]; in a row, a
    voter's evidence is divided by the sum of its correlations with the
    voters that fire there, so a word and its beginning count once together.
    """
    patterns, at, n = np.unique(votes.astype(bool), axis=0, return_inverse=True, return_counts=True)
    quiet = ~patterns.any(axis=1)
    fires = np.column_stack([patterns, quiet]).astype(np.float64)
    prior1 = np.append(np.full(votes.shape[1], 0.05), 0.05)
    prior0 = np.append(np.full(votes.shape[1], 0.0005), 0.97)
    q = np.where(quiet, 0.02, 0.9)
    for _ in range(rounds):
        w1, w0 = n * q, n * (1 - q)
        one, zero = w1.sum() + 1.0, w0.sum() + 1.0
        hit1 = (fires.T @ w1 + 0.5 * one * prior1) / (1.5 * one)
        hit0 = (fires.T @ w0 + 0.5 * zero * prior0) / (1.5 * zero)
        residual = (fires - q[:, None] * hit1 - (1 - q)[:, None] * hit0) * np.sqrt(n)[:, None]
        cov = residual.T @ residual
        sd = np.sqrt(np.diag(cov)) + 1e-9
        corr = np.clip(cov / np.outer(sd, sd), 0.0, 1.0)
        np.fill_diagonal(corr, 1.0)
        evidence = (fires * np.log(hit1 / hit0) / np.maximum(fires @ corr, 1.0)).sum(axis=1)
        new = sigmoid(np.log(one / zero) + evidence)
        if np.abs(new - q).max() < 1e-6:
            break
        q = new
    return q[at.ravel()]


def distinct_texts(rows: DataFrame) -> DataFrame:
    """One row of each group of copies: rows that share the smallest hash of three words in a row, under
    any of six hash functions, count once (else the rare words of a copied text look like evidence)."""
    words, w = rows.select("*", F.split("_ff_text", r"\s+").alias("_ff_w")), F.col("_ff_w")

    def least(seed: int) -> Column:
        return F.array_min(F.transform(w, lambda x, i: F.xxhash64(F.lit(seed), x, F.get(w, i + 1), F.get(w, i + 2))))

    keys = [f"_ff_{k}" for k in range(6)]
    first = words.select(*rows.columns, *[least(k).alias(c) for k, c in enumerate(keys)])
    for key in keys:
        own = F.struct("doc_id", *[c for c in first.columns if c != "doc_id"])
        first = first.groupBy(key).agg(F.min(own).alias("_ff_r")).select("_ff_r.*")
    return first.select("doc_id", "_ff_text", "_ff_toxic")


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = 12000, max_tokens: int = 1024,
                 max_voters: int = 256) -> ToxicityModel:
    """Fit on at most ``fit_rows`` labelled rows outside the held-out ids (a fixed hash sample;
    of rows that repeat an id the one with the smallest text).

    Tokens over-represented in toxic rows (log odds with a z-score, counted in
    Spark) become lexicon voters, next to the seed insults and the patterns;
    the label model turns their votes into posterior labels, and a logistic
    regression on all selected tokens learns from those. Without any labelled
    row, or without a toxic one, the seed insults alone score, each enough by
    itself; with toxic rows only, all tokens frequent in them may become voters.
    """
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").alias("_ff_toxic")))
    picked = bounded_sample(known, F.col("doc_id"), fit_rows)  # at most fit_rows rows: broadcast
    rows = frozen(distinct_texts(one_text_each(
        docs.select("doc_id", text_or_empty("text").alias("_ff_text")).join(F.broadcast(picked), "doc_id"), "doc_id", "_ff_toxic").select("doc_id", "_ff_text", "_ff_toxic")))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [sorted(tokens_of(t)) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(sets, pa.list_(pa.string()))], ["toxic", "tokens"])

    found = rows.select("_ff_text", F.col("_ff_toxic").cast("int")).mapInArrow(explode, "toxic int, tokens array<string>")
    counts = found.select("toxic", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("n1")).where("n1 >= 3")
    total = {int(r.toxic): int(r.n) for r in rows.groupBy(F.col("_ff_toxic").cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    a, c = F.col("n1"), F.col("n") - F.col("n1")
    odds = F.log((a + 0.5) / (n1 - a + 0.5)) - F.log((c + 0.5) / (n0 - c + 0.5))
    z = odds / F.sqrt(1 / (a + 0.5) + 1 / (c + 0.5))
    best = [r.token for r in counts.select("token", odds.alias("odds"), z.alias("z")).where("z >= 3.5 and odds >= 2.5")
            .orderBy(F.desc("z"), "token").limit(max_tokens).collect()]
    vocabulary = list(dict.fromkeys([*best, *SEED_INSULTS, *_PATTERNS]))
    index = {t: i for i, t in enumerate(vocabulary)}

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [[index[t] for t in tokens_of(x) if t in index] for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32()))], ["at"])

    fired = [r["at"] for r in rows.select("_ff_text").mapInArrow(vote, "at array<int>").collect()]  # at most fit_rows
    if not fired or not n1:
        return ToxicityModel({t: 4.0 for t in SEED_INSULTS}, -3.0)
    x = np.zeros((len(fired), len(vocabulary)), np.float32)
    for i, at in enumerate(sorted(map(sorted, fired))):
        x[i, at] = 1
    seeds = {index[t] for t in (*SEED_INSULTS, *_PATTERNS)}
    voters = sorted({*range(min(max_voters, len(best))), *seeds})
    y = label_model(x[:, voters])
    w, bias = fit_logistic(x, y, l2=1e-4, steps=1000, balance=True)
    return ToxicityModel({t: float(w[i]) for t, i in index.items() if abs(w[i]) > 1e-4}, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; whole texts, null counts as empty.

    Null ids, repeated rows and very long texts are scored row by row; an
    empty table gives an empty result; only ``doc_id`` and ``text`` are read.
    """
    words = {t: w for t, w in model.weights.items() if ":" not in t and not t.startswith("~")}
    heads = {n: {t.split(":", 1)[1]: w for t, w in model.weights.items() if t.startswith(f"p{n}:")} for n in PREFIXES}
    patterns = [(p, model.weights[k]) for k, p in _PATTERNS.items() if k in model.weights]
    bias = model.bias

    def one(text: str) -> float:
        low = text.lower()
        distinct = set(_WORD.findall(low))
        z = bias + sum(words[w] for w in words.keys() & distinct)
        for n, table in heads.items():
            if table:
                begun = {w[:n] for w in distinct if len(w) > n}
                z += sum(table[h] for h in table.keys() & begun)
        return z + sum(w for p, w in patterns if p.search(low))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = np.array([one(t.as_py()) for t in b.column(2)], np.float64)
            s = sigmoid(z)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), text_or_empty("text").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {id_type}, held_out boolean, score double, predicted int")
