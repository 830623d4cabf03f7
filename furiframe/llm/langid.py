"""Language identification by a byte convolutional network, trained and applied in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furiframe.llm.common import bounded_sample, held_out, one_text_each, text_or_empty

WINDOW = 256  # bytes; every text is cut into windows of this length, the last one padded with zeros
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 6
UNDETERMINED = "und"
_CHUNK = 64  # windows scored at once, so that the intermediate arrays stay in the cache


def windows_of(text: bytes) -> np.ndarray:
    """The whole text as (n, WINDOW) bytes, n >= 1."""
    n = max(1, -(-len(text) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


@dataclass
class ByteCnn:
    """Embedding, one bank of filters per width, and a softmax layer over the pooled filters."""

    langs: list[str]
    embed: np.ndarray  # (256, EMBEDDING)
    filters: list[np.ndarray]  # per width: (width, EMBEDDING, FILTERS)
    shift: list[np.ndarray]  # per width: (FILTERS,)
    dense: np.ndarray  # (len(WIDTHS) * FILTERS, langs)
    dense_shift: np.ndarray
    letters: str = ""  # met in training, in both cases


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_cnn(x: np.ndarray, y: np.ndarray, langs: list[str], steps: int = 700, batch: int = 128, rate: float = 0.004) -> ByteCnn:
    """Adam on the cross entropy; ``x`` (n, WINDOW) bytes, ``y`` indexes of ``langs``.

    Max pooling passes a filter's gradient to one place a window, so the
    backward pass only touches the patches at those places.
    """
    rng = np.random.default_rng(7)
    k = len(langs)
    p = {"e": rng.normal(0, 0.5, (256, EMBEDDING)), "d": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, k)), "c": np.zeros(k)}
    for w in WIDTHS:
        p[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    p = {n: v.astype(np.float32) for n, v in p.items()}
    m, v = {n: np.zeros_like(a) for n, a in p.items()}, {n: np.zeros_like(a) for n, a in p.items()}
    weight = len(y) / (k * np.maximum(np.bincount(y, minlength=k), 1))  # classes count alike
    t = 0
    for _ in range(-(-steps * batch // len(x))):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            xb, yb = x[order[at: at + batch]], y[order[at: at + batch]]
            n, e = len(xb), p["e"][xb]
            pooled, where = [], []
            for w in WIDTHS:
                h = sum(e[:, j: WINDOW - w + 1 + j] @ p[f"f{w}"][j] for j in range(w))
                top = h.argmax(axis=1)  # (n, FILTERS)
                where.append(top)
                pooled.append(np.take_along_axis(h, top[:, None, :], axis=1)[:, 0] + p[f"b{w}"])
            raw = np.concatenate(pooled, axis=1)
            act = np.maximum(raw, 0)
            prob = _softmax(act @ p["d"] + p["c"])
            dz = prob
            dz[np.arange(n), yb] -= 1
            dz *= (weight[yb] / n)[:, None].astype(np.float32)
            g = {name: np.zeros_like(a) for name, a in p.items()}
            g["d"], g["c"] = act.T @ dz, dz.sum(axis=0)
            dact = (dz @ p["d"].T) * (raw > 0)
            rows = np.arange(n)[:, None]
            for i, w in enumerate(WIDTHS):
                da = dact[:, i * FILTERS: (i + 1) * FILTERS]
                g[f"b{w}"] = da.sum(axis=0)
                for j in range(w):
                    byte = xb[rows, where[i] + j]  # (n, FILTERS)
                    g[f"f{w}"][j] = np.einsum("nfe,nf->ef", p["e"][byte], da)
                    for d in range(EMBEDDING):
                        g["e"][:, d] += np.bincount(byte.ravel(), (da * p[f"f{w}"][j][d]).ravel(), 256).astype(np.float32)
            t += 1
            for name in p:
                m[name] = 0.9 * m[name] + 0.1 * g[name]
                v[name] = 0.999 * v[name] + 0.001 * g[name] ** 2
                p[name] -= (rate * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return ByteCnn(langs, p["e"], [p[f"f{w}"] for w in WIDTHS], [p[f"b{w}"] for w in WIDTHS], p["d"], p["c"])


class _Scorer:
    """The trained convolution as table look-ups: what a filter gives for a byte pair is tabulated."""

    def __init__(self, model: ByteCnn):
        def single(f: np.ndarray) -> np.ndarray:
            return model.embed @ f  # (256, FILTERS)

        def pair(f: np.ndarray) -> np.ndarray:  # index: first byte * 256 + second
            return (single(f[0])[:, None, :] + single(f[1])[None, :, :]).reshape(65536, -1)

        self.model = model
        f2, f3, f4 = model.filters
        self.two, self.three, self.last = pair(f2), pair(f3[:2]), single(f3[2])
        self.four, self.rest = pair(f4[:2]), pair(f4[2:])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Softmax of each window."""
        out = []
        for at in range(0, len(x), _CHUNK):
            b = x[at: at + _CHUNK]
            pairs = (b[:, :-1].astype(np.intp) << 8) | b[:, 1:]
            two = self.two.take(pairs, axis=0).max(axis=1)
            h = self.three.take(pairs[:, :-1], axis=0)
            h += self.last.take(b[:, 2:].astype(np.intp), axis=0)
            three = h.max(axis=1)
            h = self.four.take(pairs[:, :-2], axis=0)
            h += self.rest.take(pairs[:, 2:], axis=0)
            raw = np.concatenate([two, three, h.max(axis=1)], axis=1) + np.concatenate(self.model.shift)
            out.append(_softmax(np.maximum(raw, 0) @ self.model.dense + self.model.dense_shift))
        return np.concatenate(out)


def fit_language_id(docs: DataFrame, fit_rows: int = 4000, windows_a_row: int = 4) -> ByteCnn | None:
    """Train on at most ``fit_rows`` rows with a language outside the held-out ids (a fixed hash
    sample) and at most ``windows_a_row`` windows of each, spread over the text; None without any row."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")
                       ).select("doc_id", "lang").distinct()
    picked = bounded_sample(known, F.concat_ws("|", F.col("doc_id").cast("string"), "lang"), fit_rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, found = [], []
            for name, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = text.as_py().encode()
                w = windows_of(raw)
                at = np.unique(np.linspace(0, len(w) - 1, windows_a_row).astype(int))
                seed = zlib.crc32(raw)
                for j in at:
                    one, draw = w[j].copy(), seed // 7 + 31 * int(j)
                    if draw % 4 == 0:  # short texts are met as well
                        one[8 + draw // 4 % (WINDOW - 8):] = 0
                    if draw % 7 == 0:  # and upper case
                        upper = np.frombuffer(one.tobytes().decode("utf-8", "ignore").upper().encode()[:WINDOW], np.uint8)
                        one = np.append(upper, np.zeros(WINDOW - len(upper), np.uint8))
                    lang.append(name)
                    found.append(one.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(found, pa.binary())], ["lang", "window"])

    rows = (one_text_each(docs.select("doc_id", "lang", text_or_empty("text").alias("_ff_text")).where(F.col("_ff_text").rlike(r"\p{L}"))
                          .join(F.broadcast(picked), ["doc_id", "lang"]), "doc_id", "lang").select("lang", "_ff_text")
            .mapInArrow(cut, "lang string, window binary").collect())
    if not rows:
        return None
    rows = sorted((r["lang"], bytes(r["window"])) for r in rows)
    langs = sorted({r[0] for r in rows})
    x = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(-1, WINDOW)
    y = np.array([langs.index(r[0]) for r in rows])
    model = train_cnn(x, y, langs)
    met = {c for r in rows for c in r[1].decode("utf-8", "ignore") if c.isalpha()}
    model.letters = "".join(sorted({x for c in met for x in c + c.lower() + c.upper()}))
    return model


def known_script(text: Column, letters: str) -> Column:
    """Column form: true where at least half of a text's letters are among ``letters`` (also without a letter)."""
    text = text_or_empty(text)
    rest = F.translate(text, letters, "")
    return F.length(F.regexp_replace(rest, r"\P{L}+", "")) <= F.length(text) - F.length(rest)


def language_column(text: Column, model: ByteCnn | None) -> Column:
    """Column form: struct(lang, score) of a whole text, from all of its windows."""

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        scorer = _Scorer(model) if model is not None else None
        lang = np.full(len(texts), UNDETERMINED, object)
        score = np.zeros(len(texts))

        def flush(at: list[int], raw: list[bytes]) -> None:
            cuts = [windows_of(t) for t in raw]
            prob = scorer(np.concatenate(cuts))
            sizes = np.array([len(c) for c in cuts])
            ends = np.cumsum(sizes)
            weight = np.full(ends[-1], WINDOW, np.float64)
            weight[ends - 1] = [len(t) - (n - 1) * WINDOW for t, n in zip(raw, sizes)]
            total = np.add.reduceat(prob * weight[:, None], ends - sizes, axis=0)
            mean = total / total.sum(axis=1, keepdims=True)
            best = mean.argmax(axis=1)
            lang[at] = np.array(model.langs, object)[best]
            score[at] = mean[np.arange(len(best)), best]

        at: list[int] = []
        raw: list[bytes] = []
        size = 0
        for i, t in enumerate(texts):
            if t is None or scorer is None:
                continue
            at.append(i)
            raw.append(t.encode("utf-8", "surrogatepass"))
            size += len(raw[-1])
            if size > 1 << 20:
                flush(at, raw)
                at, raw, size = [], [], 0
        if at:
            flush(at, raw)
        return pd.DataFrame({"lang": lang, "score": score})

    return of(F.when(text.rlike(r"\p{L}"), text))


def predict_language(docs: DataFrame, model: ByteCnn | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from all windows of its whole text.

    ``score`` is the predicted language's probability, averaged over the
    windows by their bytes. Without a letter (also null or empty text), or
    without a model, the language is ``und`` with score 0. Null ids and
    repeated rows are scored row by row; an empty table gives an empty
    result; no other column is read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       language_column(F.col(text_col), model).alias("_ff_p"))
    return rows.select("doc_id", "held_out", F.col("_ff_p.lang").alias("lang_pred"), F.col("_ff_p.score").alias("score"))
