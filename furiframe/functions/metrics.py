"""Character error rate and report formatting as Column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furiframe.functions.text import score_normalize


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bit_parallel_distance(a: str, b: str) -> int:
    """Levenshtein distance on code points: one column of the n x m table at a time, as the bits of two integers.

    ``up`` and ``down`` mark where a column's value grows or falls by one from
    the row above; a step is a dozen integer operations on n bits.
    """
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    at: dict[str, int] = {}
    bit = 1
    for c in a:
        at[c] = at.get(c, 0) | bit
        bit <<= 1
    full, last = bit - 1, bit >> 1
    up, down, distance = full, 0, len(a)
    for c in b:
        same = at.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same
        right_up = down | ~(diagonal | up)
        right_down = up & diagonal
        if right_up & last:
            distance += 1
        elif right_down & last:
            distance -= 1
        right_up = (right_up << 1) | 1
        either = same | down
        up = ((right_down << 1) | ~(either | right_up)) & full
        down = right_up & either & full
    return distance


def _word_distances(a: list[str], b: list[str], words: int) -> np.ndarray:
    """:func:`bit_parallel_distance` for many pairs at once; no ``a`` is shorter than its ``b`` or longer than
    ``64 * words`` code points, and the pairs come by falling length of ``b``."""
    n, width = len(a), 64 * words
    def points(texts: list[str], size: int, pad: int) -> np.ndarray:
        out = np.full((len(texts), size), pad, np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        out[np.arange(size) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        return out

    size_a, size_b = (np.fromiter(map(len, x), np.int64, n) for x in (a, b))
    rows, cols = points(a, width, 0xFFFFFFFF), points(b, int(size_b[0]), 0xFFFFFFFE).T.copy()
    active = np.searchsorted(-size_b, -np.arange(cols.shape[0]), side="left")  # pairs whose b has a place j
    top = (size_a - 1) // 64
    last = np.uint64(1) << ((size_a - 1) % 64).astype(np.uint64)
    up, down, distance = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64), size_a.copy()
    one, high = np.uint64(1), np.uint64(63)
    for j in range(cols.shape[0]):
        k = int(active[j])
        same = np.packbits(rows[:k] == cols[j, :k, None], axis=1, bitorder="little").view(np.uint64).T
        carry = np.zeros(k, np.uint64)
        into_up, into_down = np.ones(k, np.uint64), np.zeros(k, np.uint64)
        for w in range(words):
            u, d, eq = up[w, :k], down[w, :k], same[w]
            part = (eq & u) + u
            total = part + carry
            carry = ((part < u) | (total < part)).astype(np.uint64)
            diagonal = (total ^ u) | eq
            right_up, right_down = d | ~(diagonal | u), u & diagonal
            ends = top[:k] == w
            distance[:k] += (ends & ((right_up & last[:k]) != 0)).astype(np.int64) - (ends & ((right_down & last[:k]) != 0))
            shifted_up, shifted_down = (right_up << one) | into_up, (right_down << one) | into_down
            into_up, into_down = right_up >> high, right_down >> high
            either = eq | d
            up[w, :k] = shifted_down | ~(either | shifted_up)
            down[w, :k] = shifted_up & either
    return distance


def distances(a: list[str | None], b: list[str | None], words: int = 8, pairs: int = 4096) -> list[int | None]:
    """Levenshtein distances of many pairs (null where a text is): up to ``64 * words`` code points by blocks of
    ``pairs`` pairs of like length, longer ones and small groups one by one."""
    out: list[int | None] = [None] * len(a)
    sized: dict[int, list[tuple[str, str, int]]] = {}
    for i, (x, y) in enumerate(zip(a, b)):
        if x is None or y is None:
            continue
        x, y = (x, y) if len(x) >= len(y) else (y, x)
        if not y or len(x) > 64 * words:
            out[i] = bit_parallel_distance(x, y)
        else:
            sized.setdefault((len(x) + 63) // 64, []).append((x, y, i))
    for w, group in sized.items():
        if len(group) < 8 * w:  # too few to share the cost of an array operation
            for x, y, i in group:
                out[i] = bit_parallel_distance(x, y)
            continue
        group.sort(key=lambda p: -len(p[1]))
        for s in range(0, len(group), pairs):
            xs, ys, at = zip(*group[s: s + pairs])
            for i, d in zip(at, _word_distances(xs, ys, w).tolist()):
                out[i] = d
    return out


AHEAD_CHARS = 8_000_000  # of the pairs read ahead


@F.pandas_udf(T.IntegerType())
def _distances(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Several Arrow batches together: pairs of like length then fill the blocks of :func:`distances`."""
    a: list[str | None] = []
    b: list[str | None] = []
    chars = 0
    for x, y in batches:
        a.extend(x.tolist())
        b.extend(y.tolist())
        chars += sum(len(t) for t in a[-len(x):] if t is not None) if len(x) else 0
        if chars >= AHEAD_CHARS:
            yield pd.Series(distances(a, b), dtype="Int32")
            a, b, chars = [], [], 0
    if a:
        yield pd.Series(distances(a, b), dtype="Int32")


def edit_distance(a, b) -> Column:
    """Levenshtein distance on code points, exact; null where a text is null.

    Equal texts, and a text that starts or ends the other (the lower bound
    ``|n - m|``), are answered in the JVM; the others go in Arrow batches to
    :func:`distances`, n * m / 64 steps where the built-in table takes
    n * m (a built-in threshold costs as much at the edit rates here).
    """
    a, b = _col(a), _col(b)
    affix = a.startswith(b) | b.startswith(a) | a.endswith(b) | b.endswith(a)
    hard = ~affix
    return F.when(affix, F.abs(F.length(a) - F.length(b))).otherwise(_distances(F.when(hard, a), F.when(hard, b)))


def cer_from_parts(edits, ref_len, hyp_len) -> Column:
    """CER: empty reference -> 1.0 if the prediction is non-empty else 0.0."""
    return (
        F.when(_col(ref_len) == 0, F.when(_col(hyp_len) > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(_col(edits).cast("double") / _col(ref_len).cast("double"))
    )


def cer(truth, hypothesis) -> Column:
    """Character error rate of two raw texts (strip, CRLF->LF, then distance)."""
    t = score_normalize(truth)
    h = score_normalize(hypothesis)
    return cer_from_parts(edit_distance(t, h), F.length(t), F.length(h))


def percent(x, digits: int = 2) -> Column:
    """Python ``f'{x:.2%}'``: half-even rounding of 100*x, then fixed digits."""
    scaled = F.bround(_col(x).cast("double") * F.lit(100.0), digits)
    return F.format_string(f"%.{digits}f%%", scaled)


def pad_right(c, width: int) -> Column:
    """``f'{s:<width}'``: pads, never truncates."""
    s = _col(c)
    return F.rpad(s, F.greatest(F.lit(width), F.length(s)), " ")


def pad_left(c, width: int) -> Column:
    """``f'{s:>width}'``: pads, never truncates."""
    s = _col(c)
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), " ")
