"""Sequence-array shaping as Column expressions (higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values ------------------------------------------------------------
IGNORE_INDEX = -100
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_truncate(ids, length, pad) -> Column:
    """Cut to ``length`` and right-pad with ``pad``."""
    n = length if isinstance(length, Column) else F.lit(length)
    p = pad if isinstance(pad, Column) else F.lit(pad)
    return F.slice(F.concat(_col(ids), F.array_repeat(p, n)), 1, n)


def attention_mask(ids, length) -> Column:
    """1 on real positions, 0 on padding, for ``pad_truncate(ids, length, _)``."""
    n = length if isinstance(length, Column) else F.lit(length)
    ones = F.array_repeat(F.lit(1), F.size(_col(ids)))
    return F.slice(F.concat(ones, F.array_repeat(F.lit(0), n)), 1, n)


def mask_value(ids, value, replacement: int = IGNORE_INDEX) -> Column:
    """Replace every element equal to ``value`` (by value, as the reference)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.transform(_col(ids), lambda x: F.when(x == v, F.lit(replacement)).otherwise(x))


def unmask(ids, pad, masked: int = IGNORE_INDEX) -> Column:
    """Reverse of ``mask_value``: ignore index -> pad before decoding."""
    p = pad if isinstance(pad, Column) else F.lit(pad)
    return F.transform(_col(ids), lambda x: F.when(x == F.lit(masked), p).otherwise(x))


def drop_prefix(out_ids, prompt_ids) -> Column:
    """Generated ids without the echoed prompt: ``out[len(prompt):]``."""
    out = _col(out_ids)
    start = F.size(_col(prompt_ids)) + 1
    return F.slice(out, start, F.greatest(F.size(out) - F.size(_col(prompt_ids)), F.lit(0)))


def argmax(values) -> Column:
    """0-based index of the first maximum (numpy ``argmax``); null for empty."""
    v = _col(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")
