"""SQL fragments for the DuckDB oracle queries (the independent check).

These mirror the Column helpers in ``furiframe.functions`` in plain SQL so
every registered query has a second, engine-independent formulation.
"""

from __future__ import annotations

# White space of Python's str.strip(), spelt out by code point (not taken from the code under test).
_SPACES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]


def strip(x: str) -> str:
    return f"trim({x}, {' || '.join(f'chr({c})' for c in _SPACES)})"


def normalize(x: str) -> str:
    return f"replace({strip(x)}, chr(13) || chr(10), chr(10))"


def segments(delim: str = ".", table: str = "documents", max_chars: int | None = None) -> str:
    """Split, strip, drop empty, re-index, re-append delimiter, cut (if asked to)."""
    whole = f"s || '{delim}'" if max_chars is None else f"left(s || '{delim}', {max_chars})"
    return f"""
    SELECT doc_id,
           CAST(row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS BIGINT) AS seq,
           {whole} AS text
    FROM (
      SELECT doc_id, idx, {strip('part')} AS s
      FROM (
        SELECT doc_id,
               unnest(string_split(coalesce(text, ''), '{delim}')) AS part,
               generate_subscripts(string_split(coalesce(text, ''), '{delim}'), 1) AS idx
        FROM {table}
      )
    )
    WHERE length(s) > 0
    """


def _encode(x: str) -> str:
    return (f"CASE WHEN {x} = '' THEN '' ELSE "
            f"array_to_string(list_transform(string_split({x}, ''), lambda ch: m[ch]), '') END")


def score_pairs(pairs: str, keys: str) -> str:
    """Per-pair CER over a relation ``pairs(keys..., t, h)`` of normalised texts.

    DuckDB's ``levenshtein`` counts bytes, so each pair's distinct characters
    are first renamed to single ASCII bytes (a bijection per pair); the byte
    distance of the renamed strings equals the code-point distance.
    Returns ``(keys..., edits, ref_len, cer)``.
    """
    return f"""
    WITH p AS ({pairs}),
    chars AS (
      SELECT {keys}, c, row_number() OVER (PARTITION BY {keys} ORDER BY c) AS r
      FROM (SELECT DISTINCT {keys}, unnest(string_split(t || h, '')) AS c FROM p)
      WHERE c <> ''
    ),
    maps AS (
      SELECT {keys}, map(list(c ORDER BY r), list(chr(CAST(r AS INTEGER)) ORDER BY r)) AS m
      FROM chars GROUP BY {keys}
    ),
    d AS (
      SELECT p.*, CAST(levenshtein({_encode('t')}, {_encode('h')}) AS BIGINT) AS edits
      FROM p LEFT JOIN maps USING ({keys})
    )
    SELECT {keys}, edits, CAST(length(t) AS BIGINT) AS ref_len,
           CASE WHEN length(t) = 0 THEN (CASE WHEN length(h) > 0 THEN 1.0 ELSE 0.0 END)
                ELSE CAST(edits AS DOUBLE) / CAST(length(t) AS DOUBLE) END AS cer
    FROM d
    """


def sql_lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"
