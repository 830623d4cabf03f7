"""Column -> Column text helpers (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference's behaviour) --------------------
# Characters Python's str.strip() removes (str.isspace).
PY_WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Numeral string: a surface that is a contiguous substring of it gets no reading.
NUMERALS = "一二三四五六七八九十０１２３４５６７８９"
# Leading characters that suppress ruby output.
ASCII_DIGITS = "0123456789"
# Analyzer input escape: newline -> space, fullwidth tilde -> '~', line-break tags.
ESCAPE_FROM, ESCAPE_TO = "\n～", " ~"
BREAK_TAG_PATTERN, BREAK_TAG = "<br( /)?>", "<br>"
# Id given to a corpus record without one (followed by its 1-based position).
FALLBACK_ID_PREFIX = "unknown_id_"
# Default sentence delimiter, segment length cap and the per-file annotation budget.
SENTENCE_DELIMITER = "。"
SEGMENT_MAX_CHARS = 100
ANNOTATION_BUDGET = 2000
# Ruby markup and HTML forms.
RUBY_SPAN_PATTERN = r"\[([^\]]+)\]\{([^\}]+)\}"
RUBY_HTML_REPLACEMENT = "<ruby><rb>$1</rb><rt>$2</rt></ruby>"
# ---------------------------------------------------------------------------

# Katakana U+30A1..U+30F6 map to hiragana U+3041..U+3096 (fixed offset 0x60).
KATAKANA = "".join(chr(c) for c in range(0x30A1, 0x30F7))
HIRAGANA = "".join(chr(c - 0x60) for c in range(0x30A1, 0x30F7))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_quote(text: str) -> str:
    """Escape every non-alphanumeric character so ``text`` matches literally."""
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in text)


def py_strip(c) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace incl. U+3000, U+0085, U+001C..
    (``btrim`` with the character set: only the two ends are examined)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE_CHARS))


def split_literal(c, delimiter: str) -> Column:
    """Python ``str.split(delimiter)``: literal delimiter, empty pieces kept."""
    return F.split(_col(c), regex_quote(delimiter), -1)


def normalize_eol(c) -> Column:
    """CRLF -> LF."""
    return F.replace(_col(c), F.lit("\r\n"), F.lit("\n"))


def score_normalize(c) -> Column:
    """Scoring normal form: strip, then CRLF -> LF."""
    return normalize_eol(py_strip(c))


def escape_text(c) -> Column:
    """Analyzer input escape: newline -> space, U+FF5E -> '~', '<br />' -> '<br>'."""
    folded = F.translate(_col(c), ESCAPE_FROM, ESCAPE_TO)
    return F.regexp_replace(folded, BREAK_TAG_PATTERN, BREAK_TAG)


def kana_fold(c) -> Column:
    """Katakana -> hiragana (the prolonged sound mark is kept)."""
    return F.translate(_col(c), KATAKANA, HIRAGANA)


def is_numeral(c) -> Column:
    """True when the surface is a contiguous substring of the numeral string."""
    return F.lit(NUMERALS).contains(_col(c))


def slice_key(c, start: int = 10, stop_from_end: int = 1) -> Column:
    """Python ``s[start:-stop_from_end]`` on code points."""
    s = _col(c)
    n = F.greatest(F.length(s) - F.lit(start + stop_from_end), F.lit(0))
    return F.substr(s, F.lit(start + 1), n)


def file_name(c) -> Column:
    """Last path component."""
    return F.regexp_extract(_col(c), r"[^/]*$", 0)


def stem(c) -> Column:
    """Path stem: drop the last suffix; a leading dot is not a suffix."""
    return F.regexp_replace(_col(c), r"(.)\.[^.]+$", "$1")


def suffix(c) -> Column:
    """Path suffix including the dot, '' when there is none."""
    return F.regexp_extract(_col(c), r".(\.[^.]+)$", 1)


def with_suffix(c, new_suffix: str) -> Column:
    return F.concat(stem(c), F.lit(new_suffix))


def encodable(encoding: str) -> str:
    """All characters that a codec can represent, in code point order (from the codec itself)."""
    return "".join(c for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]) if c.encode(encoding, "ignore"))


def charset_filter(c, encoding: str = "euc_jp") -> Column:
    """Drop the characters ``encoding`` cannot represent ('ignore'), as the
    analyzer pipes did for EUC-JP / Shift_JIS. Spark's ``encode`` rejects
    these charsets, so the text without its representable characters gives
    the ones to delete; all in the JVM."""
    text = _col(c)
    foreign = F.translate(text, encodable(encoding), "")
    return F.call_function("translate", text, foreign, F.lit(""))
