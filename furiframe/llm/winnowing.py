"""Document fingerprints by winnowing, in DataFrame functions only.

All overlapping grams of ``k`` units are hashed, every window of consecutive
grams gives its smallest hash (of equal ones the rightmost), and each chosen
gram is kept once with its position. Units are words between ASCII white
space; characters of scripts without blanks between words are units of their
own. Two texts that share a run of ``window + k - 1`` units share a chosen
hash, and a text has about two chosen grams in ``window + 1``.

A chosen gram is one long: 32 bits of its hash above, the position counted
downwards below, so that a plain minimum takes the smallest hash and of equal
ones the rightmost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furiframe.llm.common import text_or_empty
from furiframe.operators.joins import range_rank

GRAM, WINDOW = 5, 8
_POSITIONS = (1 << 31) - 1
_SPACE = r"\x20\x09-\x0D"
# Thai to Myanmar and Khmer, Han with kana and bopomofo, Yi, compatibility forms, rarer Han.
_UNSPACED = r"\u0E00-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
_CUT = f"[{_SPACE}]+|(?<=[{_UNSPACED}])(?=[^{_SPACE}])|(?<=[^{_SPACE}])(?=[{_UNSPACED}])"


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and bind it for ``body``."""
    return F.get(F.transform(F.array(value), body), 0)


def units(text: str | Column) -> Column:
    """Words of a text, and single characters of scripts without blanks; none for a text without a unit."""
    t = text_or_empty(text)
    # The second pattern looks at both sides of every character: only for texts that need it.
    cut = F.when(t.rlike(f"[{_UNSPACED}]"), F.split(t, _CUT, -1)).otherwise(F.split(t, f"[{_SPACE}]+", -1))

    def inner(u: Column) -> Column:  # without the empty ends that white space there leaves
        first = F.when(F.get(u, 0) == "", 2).otherwise(1)
        last = F.when(F.get(u, F.size(u) - 1) == "", 1).otherwise(0)
        return F.slice(u, first, F.greatest(F.size(u) - last - first + 1, F.lit(0)))

    return _let(cut, inner)


def _choose(words: Column, k: int, window: int) -> Column:
    # A missing unit leaves a hash as it is: fewer than k units are one gram.
    packed = F.transform(words, lambda w, i: F.shiftleft(F.shiftright(F.xxhash64(
        w, *[F.get(words, i + j) for j in range(1, k)]), 32), 31) + (F.lit(_POSITIONS).cast("long") - i))
    grams = F.slice(packed, 1, F.greatest(F.size(words) - (k - 1), F.lit(1)))
    # Minima over 2, 4, 8, ... grams; past the end there is nothing smaller.
    shifts = [min(1 << j, window - (1 << j)) for j in range((window - 1).bit_length())]
    least = F.aggregate(F.array(*[F.lit(s) for s in shifts]).cast("array<int>"), grams, lambda m, s: F.zip_with(
        m, F.slice(m, s + 1, F.size(m)), lambda a, b: F.least(a, b)))
    return F.array_distinct(F.slice(least, 1, F.greatest(F.size(words) - (k + window - 2), F.lit(1))))


def winnow(text: str | Column, k: int = GRAM, window: int = WINDOW) -> Column:
    """The chosen grams of a whole text in order of position, packed (see :func:`unpack`).

    A text of fewer than ``k`` units is one gram, one of fewer than ``window``
    grams one window; null texts and texts without a unit have none. Equal
    texts choose equal grams at equal positions.
    """
    if k < 1 or window < 1:
        raise ValueError("k and window are at least 1")
    none = F.array().cast("array<long>")
    return _let(units(text), lambda u: F.when(F.size(u) == 0, none).otherwise(_choose(u, k, window)))


def unpack(chosen: str | Column) -> Column:
    """Packed grams as ``array<struct<hash:int, position:int>>``."""
    c = F.col(chosen) if isinstance(chosen, str) else chosen
    return F.transform(c, lambda v: F.struct(
        F.shiftright(v, 31).cast("int").alias("hash"), (F.lit(_POSITIONS) - v.bitwiseAND(F.lit(_POSITIONS))).cast("int").alias("position")))


def hashes(chosen: str | Column) -> Column:
    """The distinct hashes of packed grams."""
    c = F.col(chosen) if isinstance(chosen, str) else chosen
    return F.array_distinct(F.transform(c, lambda v: F.shiftright(v, 31).cast("int")))


def as_string(chosen: str | Column) -> Column:
    """``hash@position`` of the chosen grams, hashes in hex, joined by blanks."""
    return F.array_join(F.transform(unpack(chosen), lambda g: F.concat(F.hex(g["hash"]), F.lit("@"), g["position"].cast("string"))), " ")


def likeness(a: str | Column, b: str | Column) -> Column:
    """Shared hashes over all hashes of two hash sets; two empty sets are alike."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(both, F.lit(1)))


def fingerprints(docs: DataFrame, text_col: str = "text", k: int = GRAM, window: int = WINDOW, out: str = "grams") -> DataFrame:
    """``docs`` with ``out``: the chosen grams of each whole text with hash and position; a narrow step."""
    return docs.withColumn(out, unpack(winnow(text_col, k, window)))


def _neighbours(docs: DataFrame) -> DataFrame:
    """For each distinct (doc_id, text), as ``k1, k2``: its rows, and the key and length of the one before it in
    descending ``doc_id`` (nulls last, equal ids by the key's hash), the last being before the first."""
    order = [F.desc_nulls_last("doc_id"), F.asc("k1"), F.asc("k2")]
    distinct = docs.groupBy("doc_id", "k1", "k2").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    ranks = range_rank(distinct, order, "r").select("k1", "k2", "n", "copies", "r")
    total = ranks.count()
    before = ranks.select(F.col("k1").alias("to1"), F.col("k2").alias("to2"), F.col("n").alias("n_to"), F.pmod(F.col("r") + 1, F.lit(max(total, 1))).alias("r"))
    return ranks.select("k1", "k2", "copies", "r").join(before, "r").drop("r")


def edited_fingerprints(docs: DataFrame, k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each whole text, of its edited text, and how alike they are.

    The edited text has its last half (rounded down) of code points replaced
    by the first as many, or all, of the next document's in descending
    ``doc_id``; after the last comes the first. Returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    next_id``.

    Null texts count as empty and have an empty fingerprint; two empty
    fingerprints are alike (1.0), an empty and another one are not (0.0). Null
    ids come last, equal ids are ordered by a hash of their text. Rows alike
    in id and text count once in the order and get a row each, all the same.
    A single document is its own next one. An empty table gives no rows.
    Other columns are not read.

    A text is winnowed once where it is scanned and shuffled once by its key;
    its next document sends it the code points it needs and its hashes.
    """
    text = text_or_empty(F.col("text").cast("string"))
    key = [F.col("doc_id").isNull(), F.col("doc_id"), text]
    base = docs.select("doc_id", text.alias("text"), F.xxhash64(*key).alias("k1"), F.xxhash64(F.lit(1), *key).alias("k2"))
    near = _neighbours(base.select("doc_id", "k1", "k2", F.length("text").alias("n")))
    rows = base.withColumn("grams", winnow("text", k, window)).join(near, ["k1", "k2"])
    sent = rows.select("copies", F.col("to1").alias("k1"), F.col("to2").alias("k2"), F.col("doc_id").alias("next_id"),
                       F.left("text", F.floor(F.col("n_to") / 2).cast("int")).alias("head"), hashes("grams").alias("next_hashes"))
    # One row a key: only repeated rows have to be reduced.
    again = sent.where("copies > 1").groupBy("k1", "k2").agg(*[F.first(c).alias(c) for c in ("next_id", "head", "next_hashes")])
    nexts = sent.where("copies = 1").drop("copies").unionByName(again)
    own = rows.select("k1", "k2", "doc_id", "text", "grams").join(nexts, ["k1", "k2"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    done = own.select("doc_id", n.alias("n_chars"), "grams", "next_hashes", "next_id",
                      F.concat(F.left("text", n - half), F.left("head", half)).alias("edited"))
    done = done.select("*", winnow("edited", k, window).alias("edited_grams"))
    done = done.select("*", hashes("grams").alias("own"), hashes("edited_grams").alias("other"))
    return done.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_string("grams").alias("fingerprint"), as_string("edited_grams").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"), likeness("own", "next_hashes").alias("near_next"), "next_id")
