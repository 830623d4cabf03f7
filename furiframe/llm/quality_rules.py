"""Quality rules with host verdicts: DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furiframe.llm.common import ASCII_SPACE, frozen, text_or_empty

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def _size_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, "")).cast("long")


def rule_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """The counts of the rules per row; repeated 3-word windows are found inside the row.

    Windows are compared by a 64-bit hash chained over their words and sorted
    with their positions, so a text of n words costs n log n and no shuffle.
    """
    text = text_or_empty(text_col)
    words = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("_ff_host"), text.alias("_ff_text"),
        F.btrim(text, F.lit(ASCII_SPACE)).alias("_ff_trim"))
    words = words.select("*", F.when(F.col("_ff_trim") == "", F.array().cast("array<string>"))
                         .otherwise(F.split("_ff_trim", WORD_GAP)).alias("_ff_w"))
    w = F.col("_ff_w")
    windows = words.select("*", F.size(w).cast("long").alias("n_words"), F.sort_array(F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))).alias("_ff_s"))
    s = F.col("_ff_s")
    repeats = windows.select("*", F.sort_array(F.transform(
        F.filter(s, lambda x, i: (x.h == F.get(s, i - 1).h) | (x.h == F.get(s, i + 1).h)),
        lambda x: x.i)).alias("_ff_r"),
        F.filter(F.split("_ff_text", "\n"), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "").alias("_ff_l"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    return repeats.select(
        "doc_id", "_ff_host", "n_words",
        _size_without(F.col("_ff_text"), ASCII_SPACE).alias("word_chars"),
        (F.length("_ff_text") - _size_without(F.col("_ff_text"), SYMBOLS)).alias("n_symbols"),
        (F.size("_ff_l") - F.size(F.array_distinct("_ff_l"))).cast("long").alias("n_dup_lines"),
        F.size("_ff_l").cast("long").alias("n_lines"),
        F.aggregate("_ff_r", start, lambda a, p: F.struct(
            (a.n + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")), lambda a: a.n).alias("n_repeat_words"))


def rule_failures(rows: DataFrame) -> DataFrame:
    """Add base_failed and one 0/1 column for each rule that hosts are judged by."""
    n = F.col("n_words")
    rules = {
        "_ff_short": n < 50,
        "_ff_repeat": 100 * F.col("n_repeat_words") > 50 * n,
        "_ff_symbol": 10 * F.col("n_symbols") > n,
        "_ff_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
    }
    out = rows.withColumns({k: v.cast("long") for k, v in rules.items()})
    return out.withColumn("base_failed", (F.col("_ff_short") == 1) | (F.col("_ff_repeat") == 1))


RULES = ("_ff_short", "_ff_repeat", "_ff_symbol", "_ff_lines")


def rejected_hosts(rows: DataFrame, limit: float, floor: float, multiple: float, prior_rows: float) -> DataFrame:
    """Hosts for which, on some rule, the shrunk failure rate is surely out of line with the other hosts'.

    For each rule the rates of the other hosts give a host's beta prior, by
    moments: mean m and strength s from the spread beyond what sampling
    explains (s is 1 to ``prior_rows``: hosts that are all alike must not hide
    one that is not). A host with k failures in n rows has the posterior mean
    (k + m s) / (n + s); two posterior standard deviations below it must still
    exceed ``multiple`` times m, but ``floor`` at least, and ``limit`` is
    always enough. A host without others has its own rate as m.
    """
    hosts = (rows.where(F.col("_ff_host").isNotNull()).groupBy("_ff_host")
             .agg(F.count(F.lit(1)).alias("n"), *[F.sum(r).alias(r) for r in RULES])
             .select("_ff_host", "n", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("k")) for r in RULES])).alias("r"))
             .select("_ff_host", "n", "r.rule", "r.k", (F.col("r.k") / F.col("n")).alias("p")))
    sums = hosts.groupBy("rule").agg(F.count(F.lit(1)).alias("hosts"), F.sum(1 / F.col("n")).alias("inv"),
                                     F.sum("p").alias("p1"), F.sum(F.col("p") * F.col("p")).alias("p2"))
    n, p, m, s, mean = (F.col(c) for c in ("n", "p", "m", "s", "mean"))
    others = F.greatest(F.col("hosts") - 1, F.lit(1))
    # One row a rule: a proven bound.
    prior = hosts.join(F.broadcast(sums), "rule").select(
        "*", F.when(F.col("hosts") == 1, p).otherwise((F.col("p1") - p) / others).alias("near")).select(
        "*", F.least(F.greatest("near", F.lit(0.0)), F.lit(1.0)).alias("m")).select(
        "*", ((F.col("p2") - p * p) / others - m * m - m * (1 - m) * (F.col("inv") - 1 / n) / others).alias("own"))
    shrunk = prior.select("*", F.least(F.greatest(m * (1 - m) / F.greatest("own", F.lit(1e-6)) - 1, F.lit(1.0)), F.lit(prior_rows)).alias("s")).select(
        "*", F.least((F.col("k") + m * s) / (n + s), F.lit(1.0)).alias("mean"))
    low = mean - 2 * F.sqrt(mean * (1 - mean) / (n + s + 1))
    bad = shrunk.where(low > F.least(F.lit(limit), F.greatest(F.lit(floor), multiple * m)))
    return bad.select("_ff_host", F.lit(True).alias("_ff_bad")).distinct()


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  host_limit: float = 0.5, host_floor: float = 0.2, host_multiple: float = 3.0,
                  prior_rows: float = 200.0) -> DataFrame:
    """Rule counts and verdict of every row: (doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, host_rejected, kept).

    Words are runs of anything but ASCII white space; a null or empty text has
    none and fails. A row goes if it fails a base rule (under 50 words, or
    more than half of its words in repeated 3-word windows) or if its host is
    rejected (see :func:`rejected_hosts`). A null host is no host: its rows
    stand on their own. Repeated ids and equal rows are judged row by row.
    An empty table gives an empty result; other columns are not read.

    Texts are read once; the counts are frozen and only they are grouped by
    host (with partial sums, so a hot host costs a row a task) and joined.
    """
    rows = frozen(rule_failures(rule_counts(docs, id_col, text_col, host_col)))
    bad = frozen(rejected_hosts(rows, host_limit, host_floor, host_multiple, prior_rows))
    return rows.join(bad, "_ff_host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce("_ff_bad", F.lit(False)).alias("host_rejected"),
        (~F.col("base_failed") & F.col("_ff_bad").isNull()).alias("kept"))
