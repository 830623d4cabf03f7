"""Recognition scoring: per-file CER, macro / micro summaries, per-run summary.

Plan shape: truth and transcripts are joined once on their key (a
sort-merge join on a unique key; AQE may turn it into a broadcast join when
one side is small at run time), distances go in Arrow batches where the JVM
has no exact short answer, and every summary is a partially aggregated hash aggregate (map-side
combine, so the shuffle carries one row per map task and group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furiframe.functions.metrics import cer_from_parts, edit_distance, pad_left, pad_right, percent
from furiframe.functions.text import score_normalize
from furiframe.session import cut_lineage


# --- Fixed values (report labels) ---------------------------------------------
REPORT_HEADER = ("Filename", "Character Error Rate (CER)")
REPORT_AVERAGE, REPORT_ACCURACY = "Average CER:", "Overall Accuracy:"
# -----------------------------------------------------------------------------


def score_pairs(truth: DataFrame, recognized: DataFrame, keys: Sequence[str] = ("name",),
                truth_col: str = "text", hyp_col: str = "text",
                extra_cols: Sequence[str] = (), ordered: bool = False) -> DataFrame:
    """Inner join truth x recognised on ``keys``; one row per common key.

    Output: ``keys..., extra_cols..., edits, ref_len, cer``. Keys present on
    one side only are ignored (see ``unmatched_keys`` for the listing).
    ``ordered`` returns the rows in the order of ``keys``.
    """
    t = truth.select(*keys, score_normalize(truth_col).alias("_t"))
    r = recognized.select(*keys, *extra_cols, score_normalize(hyp_col).alias("_h"))
    joined = t.join(r, list(keys), "inner")
    if ordered:  # before the distances, which a sort's sampling would compute a second time
        joined = joined.orderBy(*keys)
    edits = edit_distance("_t", "_h")
    scored = joined.select(
        *keys, *extra_cols,
        edits.cast("long").alias("edits"),
        F.length("_t").cast("long").alias("ref_len"),
        F.length("_h").cast("long").alias("_hyp_len"),
    )
    return scored.select(
        *keys, *extra_cols, "edits", "ref_len",
        cer_from_parts("edits", "ref_len", "_hyp_len").alias("cer"),
    )


def eval_summary(scores: DataFrame, group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Macro CER (mean of per-file CER), accuracy = 1 - macro (not clamped),
    micro CER (sum of edits / sum of reference lengths) and file count.
    On empty input the averages are null (the reference prints no number)."""
    aggs = [
        F.count(F.lit(1)).alias("n_files"),
        F.round(F.avg("cer"), digits).alias("cer_macro"),
        F.round(F.lit(1.0) - F.avg("cer"), digits).alias("accuracy"),
        F.round(F.sum("edits").cast("double") / F.sum("ref_len").cast("double"), digits).alias("cer_micro"),
    ]
    if group_cols:
        return scores.groupBy(*group_cols).agg(*aggs)
    return scores.agg(*aggs)


def eval_report(scores: DataFrame, name_col: str = "name") -> DataFrame:
    """The report in order: ``(section, name, line)``.

    Section 0 is the header, 1 a fixed-width line per file by name
    (``name<30 | pct>20``), 2 and 3 the average CER and the accuracy (no
    summary without files). Sorted by range, not in one task. Names and rates
    are frozen: the mean, the sort's sampling and the sort read them, not the distances again.
    """
    scores = cut_lineage(scores.select(F.col(name_col), "cer"))

    def line(left, right) -> F.Column:
        return F.concat(pad_right(left, 30), F.lit(" | "), pad_left(right, 20)).alias("line")

    files = scores.select(F.lit(1).alias("section"), F.col(name_col).alias("name"), line(name_col, percent("cer")))
    header = scores.sparkSession.range(1).select(
        F.lit(0).alias("section"), F.lit(None).cast("string").alias("name"), line(F.lit(REPORT_HEADER[0]), F.lit(REPORT_HEADER[1])))
    mean = scores.agg(F.avg("cer").alias("m")).where(F.col("m").isNotNull())
    both = mean.select(F.explode(F.array(
        F.struct(F.lit(2).alias("section"), F.lit(REPORT_AVERAGE).alias("left"), percent("m").alias("right")),
        F.struct(F.lit(3).alias("section"), F.lit(REPORT_ACCURACY).alias("left"), percent(1 - F.col("m")).alias("right")))).alias("s"))
    summary = both.select("s.section", F.lit(None).cast("string").alias("name"), line(F.col("s.left"), F.col("s.right")))
    return header.unionByName(files).unionByName(summary).orderBy("section", "name")


def run_slug(model, temperature) -> F.Column:
    """Run folder name ``model.replace(':', '_') + '_t' + temperature``."""
    m = F.col(model) if isinstance(model, str) else model
    t = F.col(temperature) if isinstance(temperature, str) else temperature
    return F.concat(F.replace(m, F.lit(":"), F.lit("_")), F.lit("_t"), t.cast("string"))


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Key intersection (distinct)."""
    return a.select(key).intersect(b.select(key))


def unmatched_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of ``a`` missing from ``b`` (distinct)."""
    return a.select(key).subtract(b.select(key))
