"""File sources and sinks: whole-text scan with glob, run-partitioned output,
and the evaluation flow over two folders of files (truth vs recognised)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from furiframe.operators import evaluate as ev
from furiframe.sources import files, sinks

from .test_eval import RECOGNIZED, TRUTH


def _write(d, name, text, newline=""):
    with open(os.path.join(d, name), "w", encoding="utf-8", newline=newline) as f:
        f.write(text)


@pytest.fixture(scope="module")
def folders():
    root = tempfile.mkdtemp(prefix="furiframe-files-")
    truth, rec = os.path.join(root, "truth"), os.path.join(root, "rec")
    os.makedirs(truth)
    os.makedirs(rec)
    for name, text in TRUTH:
        _write(truth, name, text)
    for name, text in RECOGNIZED:
        _write(rec, name, text)
    _write(rec, "notes.txt", "not markdown")
    _write(truth, "empty.md", "")
    return truth, rec


def test_wholetext_scan_keeps_crlf_and_filters_by_glob(spark, folders):
    _, rec = folders
    got = {r["name"]: (r["stem"], r["text"]) for r in files.wholetext_files(spark, rec, "*.md").collect()}
    assert set(got) == {"sample1.md", "sample2.md", "sample3.md"}
    assert got["sample1.md"][0] == "sample1" and got["sample1.md"][1].endswith("\r\n")


def test_evaluate_two_folders(spark, folders):
    truth, rec = folders
    t = files.wholetext_files(spark, truth, "*.md")
    r = files.wholetext_files(spark, rec, "*.md")
    scores = ev.score_pairs(t, r, ["name"])
    row = ev.eval_summary(scores).first()
    # extra.md has no recognised twin, empty.md is a zero-byte file (not listed)
    assert row["n_files"] == 3 and row["cer_macro"] == pytest.approx(0.0935897, abs=1e-6)
    assert sorted(x[0] for x in ev.unmatched_keys(t, r, "name").collect()) == ["extra.md"]


def test_manifest_sees_zero_byte_text(spark, folders):
    truth, _ = folders
    m = {r["name"]: r["size"] for r in files.file_manifest(spark, truth, "text", "*.md").collect()}
    assert m["empty.md"] == 0 and len(m) == 5


def test_run_partitioned_output(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="furiframe-runs-"), "recognized")
    df = spark.createDataFrame(
        [("vlm:12b", 0.1, "2026-01-01 00:00:00", "a.md", "x"), ("other", 0.8, "2026-01-02 00:00:00", "a.md", "y")],
        "model string, temperature double, run_ts string, name string, text string",
    ).withColumn("run_ts", F.to_timestamp("run_ts"))
    sinks.write_runs(df, out, mode="overwrite")
    back = spark.read.parquet(out).where((F.col("model") == "vlm:12b") & (F.col("temperature") == 0.1))
    assert [(r["name"], r["text"]) for r in back.collect()] == [("a.md", "x")]
    sinks.write_runs(df.where("temperature = 0.1").withColumn("text", F.lit("again")), out)  # a rerun replaces its run only
    assert sorted((r["temperature"], r["text"]) for r in spark.read.parquet(out).collect()) == [(0.1, "again"), (0.8, "y")]
    one = sinks.read_run(spark, out, model="other", temperature=0.8)
    assert [r["text"] for r in one.collect()] == ["y"]
    assert "PartitionFilters: [isnotnull(model" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        sinks.read_run(spark, out, name="a.md")
    sinks.write_table(df.select("name", "text"), out + "_tbl")
    assert spark.read.parquet(out + "_tbl").count() == 2


def test_source_guards(spark, folders):
    with pytest.raises(ValueError):
        files.wholetext_files(spark, "")
    for read in (files.wholetext_files, files.binary_files, files.image_files, files.read_messages_jsonl):
        with pytest.raises(FileNotFoundError, match="no such source"):
            read(spark, "/tmp/no-such-folder-here")
    with pytest.raises(FileNotFoundError, match="no matching markdown"):
        files.require_match(files.wholetext_files(spark, folders[0], "*.markdown"), "markdown files")
    df = files.require_match(files.wholetext_files(spark, folders[0], "*.md"), "markdown files")
    assert files.require_columns(df, "name", "text") is df
    with pytest.raises(ValueError, match="missing columns: size"):
        files.require_columns(df, "name", "size")
