"""CER goldens: per file, macro, micro, report formatting, empty-reference rule."""

import pytest
from pyspark.sql import functions as F

from furiframe.functions.metrics import cer, percent
from furiframe.operators import evaluate as ev

TRUTH = [
    ("sample1.md", "これは[日本語]{にほんご}のテキストです。"),
    ("sample2.md", "彼女は[速]{はや}く[走]{はし}る。"),
    ("sample3.md", "[今日]{きょう}は[天気]{てんき}がいいですね。"),
    ("extra.md", "このファイルは無視されます。"),
]
RECOGNIZED = [
    ("sample1.md", "これは[日本語]{にほんご}のテキストです。\r\n"),
    ("sample2.md", "彼女は[速]{はか}く[走]{はし}る。"),
    ("sample3.md", "[今日]は[元気]{てんき}がいいですね。"),
]


@pytest.fixture(scope="module")
def scores(spark):
    t = spark.createDataFrame(TRUTH, "name string, text string")
    r = spark.createDataFrame(RECOGNIZED, "name string, text string")
    return ev.score_pairs(t, r, ["name"])


def test_per_file(scores):
    got = {r["name"]: (r["edits"], r["ref_len"], r["cer"]) for r in scores.collect()}
    assert got == {"sample1.md": (0, 22, 0.0), "sample2.md": (1, 20, 0.05), "sample3.md": (6, 26, 6 / 26)}


def test_summary(scores):
    row = ev.eval_summary(scores).first()
    assert row["n_files"] == 3
    assert row["cer_macro"] == pytest.approx(0.0935897, abs=1e-6)
    assert row["accuracy"] == pytest.approx(0.9064103, abs=1e-6)
    assert row["cer_micro"] == pytest.approx(7 / 68, abs=1e-6)


def test_empty_input_gives_null_average(spark):
    empty = spark.createDataFrame([], "name string, edits long, ref_len long, cer double")
    row = ev.eval_summary(empty).first()
    assert row["n_files"] == 0 and row["cer_macro"] is None


def test_empty_reference_rule(spark):
    df = spark.createDataFrame([(" \n", "x"), ("", ""), ("ab", "")], "t string, h string")
    assert [r["c"] for r in df.select(cer("t", "h").alias("c")).collect()] == [1.0, 0.0, 1.0]


def test_cer_can_exceed_one(spark):
    df = spark.createDataFrame([("a", "xyz")], "t string, h string")
    assert df.select(cer("t", "h").alias("c")).first()["c"] == 3.0


def test_report_line_and_percent(spark, scores):
    report = ev.eval_report(scores).collect()
    assert [(r["section"], r["name"]) for r in report] == [
        (0, None), (1, "sample1.md"), (1, "sample2.md"), (1, "sample3.md"), (2, None), (3, None)]
    assert report[0]["line"] == f"{'Filename':<30} | {'Character Error Rate (CER)':>20}"
    mean = (0.05 + 6 / 26) / 3
    assert report[4]["line"] == f"{'Average CER:':<30} | {f'{mean:.2%}':>20}"
    assert report[5]["line"] == f"{'Overall Accuracy:':<30} | {f'{1 - mean:.2%}':>20}"
    assert [r["section"] for r in ev.eval_report(scores.limit(0)).collect()] == [0]
    lines = {r["name"]: r["line"] for r in report}
    assert lines["sample2.md"] == f"{'sample2.md':<30} | {f'{0.05:.2%}':>20}"
    assert lines["sample3.md"] == f"{'sample3.md':<30} | {f'{6 / 26:.2%}':>20}"
    vals = [0.00125, 0.5, 1.25, 0.123456]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert [r["p"] for r in df.select(percent("x").alias("p")).collect()] == [f"{v:.2%}" for v in vals]


def test_key_sets(spark):
    a = spark.createDataFrame([(n,) for n, _ in TRUTH], "name string")
    b = spark.createDataFrame([(n,) for n, _ in RECOGNIZED], "name string")
    assert sorted(r[0] for r in ev.common_keys(a, b, "name").collect()) == ["sample1.md", "sample2.md", "sample3.md"]
    assert [r[0] for r in ev.unmatched_keys(a, b, "name").collect()] == ["extra.md"]


def test_run_slug(spark):
    df = spark.createDataFrame([("vlm:12b", 0.1)], "m string, t double")
    assert df.select(ev.run_slug("m", "t").alias("s")).first()["s"] == "vlm_12b_t0.1"


def test_edit_distance_shortcuts_are_exact(spark):
    import random

    from furiframe.functions.metrics import edit_distance

    rnd = random.Random(5)
    rows = []
    for _ in range(1500):
        a = "".join(rnd.choice("abé東 ") for _ in range(rnd.randint(0, 8)))
        kind = rnd.randint(0, 3)
        b = a if kind == 0 else a[: rnd.randint(0, len(a))] if kind == 1 else a[rnd.randint(0, len(a)):] if kind == 2 \
            else "".join(rnd.choice("abé東 ") for _ in range(rnd.randint(0, 8)))
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(edit_distance("a", "b").alias("d"), F.levenshtein("a", "b").alias("e")).collect()
    assert all(r["d"] == r["e"] for r in got)


def _table_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_bit_parallel_distances_match_the_table():
    import random

    from furiframe.functions.metrics import bit_parallel_distance, distances

    rng = random.Random(7)
    pairs = [("", ""), ("", "a"), ("日本語", "日木語"), ("a" * 64, "a" * 63 + "b"), ("ab" * 32, "ba" * 32)]
    for n in (1, 5, 63, 64, 65, 127, 128, 130, 200):
        for _ in range(30):
            letters = rng.choice(["ab", "abcdé🙂京", "abcdefghijklmnop"])
            a = "".join(rng.choice(letters) for _ in range(n))
            pairs.append((a, "".join(rng.choice(letters) if rng.random() < .3 else c for c in a if rng.random() < .9)))
    want = [_table_distance(a, b) for a, b in pairs]
    assert [bit_parallel_distance(a, b) for a, b in pairs] == want
    assert distances([a for a, _ in pairs] + [None, "x"], [b for _, b in pairs] + ["x", None]) == want + [None, None]
    assert distances([a for a, _ in pairs], [b for _, b in pairs], words=1, pairs=7) == want
