"""Golden tests: strip, split, segmentation, keys, stems, escape, ruby HTML."""

from pyspark.sql import functions as F

from furiframe.functions import ruby as R
from furiframe.functions import text as T
from furiframe.operators import segment as seg


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


def test_py_strip_matches_python(spark):
    samples = ["　 a b\n\u0085", " x\u001c", "​keep​", "  ", "", "\t\x0b\x0cz\r\n",
               " y ", " q "]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r["o"] for r in df.select(T.py_strip("s").alias("o")).collect()]
    assert got == [s.strip() for s in samples]


def test_split_literal_keeps_empty_pieces(spark):
    for text, d in [("a..b.", "."), ("x|y", "|"), ("a。 。b。", "。"), ("", "."), ("q.E.d", "\\E")]:
        assert _one(spark, T.split_literal("s", d), text) == text.split(d)


def test_segmentation_goldens(spark):
    long = "長" * 150
    corpus = spark.createDataFrame([("<urn:uuid:ABC>", "a。 。b。"), ("d2", long)], "id string, text string")
    rows = seg.segment_sentences(corpus, "id", "text", "。", max_chars=100).orderBy("id", "seq").collect()
    got = [(r["id"], r["seq"], r["text"]) for r in rows]
    assert got == [("<urn:uuid:ABC>", 0, "a。"), ("<urn:uuid:ABC>", 1, "b。"), ("d2", 0, "長" * 100)]
    # The reference's literal delimiter: the whole document is one segment, '。' appended.
    one = seg.segment_sentences(corpus.limit(1), "id", "text", "entry_id。", suffix="。").collect()
    assert [(r["seq"], r["text"]) for r in one] == [(0, "a。 。b。。")]


def test_segment_keys(spark):
    df = spark.createDataFrame([("<urn:uuid:ABC>", None), (None, 5)], "id string, ordinal long")
    out = seg.fallback_ids(df, "id", "ordinal", "entry_id").select(seg.segment_key("entry_id", F.lit(0)).alias("k"))
    assert [r["k"] for r in out.collect()] == ["ABC_0", "__0"]


def test_slice_and_stem(spark):
    cases = ["a.tar.gz", ".bashrc", "noext", "dir/x.md", "a.", "x_12.png"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    stems = [r["o"] for r in df.select(T.stem("s").alias("o")).collect()]
    import pathlib
    assert stems == [str(pathlib.PurePosixPath(c).with_suffix("")) if pathlib.PurePosixPath(c).suffix else c
                     for c in cases]
    assert _one(spark, T.slice_key("s"), "<urn:uuid:0123-4567>") == "<urn:uuid:0123-4567>"[10:-1]
    assert _one(spark, T.slice_key("s"), "short") == "short"[10:-1]


def test_escape_text(spark):
    text = "a\nb～c<br>d<br />e<br/>"
    assert _one(spark, T.escape_text("s"), text) == "a b~c<br>d<br>e<br/>"


def test_kana_fold_and_numerals(spark):
    assert _one(spark, T.kana_fold("s"), "トウキョウー") == "とうきょうー"
    df = spark.createDataFrame([("一二",), ("十一",), ("",), ("５６",)], "s string")
    assert [r["o"] for r in df.select(T.is_numeral("s").alias("o")).collect()] == [True, False, True, True]


def test_ruby_html_edge_cases(spark):
    line = "[東]{とう}[京]{きょう}（[[1]）2025[[年]{ねん}"
    html = _one(spark, R.ruby_html("s"), line)
    assert html == ("<ruby><rb>東</rb><rt>とう</rt></ruby><ruby><rb>京</rb><rt>きょう</rt></ruby>"
                    "（[[1]）2025<ruby><rb>[年</rb><rt>ねん</rt></ruby>")
    assert _one(spark, R.count_spans("s"), line) == 3
    page = _one(spark, R.fill_template("s", "<p>{{content}}</p>{{content}}"), "$1 & <b>")
    assert page == "<p>$1 & <b></p>$1 & <b>"


def test_ruby_span_rule(spark):
    df = spark.createDataFrame([("東", "とう"), ("2年", "にねん"), ("", "x"), ("x", ""), ("y", None)],
                               "k string, r string")
    got = [r["o"] for r in df.select(R.ruby_span("k", "r").alias("o")).collect()]
    assert got == ["[東]{とう}", "2年", "", "x", "y"]


def test_char_budget_prefix(spark):
    # 600, 1 (dropped), 800, 500, 120 (over: the loop breaks), 2 (would fit, but after the break)
    text = "。".join(["ab" * 300, "c", "de" * 400, "f" * 500, "gh" * 60, "ij"])
    corpus = spark.createDataFrame([("d", text)], "id string, text string")
    rows = seg.char_budget(corpus, "id", "text", "。").orderBy("pos").collect()
    assert [(r["pos"], r["n_chars"], r["cum_chars"]) for r in rows] == [(0, 600, 600), (1, 800, 1400), (2, 500, 1900)]
