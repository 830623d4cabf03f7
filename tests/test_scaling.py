import pandas as pd
from pyspark.sql import functions as F

from furiframe.functions import metrics as M
from furiframe.operators import annotate as A
from furiframe.operators import clean
from furiframe.operators import evaluate as E


def test_rejects_join_the_files_once(spark):
    files = spark.createDataFrame([(1, 5, True), (2, 0, True), (3, 5, False), (3, 5, False), (None, 5, True)], "stem long, size long, valid boolean")
    texts = spark.createDataFrame([(1, 0), (2, 4), (3, 4), (4, 0)], "stem long, size long")
    out = clean.rejects(files, texts)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 1
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([
        (1, "image", "orphan"), (1, "text", "empty"), (2, "image", "corrupt"), (2, "text", "corrupt_image"), (3, "image", "corrupt"),
        (3, "image", "corrupt"), (3, "text", "corrupt_image"), (3, "text", "corrupt_image"), (4, "text", "empty"), (None, "image", "orphan")], key=repr)


def test_reject_joins_move_sizes_not_texts(spark):
    from furiframe.plans import dataset_queries as Q
    from tests.conftest import SF001

    for df in (Q.images(spark, SF001), Q.transcripts(spark, SF001).select("stem", "size")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        join = next(i for i, line in enumerate(plan.splitlines()) if "Join Left" in line)
        assert "octet_length" not in "\n".join(plan.splitlines()[:join]) and "octet_length" in plan


LEXICON = [("行く", "イク"), ("行", "ギョウ"), ("京都", "キョウト"), ("都", "ト"), ("都", "ミヤコ"), ("引き出し", "ヒキダシ"), ("九", "キュウ"), ("無", None),
           ("日本", "ニホン"), ("お茶", "オチャオチャ"), ("食べる", "タ"), ("1日", "ツイタチ")]
READINGS = [("日", ["にち", "に"]), ("本", ["ほん"]), ("京", ["きょう"]), ("引", []), ("茶", [None, "ちゃ"])]


def _tables(spark):
    return (spark.createDataFrame(LEXICON, "surface string, reading string"),
            spark.createDataFrame(READINGS, "ch string, readings array<string>"))


def _both(monkeypatch, run):
    """The rows with the lookup tables in the tasks and with the joins for tables of any size."""
    small = sorted(map(tuple, run().collect()), key=repr)
    monkeypatch.setattr(A, "TASK_ROWS", 0)
    return small, sorted(map(tuple, run().collect()), key=repr)


def test_longest_match_in_the_row_equals_the_join(spark, monkeypatch):
    lexicon, _ = _tables(spark)
    rows = [(1, "京都へ行く"), (1, "京都へ行く"), (2, ""), (3, None), (None, "日本都京"), (4, "引き出し九😀行"), (5, "日")]
    texts = spark.createDataFrame(rows, "id long, text string")
    assert "Exchange" not in A.lexicon_tokenize(texts, ["id"], lexicon)._jdf.queryExecution().executedPlan().toString()
    small, joined = _both(monkeypatch, lambda: A.lexicon_tokenize(texts, ["id"], lexicon))
    assert small == joined and (4, 2, "😀", None) in small


def test_furiganize_in_the_row_equals_the_join(spark, monkeypatch):
    lexicon, readings = _tables(spark)
    rows = [(1, "京都へ行く。日本。"), (1, None), (1, "お茶を食べる。九日。"), (2, "。"), (2, ""), (None, "引き出し。"), (None, None), (3, "1日\n行。都")]
    docs = spark.createDataFrame(rows, "id long, text string")
    plan = A.furiganize(docs, lexicon, readings)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan and plan.count("LogicalRDD") == 1  # one pass, and no text leaves its document's task
    small, joined = _both(monkeypatch, lambda: A.furiganize(docs, lexicon, readings))
    assert small == joined and small.count((2, "", 0)) == 2


def test_rules_in_the_row_equal_the_join(spark, monkeypatch):
    _, readings = _tables(spark)
    pairs = [*LEXICON, ("日本茶", "にほんちゃ"), ("日本茶", "ニチホンチャ"), ("本日京", "ほんに"), ("お日本茶漬け", "オニホンチャヅケ"), ("abc", "abcd"), ("日日日日", "にちにちに"),
             ("", "x"), (None, "x"), ("x", None), ("十", "じゅう"), ("食べ", "たべべ"), ("日本", "にほ"), ("ab", "ab"), ("1本", "いっぽん"), ("本本本", "ほんほんx")]
    tokens = spark.createDataFrame([(i, k, r) for i, (k, r) in enumerate(pairs * 3)], "id long, surface string, reading string")
    for given in (readings, None):
        for more in ({}, {"legacy_suffix": True}, {"drop_prob": 0.5, "seed": 7}):
            with monkeypatch.context() as patch:
                small, joined = _both(patch, lambda: A.annotate_tokens(tokens, ["id"], given, **more))  # noqa: B023
            ruled = sorted(map(tuple, A._annotate_rows(A.annotate_tokens(tokens, ["id"]).select("id", "surface", "reading"), ["id"]).collect()), key=repr)
            assert small == joined and len(ruled) == len(small)
            if given is None and not more:
                assert small == ruled
    assert "Exchange" not in A.annotate_tokens(tokens, ["id"], readings)._jdf.queryExecution().executedPlan().toString()


def test_whitespace_markup_shuffles_texts_not_tokens(spark):
    docs = spark.createDataFrame([(1, "ab cd. ef"), (2, None), (1, "cd. x")], "id long, text string")
    lexicon = spark.createDataFrame([("cd", "CD")], "surface string, reading string")
    out = A.furiganize_whitespace(docs, F.broadcast(lexicon), "id", "text", ".")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(id") == 1
    assert plan.index("posexplode") < plan.index("Exchange hashpartitioning(id")


def test_common_lengths_by_halves(spark):
    rows = [("", ""), ("", "a"), ("a", "a"), ("a", "b"), ("ab", "ac"), ("ab", "ab"), ("abc", "abcd"), ("xbc", "bc"), (None, "a"), ("a" * 300, "a" * 257 + "b"),
            ("日本😀語", "日本😀話"), ("b" + "a" * 70, "c" + "a" * 70), ("abab", "ab")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id int, a string, b string")
    got = {r[0]: (r[1], r[2]) for r in df.select("id", A.common_prefix_len("a", "b"), A.common_suffix_len("a", "b")).collect()}

    def shared(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    assert got == {i: (None, None) if a is None else (shared(a, b), shared(a[::-1], b[::-1])) for i, (a, b) in enumerate(rows)}


def test_report_computes_its_distances_once(spark):
    scores = E.score_pairs(*[spark.createDataFrame([("a", "kitten"), ("b", t)], "name string, text string") for t in ("sitting", "x")])
    out = E.eval_report(scores)
    assert "ArrowEvalPython" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [r[0] for r in out.collect()] == [0, 1, 1, 2, 3]


def test_distances_read_ahead(monkeypatch):
    sizes = []
    monkeypatch.setattr(M, "AHEAD_CHARS", 10)
    monkeypatch.setattr(M, "distances", lambda a, b: sizes.append(len(a)) or [0] * len(a))
    batches = [(pd.Series(["abcd"] * n), pd.Series(["x"] * n)) for n in (1, 1, 1, 2)]
    assert sum(len(x) for x in M._distances.func(iter(batches))) == 5 and sizes == [3, 2]
