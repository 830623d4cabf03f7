"""Damaged records, counts observed while writing, recursive listings, the problems of damaged PNGs."""

import json
import os

import __spark_entry__ as E
from furiframe.functions.png import encode_png, png_problem
from furiframe.operators import messages as M
from furiframe.operators import segment as S
from furiframe.sources.listing import FileListing, list_files

from .conftest import SF001


def _record(text="a", role="user"):
    return json.dumps({"messages": [{"role": role, "content": [{"type": "text", "text": text}]}]})


def test_every_line_is_a_record_or_a_reject(spark):
    good = [_record("á\n\"x\" 東京"), _record("") , '{"messages":[{"role":"user","content":[]}],"more":1}']
    bad = {None: "empty line", "": "empty line", "  ": "empty line", "{": "damaged record", _record()[:-1]: "damaged record",
           "[1, 2": "damaged record", '{"messages":"text"}': "damaged record", "{}": "no messages", '{"messages":null}': "no messages",
           '{"messages":[]}': "no turns", '{"messages":[null]}': "turn without role or content",
           '{"messages":[{"content":[]}]}': "turn without role or content", '{"messages":[{"role":"user"}]}': "turn without role or content"}
    # ``messages`` and ``problem`` of the input are replaced; other columns stay.
    rows = [(x, k) for k, x in enumerate([*good, *bad, good[0]])]
    parsed = M.parse_messages(spark.createDataFrame(rows, "value string, problem_id int").repartition(3))
    assert parsed.where("(messages is null) = (problem is null)").count() == 0
    rejects = {r["value"]: r["problem"] for r in M.rejected_messages(parsed).collect()}
    assert rejects == bad
    sound = M.sound_messages(parsed).orderBy("problem_id").collect()
    assert [r["value"] for r in sound] == [*good, good[0]] and sound[0]["messages"][0]["content"][0]["text"] == "á\n\"x\" 東京"


def test_an_empty_file_of_records(spark):
    assert M.parse_messages(spark.createDataFrame([], "value string")).collect() == []


def test_every_kind_of_damage_has_rows(spark):
    sf = SF001.replace("0.001", "0.01")
    problems = {r[0] for r in E.queries()["message_records"](spark, sf).select("problem").distinct().collect()}
    assert problems == {None, "empty line", "damaged record", "no messages", "no turns", "turn without role or content"}
    pngs = {r[0] for r in E.queries()["png_problems"](spark, sf).select("problem").distinct().collect()}
    assert pngs == {None, "zero-size file", "not a PNG signature", "truncated chunk", "missing IEND",
                    "IHDR is not the first chunk", "no image data", "bad CRC in IHDR"}


def test_a_png_cut_anywhere_has_a_problem():
    import numpy as np

    png = encode_png(np.arange(48, dtype=np.uint8).reshape(4, 4, 3))
    assert png_problem(png) is None
    assert all(png_problem(png[:n]) for n in range(len(png)))
    assert all(png_problem(png[:k] + bytes([png[k] ^ 1]) + png[k + 1:]) for k in range(len(png)))


def test_counts_of_the_writing_pass(spark, tmp_path):
    rows = [(1, "a. b.c"), (2, None), (3, ""), (4, " . . "), (None, "x"), (5, "a. b.c")]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    counts = S.write_segments(docs, str(tmp_path / "a"), delimiter=".")
    assert counts == S.segment_summary(docs, delimiter=".").first().asDict() == {"processed": 6, "with_segments": 3, "skipped": 3, "segments": 7}
    key = lambda df: sorted(df.collect(), key=str)
    assert key(spark.read.parquet(str(tmp_path / "a"))) == key(S.segment_sentences(docs, delimiter="."))


def test_counts_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "id long, text string").write.parquet(str(tmp_path / "none"))
    for k, docs in enumerate([spark.read.parquet(str(tmp_path / "none")), spark.createDataFrame([], "id long, text string")]):
        assert S.write_segments(docs, str(tmp_path / f"out{k}"), delimiter=".") == {
            "processed": 0, "with_segments": 0, "skipped": 0, "segments": 0}


def test_listing_sees_empty_files_at_every_depth(spark, tmp_path):
    files = {"a.txt": "", "b.png": "xy", "x/c.txt": "123", "x/y/d.txt": "", "x/y/z/e.txt": "é", "w/f.txt": "1"}
    for name, text in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    (tmp_path / "empty").mkdir()
    os.symlink(tmp_path, tmp_path / "x" / "loop")  # a linked folder is not followed
    for depth in range(5):
        found = {os.path.relpath(r["path"], tmp_path): r["size"] for r in list_files(spark, str(tmp_path), depth=depth).collect()}
        assert found == {n: len(t.encode()) for n, t in files.items()}
    listed = list_files(spark, str(tmp_path), "*.txt")
    assert sorted(r["name"] for r in listed.where("size = 0").collect()) == ["a.txt", "d.txt"]
    # A task for the root itself and one for each folder below it.
    assert listed.rdd.getNumPartitions() == 4
    reader = FileListing({"path": str(tmp_path)}).reader(None)
    assert sorted(os.path.basename(p.folder) for p in reader.partitions() if p.below) == ["empty", "w", "x"]
