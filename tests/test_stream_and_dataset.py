"""Streaming = batch for segmentation; JSONL round trip; split stability; pairing."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from furiframe.operators import dataset, segment
from furiframe.sources import files, sinks
from furiframe.streaming.segments import stream_segments

from .conftest import SF001


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="furiframe-stream-src-")
    out = tempfile.mkdtemp(prefix="furiframe-stream-out-")
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("id"), "text")
    docs.repartition(4).write.mode("overwrite").parquet(os.path.join(src, "landing"))
    q = stream_segments(spark, os.path.join(src, "landing"), docs.schema, os.path.join(out, "segments"),
                        delimiter=".", checkpoint=os.path.join(out, "_ckpt"), max_files_per_trigger=1)
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(out, "segments"))
    batch = segment.segment_sentences(docs, "id", "text", ".")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_jsonl_roundtrip(spark):
    pairs = spark.createDataFrame([("a", "cropped/a.png", "[東]{とう}")], "stem string, image_path string, gt_answer string")
    conv = dataset.build_conversation(pairs)
    path = os.path.join(tempfile.mkdtemp(prefix="furiframe-jsonl-"), "ds")
    sinks.write_jsonl(conv, path)
    line = spark.read.text(path).first()["value"]
    assert line.startswith('{"messages":[{"role":"user","content":[{"type":"image","path":"cropped/a.png"},'
                           '{"type":"text","text":"Recognize all')
    back = files.read_messages_jsonl(spark, path).first()["messages"]
    assert back[1]["content"][0]["text"] == "[東]{とう}" and back[0]["content"][0]["path"] == "cropped/a.png"


def test_split_is_stable_under_repartition(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id")
    a = dataset.split_train_test(docs, "doc_id")
    b = dataset.split_train_test(docs.repartition(7), "doc_id")
    assert a.exceptAll(b).count() == 0
    n_test = a.where(F.col("split") == "test").count()
    assert 0 < n_test < a.count() / 4


def test_pair_strict_fails_on_missing(spark):
    imgs = spark.createDataFrame([("a", "a.png"), ("b", "b.png")], "stem string, path string")
    texts = spark.createDataFrame([("a", " x ")], "stem string, text string")
    ok = dataset.pair_dataset(imgs, texts).collect()
    assert [(r.stem, r.gt_answer) for r in ok] == [("a", "x")]
    with pytest.raises(Exception, match="missing transcript for b"):
        dataset.pair_dataset(imgs, texts, on_missing="error").collect()


def test_two_turn_pairs_keep_their_blanks(spark):
    imgs = spark.createDataFrame([("a", "a.png")], "stem string, path string")
    texts = spark.createDataFrame([("a", " x\n")], "stem string, text string")
    assert dataset.pair_dataset(imgs, texts, strip=False).first().gt_answer == " x\n"


def test_exact_split(spark):
    docs = spark.range(101).select(F.col("id").alias("k")).repartition(5)
    out = dataset.split_train_test(docs, "k", exact=True)
    assert out.where(F.col("split") == "test").count() == 11 and out.count() == 101
    assert out.exceptAll(dataset.split_train_test(docs.repartition(3), "k", exact=True)).count() == 0


def test_stream_needs_a_checkpoint(spark):
    with pytest.raises(ValueError):
        stream_segments(spark, "/nowhere", "id string, text string", "/nowhere", checkpoint="")


def test_upsert_ties_have_a_winner(spark):
    rows = [("k", 1, "a"), ("k", 1, "c"), ("k", 1, "b")]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "key string, seq int, text string")
        assert [tuple(r) for r in segment.upsert_latest(df, ["key"], "seq").collect()] == [("k", 1, "c")]


def test_upsert_latest_last_write_wins(spark):
    df = spark.createDataFrame([("k", 0, "x"), ("k", 2, "z"), ("k", 1, "y"), ("j", 0, "q")],
                               "key string, seq int, text string")
    got = {r.key: (r.seq, r.text) for r in segment.upsert_latest(df, ["key"], "seq").collect()}
    assert got == {"k": (2, "z"), "j": (0, "q")}


def test_cut_lineage_uses_the_shared_checkpoint_folder(spark):
    from furiframe.session import cut_lineage, ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark)
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id")
    cut = cut_lineage(df.where(F.col("doc_id") % 2 == 0))
    assert cut.count() == df.where(F.col("doc_id") % 2 == 0).count()
    assert any(os.scandir(folder.replace("file:", "")))


def test_chat_render_joins_blocks_in_order(spark):
    from furiframe.operators import chat

    turns = spark.createDataFrame([(1, t, "user", str(t)) for t in range(50)], "conv_id long, turn long, role string, text string")
    row = chat.chat_render(turns.repartition(6), start="", end="", block=7).first()
    assert row.n_turns == 50 and row.rendered == "".join(f"user\n{t}\n" for t in range(50))


def test_chat_render_and_prompt_lines(spark):
    from furiframe.operators import chat

    turns = spark.createDataFrame(
        [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "user", "c"), (2, 0, "user", "x")],
        "conv_id long, turn long, role string, text string")
    r = {x.conv_id: x.rendered for x in chat.chat_render(turns, generation_prompt="model").collect()}
    assert r[1] == ("<start_of_turn>user\na<end_of_turn>\n<start_of_turn>assistant\nb<end_of_turn>\n"
                    "<start_of_turn>user\nc<end_of_turn>\n<start_of_turn>model\n")
    lines = [(x.conv_id, x.turn, x.line) for x in chat.prompt_lines(turns).collect()]
    assert lines == [(1, 0, "User: a\nAssistant: b")]


def _land(spark, folder, rows, name):
    spark.createDataFrame(rows, "id long, v long, text string").coalesce(1).write.mode("append").parquet(os.path.join(folder, name))


def test_stream_take_survives_a_restart(spark):
    from furiframe.streaming.segments import stream_take

    folder = tempfile.mkdtemp(prefix="furiframe-take-")
    src, out, ckpt = (os.path.join(folder, x) for x in ("src", "out", "progress"))

    def run():
        stream = spark.readStream.schema("id long, v long, text string").option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
        q = stream_take(stream, 25, out, ckpt, ["id"])
        q.awaitTermination(120)

    for i in range(2):
        _land(spark, src, [(i * 10 + k, k, "t") for k in range(10)], f"f{i}")
    run()
    assert spark.read.parquet(out).count() == 20
    # A batch that was written but not committed is delivered again after a crash.
    last = sorted(os.listdir(os.path.join(ckpt, "commits")))[-1]
    for f in (last, f".{last}.crc"):
        os.remove(os.path.join(ckpt, "commits", f))
    run()
    assert spark.read.parquet(out).count() == 20
    for i in range(2, 4):
        _land(spark, src, [(i * 10 + k, k, "t") for k in range(10)], f"f{i}")
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(25))


def test_stream_upsert_is_idempotent(spark):
    from furiframe.streaming.segments import stream_upsert

    folder = tempfile.mkdtemp(prefix="furiframe-upsert-")
    src, out, ckpt = (os.path.join(folder, x) for x in ("src", "out", "progress"))

    def run(progress):
        stream = spark.readStream.schema("id long, v long, text string").option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
        q = stream_upsert(stream, ["id"], "v", out, progress, buckets=4)
        q.awaitTermination(120)
        return sorted((r.id, r.v, r.text) for r in spark.read.parquet(out).collect())

    _land(spark, src, [(1, 1, "a"), (2, 1, "b"), (2, 3, "c")], "f0")
    assert run(ckpt) == [(1, 1, "a"), (2, 3, "c")]
    _land(spark, src, [(1, 2, "d"), (2, 2, "late"), (3, 1, "e")], "f1")
    want = [(1, 2, "d"), (2, 3, "c"), (3, 1, "e")]
    assert run(ckpt) == want
    assert run(ckpt + "-anew") == want  # every batch delivered a second time
