"""Lookup joins (plain, salted), ranks, dense ids, vocabulary encode/decode, batches and collation."""

from pyspark.sql import functions as F

from furiframe.operators import sequences
from furiframe.operators.joins import dense_ids, hash_rank, lookup_join, range_rank


def _big(spark):
    # one hot key holding most rows, plus a tail
    rows = [(i, "the") for i in range(300)] + [(1000 + i, f"w{i % 7}") for i in range(50)] + [(2000, "zzz")]
    return spark.createDataFrame(rows, "id long, word string")


def _lex(spark):
    return spark.createDataFrame([("the", "T")] + [(f"w{i}", f"W{i}") for i in range(7)], "word string, r string")


def test_lookup_join_paths_agree(spark):
    big, lex = _big(spark), _lex(spark)
    expect = sorted(big.join(lex, "word", "left").select(*big.columns, "r").collect())
    for kw in ({"salt_buckets": 8}, {}):
        got = sorted(lookup_join(big, lex, ["word"], "left", **kw).select(*big.columns, "r").collect())
        assert got == expect, kw


def test_ranks_do_not_depend_on_parts(spark):
    df = spark.range(300).select("id", F.pmod(F.xxhash64("id"), F.lit(2**32)).alias("h")).repartition(7)
    want = {r["id"]: i for i, r in enumerate(df.orderBy("h", "id").collect())}
    for n in (1, 3, 64):
        assert {r["id"]: r["k"] for r in hash_rank(df, "h", ["id"], "k", n).collect()} == want
    assert {r["id"]: r["k"] for r in range_rank(df, ["h", "id"], "k").collect()} == want


def test_batches_of_consecutive_rows(spark):
    df = spark.createDataFrame([(c, t) for c in range(5) for t in range(9)], "c long, t long").repartition(4)
    got = sequences.assign_batches(df, ["c", "t"], 16).orderBy("c", "t").collect()
    assert [r["batch_id"] for r in got] == [i // 16 for i in range(45)]


def test_dense_ids_are_dense_and_unique(spark):
    df = spark.createDataFrame([(f"p{i % 37}",) for i in range(500)], "piece string")
    ids = dense_ids(df, "piece", "id", buckets=5).collect()
    assert sorted(r["id"] for r in ids) == list(range(37))
    assert len({r["piece"] for r in ids}) == 37


def test_encode_decode_round_trip_and_specials(spark):
    items = spark.createDataFrame([(1, "a b c a"), (2, "c"), (3, "")], "item long, text string")
    pieces = items.select(F.explode(F.split("text", " ")).alias("piece"))
    vocab = sequences.build_vocab(pieces, "piece", n_special=0)
    enc = sequences.encode_pieces(items.select("item", F.split("text", " ").alias("p")), ["item"], "p", vocab)
    dec = {r["item"]: r["text"] for r in sequences.decode_ids(enc, ["item"], "input_ids", vocab).collect()}
    assert dec == {1: "a b c a", 2: "c", 3: ""}
    special = sequences.build_vocab(pieces, "piece", n_special=10)  # everything special
    dec2 = {r["item"]: (r["text"], r["n_tokens"]) for r in sequences.decode_ids(enc, ["item"], "input_ids", special).collect()}
    assert dec2[1] == ("", 0)


def test_collate_pads_to_longest_in_batch(spark):
    df = spark.createDataFrame([(1, 0, [5, 6, 7]), (1, 1, [8]), (2, 0, [9, 0])], "b long, t long, ids array<int>")
    got = {(r["b"], r["t"]): (r["input_ids"], r["attention_mask"], r["labels"])
           for r in sequences.collate_batches(df, "b", "ids", pad=0).collect()}
    assert got[(1, 1)] == ([8, 0, 0], [1, 0, 0], [8, -100, -100])
    # a real id equal to the pad value is masked too (by value, as the reference does)
    assert got[(2, 0)] == ([9, 0], [1, 1], [9, -100])


def test_the_vocabulary_is_built_once(spark):
    import __spark_entry__ as E

    from .conftest import SF001

    plan = E.queries()["decode_ids"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    # Encoding and the list of rows read the table; the vocabulary is frozen.
    assert plan.count("FileScan") == 2
