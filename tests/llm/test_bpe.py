import numpy as np
import public_tokenizers
import pytest
import tiktoken

from furiframe.llm import bpe

from .edge import edge_docs, edge_texts, empty_docs

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def want(source):
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    return sorted((str(i), coder.encode_ordinary(t or ""), (t or "").encode()) for i, t in source)


def got(df):
    rows = bpe.decode_ids(df, RANKS).collect()
    assert all(r.n_tokens == len(r.ids) // 4 for r in rows)
    return sorted((str(r.doc_id), np.frombuffer(bytes(r.ids), "<u4").tolist(), bytes(r.decoded)) for r in rows)


def test_edge_rows_match_the_library_and_round_trip(spark):
    assert got(bpe.encode_documents(edge_docs(spark), RANKS, public_tokenizers.PATTERN)) == want(edge_texts())


def test_blocks_meet_again(spark, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 600)  # many blocks a task
    odd = ["tabs\t\tand  spaces   ", "\x1c\x1d odd", "  x", "'s'S ''ll", "Ａ１ ٣ ½ Ⅷ", "\r\n\r\n  a", "한국어 テスト", "a" * 5000, "​ zero"]
    source = [(i, odd[i % len(odd)] + " " * (i % 5) + f"w{i % 7}") for i in range(120)]
    docs = spark.createDataFrame(source, "doc_id long, text string").repartition(4)
    assert got(bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)) == want(source)


def test_decoding_in_the_same_pass(spark):
    both = bpe.encode_documents(edge_docs(spark), RANKS, public_tokenizers.PATTERN, decoded=True).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in both) == sorted((i, d) for i, _, d in want(edge_texts()))


@pytest.mark.parametrize("codes", [[], [0], [191, 192, 193, 192 + 63 * 256 - 1, 192 + 63 * 256, 2**23], list(range(70000))])
def test_code_packing(codes):
    assert bpe._unpack_codes(bpe._pack_codes(np.array(codes, np.int64))).tolist() == codes


@pytest.mark.parametrize("codes", [[2**24 - 1, 2**24 + 192 + 63 * 256, 5], [2**31, 300, 2**32 - 1]])
def test_codes_of_four_bytes(codes):
    assert bpe._unpack_codes(bpe._pack_codes(np.array(codes, np.int64))).tolist() == codes


def test_null_ids_stay_null_and_unknown_ids_raise(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray(np.array([1], "<u4").tobytes()))], "doc_id long, ids binary")
    assert [r.decoded is None for r in bpe.decode_ids(df, RANKS).orderBy("doc_id").collect()] == [True, False]
    with pytest.raises(Exception, match="IndexError|index out of range"):
        bpe.decode_ids(spark.createDataFrame([(2, bytearray(np.array([10**6], "<u4").tobytes()))], "doc_id long, ids binary"), RANKS).collect()


def test_empty_table(spark):
    assert bpe.encode_documents(empty_docs(spark), RANKS, public_tokenizers.PATTERN).collect() == []
