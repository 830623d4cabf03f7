import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from furiframe.llm.common import text_batches
from furiframe.llm.packing import best_fit_rounds, pack_documents

from .edge import edge_docs, edge_texts, empty_docs

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, source, capacity):
    """Pieces against the tokenizer on whole texts, and every sequence gapless and within the capacity."""
    tok = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    total = 0
    for i, t in source:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[at: at + capacity], "<u4")
            want[(str(i), k, at, len(own), zlib.crc32(own.tobytes()))] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        got[(str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), total


def brute_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps[gaps.index(fit)] -= n
    return len(gaps)


def test_rounds_need_as_many_sequences_as_best_fit_decreasing():
    rng = random.Random(3)
    for capacity in (1, 7, 64, 300):
        for n in (1, 30, 400):
            lengths = [rng.randrange(1, capacity + 1) for _ in range(n)] + [rng.randrange(1, min(9, capacity) + 1) for _ in range(n)]
            sizes = defaultdict(int)
            for x in lengths:
                sizes[x] += 1
            plan = best_fit_rounds(dict(sizes), capacity)
            assert len({int(s) for s in plan.sequence} | {0}) <= brute_best_fit(lengths, capacity)
            # Unroll the runs: every rank placed once, every sequence gapless.
            placed, filled = defaultdict(list), defaultdict(list)
            order = sorted(range(len(plan.length)), key=lambda i: (plan.length[i], plan.rank[i]))
            for a, i in enumerate(order):
                nxt = order[a + 1] if a + 1 < len(order) and plan.length[order[a + 1]] == plan.length[i] else None
                end = int(plan.rank[nxt]) if nxt is not None else sizes[int(plan.length[i])]
                for r in range(int(plan.rank[i]), end):
                    placed[int(plan.length[i])].append(r)
                    filled[int(plan.sequence[i]) + r - int(plan.rank[i])].append((int(plan.offset[i]), int(plan.length[i])))
            assert all(sorted(v) == list(range(sizes[k])) for k, v in placed.items()) and set(placed) == set(sizes)
            assert len(filled) == brute_best_fit(lengths, capacity)
            for parts in filled.values():
                end = 0
                for o, x in sorted(parts):
                    assert o == end
                    end += x
                assert end <= capacity


def test_edge_rows(spark):
    n, total = check(pack_documents(edge_docs(spark), PATH, 2048).collect(), edge_texts(), 2048)
    assert n <= total / 2048 + 2


def test_small_capacity_and_one_hot_length(spark):
    source = [(i, "same words") for i in range(500)] + [(1000 + i, "a " * (i % 40)) for i in range(200)]
    docs = spark.createDataFrame(source, "doc_id long, text string").repartition(6)
    n, total = check(pack_documents(docs, PATH, 16).collect(), source, 16)
    assert n <= total / 16 * 1.02 + 1


def test_strings_of_special_tokens_are_cut_as_the_library_cuts_them(spark):
    texts = ["see <|endoftext|> here", "<|startoftext|>", "a<|endoftext|>b <|ENDOFTEXT|> <|endoftext|", "x\n <|startoftext|>\t\ty <|endoftext|><|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pack_documents(docs, PATH, 2048).collect()
    check(rows, list(enumerate(texts)), 2048)
    assert {r.doc_id: r.length for r in rows}[0] == 4


def test_an_explicit_batch_setting_stays(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.getAll.get(key)
    try:
        spark.conf.set(key, "10000")
        text_batches(spark)
        assert spark.conf.get(key) == "10000"
        spark.conf.unset(key)
        text_batches(spark)
        assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_empty_table(spark):
    assert pack_documents(empty_docs(spark), PATH).collect() == []
