"""Byte-level BPE: each distinct word of the corpus is encoded once, by a global shuffle of words."""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furiframe.llm.common import frozen, shuffle_partitions, text_or_empty

BLOCK_BYTES = 32 << 20  # of text whose words share one local dictionary
_COMMON = 192 + 63 * 256  # words of a block that are numbered by frequency (one or two bytes a position)


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its id a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _pack_strings(items: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, items), "<u4", len(items))
    return zstandard.compress(len(items).to_bytes(8, "little") + sizes.tobytes() + b"".join(items), 3)


def _unpack_strings(packed: bytes) -> list[bytes]:
    raw = zstandard.decompress(packed)
    n = int.from_bytes(raw[:8], "little")
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 8), dtype=np.int64) + 8 + 4 * n
    cut = [8 + 4 * n, *ends.tolist()]
    return [raw[a:b] for a, b in zip(cut, cut[1:])]


def _pack_ids(ids: list[list[int]]) -> bytes:
    sizes = np.fromiter(map(len, ids), "<u4", len(ids))
    flat = np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum()))
    planes = flat.view(np.uint8).reshape(-1, 4).T.tobytes()  # byte planes: the high bytes are nearly all zero
    return zstandard.compress(len(ids).to_bytes(8, "little") + sizes.view(np.uint8).reshape(-1, 4).T.tobytes() + planes, 3)


def _unpack_ids(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    n = int.from_bytes(raw[:8].tobytes(), "little")

    def numbers(planes: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()

    return numbers(raw[8: 8 + 4 * n]), numbers(raw[8 + 4 * n:])


def _pack_codes(codes: np.ndarray) -> bytes:
    """Numbers of a block's words as a compressed byte string: 1 byte below 192, 2 for other common words, else 4."""
    c = codes.astype(np.uint32)
    wide = np.where(c < 192, c, np.where(c < _COMMON, 192 + ((c - 192) >> 8), 255)).astype(np.uint8)
    two = (c >= 192) & (c < _COMMON)
    low = ((c[two] - 192) & 255).astype(np.uint8)
    rest = (c[wide == 255] - _COMMON).astype("<u4")
    planes = rest.view(np.uint8).reshape(-1, 4).T[: 3 if rest.max(initial=0) < 1 << 24 else 4]
    head = len(c).to_bytes(8, "little") + len(low).to_bytes(8, "little")
    return head + zstandard.compress(wide.tobytes() + low.tobytes() + planes.tobytes(), 3)


def _unpack_codes(packed: bytes) -> np.ndarray:
    n, m = (int.from_bytes(packed[a: a + 8], "little") for a in (0, 8))
    raw = np.frombuffer(zstandard.decompress(packed[16:]), np.uint8)
    wide, low = raw[:n], raw[n: n + m]
    out = wide.astype(np.int64)
    two = (wide >= 192) & (wide < 255)
    out[two] = 192 + ((out[two] - 192) << 8) + low
    if (wide == 255).any():
        planes = raw[n + m:].reshape(-1, np.count_nonzero(wide == 255)).astype(np.int64)  # three, or four where a number needs it
        out[wide == 255] = _COMMON + sum(p << 8 * k for k, p in enumerate(planes))
    return out


def split_words(docs: DataFrame, pattern: str, parts: int, id_col: str, text_col: str) -> DataFrame:
    """Rows of two kinds, a block of documents at a time.

    kind 0: (block, doc_ids, data = the texts' pre-tokens by position, as
    numbers in the block's dictionary, and how many each text has). kind 1:
    (block, part, data = the dictionary's words of that hash part). The most
    frequent words have the lowest numbers, and ``data`` names them; the
    others are numbered by part and word, so their first number is enough.
    """
    ids_type = T.ArrayType(docs.schema[id_col].dataType)
    names = ["kind", "block", "part", "doc_ids", "data"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        number = 0

        def block_rows(ids: list, coded: list[np.ndarray], words: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            block = (TaskContext.get().partitionId() << 24) + number
            number += 1

            def row(kind: int, part: int, keys: list | None, data: bytes) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([
                    pa.array([kind], pa.int32()), pa.array([block], pa.int64()), pa.array([part], pa.int32()),
                    pa.array([keys], pa.list_(id_arrow)), pa.array([data], pa.binary())], names)

            flat = np.concatenate(coded)
            common = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")[:_COMMON]
            renumber = np.full(len(words), -1, np.int64)
            renumber[common] = np.arange(len(common))
            named: list[list[tuple[bytes, int]]] = [[] for _ in range(parts)]
            others: list[list[tuple[bytes, int]]] = [[] for _ in range(parts)]
            for i, (w, c) in enumerate(zip(words, renumber.tolist())):
                raw = w.encode("utf-8", "surrogatepass")
                part = zlib.crc32(raw) % parts
                if c >= 0:
                    named[part].append((raw, c))
                else:
                    others[part].append((raw, i))
            begin = _COMMON
            for part in range(parts):
                own = sorted(others[part])
                renumber[[i for _, i in own]] = np.arange(begin, begin + len(own))
                if own or named[part]:
                    codes = np.array([c for _, c in named[part]], np.int64)
                    yield row(1, part, None, _pack_strings([
                        _pack_strings([w for w, _ in named[part]]), _pack_codes(codes),
                        _pack_strings([w for w, _ in own]), begin.to_bytes(8, "little")]))
                begin += len(own)
            for at in range(0, len(ids), 2000):
                some = coded[at: at + 2000]
                counts = np.fromiter(map(len, some), "<u4", len(some))
                data = _pack_strings([counts.tobytes(), _pack_codes(renumber[np.concatenate(some)])])
                yield row(0, -1, ids[at: at + 2000], data)

        ids: list = []
        coded: list[np.ndarray] = []
        table: defaultdict[str, int] = defaultdict()
        table.default_factory = table.__len__
        size = 0
        for b in batches:
            id_arrow = b.schema.field(0).type
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                found = find(text.as_py())
                coded.append(np.fromiter(map(table.__getitem__, found), np.uint32, len(found)))
                ids.append(key)
                size += text.as_buffer().size + 64
                if size > BLOCK_BYTES:
                    yield from block_rows(ids, coded, list(table))
                    ids, coded, size = [], [], 0
                    table = defaultdict()
                    table.default_factory = table.__len__
        if ids:
            yield from block_rows(ids, coded, list(table))

    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("doc_ids", ids_type), T.StructField("data", T.BinaryType())])
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_ff_text")).mapInArrow(split, schema)


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """The token-byte table: the bytes of each id."""
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids[, decoded]) of every row; ``ids`` are little-endian unsigned 32-bit
    integers; with ``decoded`` their bytes as :func:`decode_ids` gives them, in the same pass.

    Every match of ``pattern`` in the whole text is encoded by itself. Texts
    become positions in a block's dictionary; the dictionaries' words are
    shuffled by hash, each distinct word of a hash part is encoded once for
    all blocks, and the ids go back to the blocks, where texts are put
    together by position. A part's blocks are streamed past its table of
    distinct words, so only that table grows with a part; more shuffle
    partitions make it smaller. Null or empty text has no ids. Null and repeated
    ids are encoded row by row (in no certain order); an empty table gives
    an empty result; other columns are not read. The words are checkpointed,
    so a lost executor repeats no other step.
    """
    parts = shuffle_partitions(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    pieces = frozen(split_words(docs, pattern, parts, id_col, text_col))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        # A word is one match already: the pattern takes all of it.
        coder = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        known: dict[bytes, list[int]] = {}

        def ids_of(packed: bytes) -> bytes:
            words = _unpack_strings(packed)
            for w in words:
                if w not in known:
                    known[w] = coder.encode_ordinary(w.decode("utf-8", "surrogatepass"))
            return _pack_ids([known[w] for w in words])

        for b in batches:
            for i in range(b.num_rows):  # one block's share at a time, never a part's whole
                named, codes, others, begin = _unpack_strings(b.column(1)[i].as_py())
                coded = _pack_strings([ids_of(named), codes, ids_of(others), begin])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array([coded], pa.binary())], ["block", "data"])

    found = pieces.where("kind = 1").select("block", "data", "part").repartition(parts, "part").mapInArrow(encode, "block long, data binary")

    def join(texts: pa.Table, words: pa.Table) -> pa.Table:
        table = token_bytes(ranks).__getitem__ if decoded else None
        sizes_of, ids_of, codes_of = [], [], []
        for packed in words.column("data"):
            named, codes, others, begin = _unpack_strings(packed.as_py())
            for ids, own in ((named, _unpack_codes(codes)), (others, None)):
                n, flat = _unpack_ids(ids)
                sizes_of.append(n.astype(np.int64))
                ids_of.append(flat)
                codes_of.append(own if own is not None else int.from_bytes(begin, "little") + np.arange(len(n)))
        if sizes_of:
            n, flat, codes = np.concatenate(sizes_of), np.concatenate(ids_of), np.concatenate(codes_of)
            sizes, begins = np.zeros(codes.max() + 1 if len(codes) else 0, np.int64), np.zeros(codes.max() + 1 if len(codes) else 0, np.int64)
            sizes[codes], begins[codes] = n, np.cumsum(n) - n
        keys, counts, out, bytes_ = [], [], [], []
        for ids, packed in zip(texts.column("doc_ids"), texts.column("data")):
            lengths, codes = _unpack_strings(packed.as_py())
            ends = np.cumsum(np.frombuffer(lengths, "<u4"), dtype=np.int64)
            c = _unpack_codes(codes)
            for key, a, b in zip(ids.as_py(), [0, *ends.tolist()], ends.tolist()):
                keys.append(key)
                k = sizes[c[a:b]] if b > a else np.zeros(0, np.int64)
                stop = np.cumsum(k)
                own = flat[np.repeat(begins[c[a:b]] - (stop - k), k) + np.arange(stop[-1])].astype("<u4") if b > a else k.astype("<u4")
                counts.append(len(own))
                out.append(own.tobytes())
                if table:
                    bytes_.append(b"".join(map(table, own.tolist())))
        columns = {"doc_id": pa.array(keys, texts.schema.field("doc_ids").type.value_type), "n_tokens": pa.array(counts, pa.int64()),
                   "ids": pa.array(out, pa.binary())}
        return pa.table(columns | ({"decoded": pa.array(bytes_, pa.binary())} if decoded else {}))

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                           *([T.StructField("decoded", T.BinaryType())] if decoded else [])])
    texts = pieces.where("kind = 0").select("block", "doc_ids", "data")
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(join, schema)


def decode_ids(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the bytes of the ids, by a join with the token-byte table (fixed size: it travels with the tasks).

    An id without a token raises; null ids stay null.
    """
    tokens = token_bytes(ranks)
    names = encoded.columns
    at = names.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if x is None else b"".join([tokens[i] for i in np.frombuffer(x, "<u4").tolist()])
                     for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary())], [*names, out])

    return encoded.mapInArrow(decode, T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())]))
