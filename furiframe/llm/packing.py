"""Best-fit packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furiframe.llm.common import frozen, ranked, text_or_empty

_SLICE_BYTES = 6 << 20
_CACHED_RUNS, _CACHED_PARTS = 100_000, 350_000
_ENDS = frozenset(".,;:!?")
# Plain words: characters below U+0250, where composition changes nothing and lower-casing one character
# gives one (but for U+0130).
_PLAIN = re.compile("[\x00-\u012f\u0131-\u024f]*")


def _byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """Token ids of whole texts with a tokenizer that splits at white space, lower-cases, splits by a
    pattern and writes bytes (``word_bpe``).

    Ids are looked up run by run (a run: characters between white space).
    A new run of plain characters is split here and its parts go straight to
    the tokenizer's merge model, each part once; any other run goes through
    the whole tokenizer. Texts that hold the string of a special token go
    through it whole, as it cuts them there. Caches of runs and parts are
    emptied when large.
    """

    def __init__(self, tokenizer_json: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        steps = json.loads(tokenizer_json)
        if any(t["normalized"] for t in steps["added_tokens"]):
            raise ValueError("added tokens must be matched in the text as it is")
        kinds = [n["type"] for n in steps["normalizer"]["normalizers"]]
        split, level = steps["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or level["type"] != "ByteLevel" or level["add_prefix_space"]:
            raise ValueError("this tokenizer does not work by words")
        self.parts_of = regex.compile(split["pattern"]["Regex"]).findall
        self.merge = self.tokenizer.model.tokenize
        self.whole = "|".join(["[\x1c-\x1f]", *(re.escape(t["content"]) for t in steps["added_tokens"])])
        self.letters = _byte_alphabet()
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.runs: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.width).tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            written = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.letters)
            ids = self.parts[part] = self._pack([t.id for t in self.merge(written)])
        return ids

    def _run(self, run: str) -> bytes:
        if not (run.isascii() or _PLAIN.fullmatch(run)):
            return self._pack(self.tokenizer.encode(run, add_special_tokens=False).ids)
        # Letters alone, or with one mark behind them, need no pattern.
        if run.isalpha():
            return self._part(run.lower())
        if run[-1:] in _ENDS and run[:-1].isalpha():
            return self._part(run[:-1].lower()) + self._part(run[-1])
        return b"".join([self._part(p) for p in self.parts_of(run.lower())])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        split = pc.utf8_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        codes, runs = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.runs) > _CACHED_RUNS:
            self.runs.clear()
        if len(self.parts) > _CACHED_PARTS:
            self.parts.clear()
        known, get = self.runs, self.runs.get
        ids = [get(r) for r in runs]
        for i, found in enumerate(ids):
            if found is None:
                ids[i] = known[runs[i]] = self._run(runs[i])
        flat = np.frombuffer(b"".join(ids), self.width)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width.itemsize
        begin = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        ends = np.cumsum(counts)
        tokens = flat[np.repeat((begin[codes] - ends + counts).astype(np.int32), counts)
                      + np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)]
        in_doc = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]).astype(np.int64)
        cut = np.concatenate([[0], ends])[in_doc].tolist()
        out = [tokens[a:b] for a, b in zip(cut, cut[1:])]
        # Arrow's white space has four characters more than the tokenizer's: such texts go whole, as do special tokens.
        odd = pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(odd).tolist():
            out[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids)
        return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together up to about a slice: a word that repeats is then looked up once."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= _SLICE_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > _SLICE_BYTES:
            yield start, i
            start, size = i, 0
        size += n
    if len(sizes):
        yield start, len(sizes)


def token_pieces(docs: DataFrame, tokenizer_json: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of every row: (doc_id, piece, start, length, ids_crc32, _ff_row)."""
    id_type = docs.schema[id_col].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer(tokenizer_json)
        for b in _gathered(batches):
            for lo, hi in _slices(b.column(2)):
                part = b.slice(lo, hi - lo)
                source, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(words.encode(part.column(2))):
                    ids = np.append(ids, end_id).astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        own = ids[at: at + capacity]
                        source.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(own))
                        crc.append(zlib.crc32(own.tobytes()))
                take = pa.array(source, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), part.column(1).take(take)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "_ff_row"])

    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("_ff_row", T.LongType())])
    return docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("_ff_row"),
                       text_or_empty(text_col).alias("_ff_text")).mapInArrow(cut, schema)


@dataclass
class Placement:
    """Matches of a run of pieces (one length, consecutive ranks) with a run of gaps (consecutive sequences)."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def best_fit_rounds(sizes: dict[int, int], capacity: int) -> Placement:
    """Bulk-synchronous best fit over sorted runs of pieces and gaps.

    Sorted by size, the pieces are at most ``capacity`` runs of equal length
    and the gaps at most ``capacity`` runs of equal size, whatever the number
    of documents. A round takes the longest run of pieces left: all its
    pieces propose to the successor of their length among the gaps; of a run
    of gaps the lowest ranks win as many as there are gaps, the gaps shrink
    (and are gaps of the next sweep), and the losers propose again. Without
    a successor just as many sequences open as the pieces need.
    """
    gaps: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]
    some = np.zeros(capacity + 1, bool)
    out: list[tuple[int, int, int, int]] = []
    opened = 0
    for length in sorted(sizes, reverse=True):
        rank, left = 0, sizes[length]
        while left:
            fit = int(some[length:].argmax()) + length
            if not some[fit]:
                new = -(-left // (capacity // length))
                gaps[capacity].append((opened, new))
                some[capacity] = True
                opened += new
                fit = capacity
            first, n = gaps[fit].popleft()
            won = min(n, left)
            if won < n:
                gaps[fit].appendleft((first + won, n - won))
            some[fit] = bool(gaps[fit])
            if fit > length:
                gaps[fit - length].append((first, won))
                some[fit - length] = True
            out.append((length, rank, first, capacity - fit))
            rank += won
            left -= won
    table = np.array(out, np.int64).reshape(-1, 4)
    return Placement(*table.T)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to (frozen) pieces with a ``length`` of 1 to ``capacity``."""
    # At most ``capacity`` rows come to the driver, whatever the input.
    sizes = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit_rounds(sizes, capacity)
    by_rank = ranked(pieces, "length", ["_ff_row", "piece"], "_ff_rank")
    shift = 1 << 48
    keys = plan.length * shift + plan.rank
    order = np.argsort(keys)
    keys, ranks, sequences, offsets = keys[order], plan.rank[order], plan.sequence[order], plan.offset[order]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            length = b.column(names.index("length")).to_numpy()
            rank = b.column(names.index("_ff_rank")).to_numpy()
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])],
                [*names[:-1], "sequence_id", "offset"])

    kept = by_rank.select("doc_id", "piece", "start", "length", "ids_crc32", "_ff_rank")
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return kept.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A row's tokens are those of its whole text followed by ``end_id``; a null
    or empty text is ``end_id`` alone. Only rows longer than ``capacity`` are
    cut, into pieces of ``capacity`` and a last one that may be shorter.
    Pieces fill sequences of ``capacity`` gaplessly from offset 0, in as few
    sequences as best fit, longest first, needs. Ties between pieces of one
    length go by row order; null and repeated ids are packed row by row. An
    empty table gives an empty result; other columns are not read.

    Only lengths and checksums leave the tokenising tasks; the pieces are
    range-sorted by length and ranked (a length of any frequency spreads over
    tasks), and each finds its match by its rank.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    pieces = frozen(token_pieces(docs, tokenizer_json, capacity, end_id, id_col, text_col))
    return pack_pieces(pieces, capacity)
