"""Best-fit packing of tokenised documents with large-item matching.

A piece above a third of the capacity shares its sequence with at most one other such
piece, so those are paired greedily: the longest with the longest that still fits.  The
other pieces go, longest first, into the tightest gap that holds them.

Lengths are whole numbers up to the capacity.  The plan is therefore made once from the
histogram of lengths, a table of at most ``capacity`` rows whatever the corpus holds: it
says for the k-th piece of a length which sequence and offset it takes.  Pieces are
numbered within their length by one range exchange and then look the plan up.
"""

from __future__ import annotations

import bisect
import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probewatch.llm.common import ranked, settle, tidy, values

CAPACITY = 2048
END_ID = 0
#: Words whose ids one Python worker remembers, in each of two tables.
CACHE_WORDS = 280_000

#: A text is read word by word unless a space precedes white space or the end, a line
#: break precedes other white space, or other white space occurs.
_IRREGULAR = re.compile(r"[ ](?:\s|\Z)|\n[^\S ]|[^\S \n]")


def _as_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class _Ids(dict):
    """Ids of a word, as bytes; a word that is not known yet is encoded when asked for.

    Words are kept in two generations: when the younger one is full it becomes the older
    one, from which words that occur again are taken over.
    """

    def __init__(self, encode, lead: str):
        self.encode, self.lead, self.older = encode, lead, {}

    def __missing__(self, word: str) -> bytes:
        value = self.older.get(word)
        if value is None:
            value = _as_bytes(self.encode(self.lead + word)) if word or self.lead else b""
        if len(self) >= CACHE_WORDS // 2:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value


class Encoder:
    """Ids of whole texts under a byte-level vocabulary, as little-endian 32-bit bytes.

    Tokens of this vocabulary never cross the border between a character and a single
    space after it, nor a single line break, so words are encoded one by one and
    remembered.  Texts with runs of white space are encoded as a whole.

    With ``added``, a tokenizer's json, the added tokens that it lists have one id each
    wherever a text holds them, and what lies between is encoded by itself, as
    ``tokenizers`` does.  Without it they are ordinary text.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str, added: str | None = None):
        import base64
        import json

        import tiktoken
        table = {}
        with open(ranks, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                table[base64.b64decode(token)] = int(rank)
        self.encode = tiktoken.Encoding(vocabulary, pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.first, self.later = _Ids(self.encode, ""), _Ids(self.encode, " ")
        self.line_break = np.array(self.encode("\n"), "<u4").tobytes()
        self.added, self.borders = {}, None
        if added:
            with open(added, encoding="utf-8") as file:
                tokens = json.load(file)["added_tokens"]
            if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
                raise ValueError("added tokens that look at what is beside them are not supported")
            self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in tokens}
        if self.added:
            self.borders = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})")

    def __call__(self, text: str) -> bytes:
        if self.borders and any(t in text for t in self.added):
            return b"".join(self.added[part] if k % 2 else self.ordinary(part) for k, part in enumerate(self.borders.split(text)))
        return self.ordinary(text)

    def ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        if _IRREGULAR.search(text):
            return np.array(self.encode(text), "<u4").tobytes()
        first, later = self.first, self.later.__getitem__
        lines = []
        for line in text.split("\n"):
            words = line.split(" ")
            lines.append(first[words[0]] + b"".join(map(later, words[1:])))
        return self.line_break.join(lines)


_encoders: dict[tuple, Encoder] = {}


def encoder(*files) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if files not in _encoders:
        _encoders[files] = Encoder(*files)
    return _encoders[files]


PIECES = "piece int, start long, length long, ids_crc32 long"


def _cut(files, capacity, row_column):
    def run(batches):
        encode = encoder(*files)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            end = np.array([END_ID], "<u4").tobytes()
            for at, text in enumerate(values(batch.column(batch.schema.get_field_index(row_column)))):
                ids = encode(text or "") + end
                n = len(ids) // 4
                head = n - (n - 1) // capacity * capacity
                begin = 0
                for k in range((n - 1) // capacity + 1):
                    stop = head + k * capacity
                    rows.append(at)
                    piece.append(k)
                    start.append(begin)
                    length.append(stop - begin)
                    crc.append(zlib.crc32(ids[4 * begin:4 * stop]))
                    begin = stop
            kept = batch.select([c for c in batch.schema.names if c != row_column]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                [*kept.schema.names, "piece", "start", "length", "ids_crc32"])
    return tidy(run)


def cut_pieces(docs: DataFrame, files: tuple[str, ...], capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids and an end id, cut into pieces of at most ``capacity`` ids.

    Only the first piece of a document may be shorter.  A null text is empty: one piece
    with the end id alone.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(_cut(files, capacity, "text"), f"doc_id long, {PIECES}")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first number, count, first sequence, offset) for a histogram of lengths.

    Pieces ``first number ..`` of a length go one each into consecutive sequences.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    runs, sequence = [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, count)
    sizes: list[int] = []

    def put(length, count, first, offset):
        runs.append((length, used[length], count, first, offset))
        used[length] += count
        left[length] -= count

    def leave(gap, first, count):
        if gap:
            if gap not in gaps:
                bisect.insort(sizes, gap)
            gaps.setdefault(gap, []).append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - a) - 1
        while at >= 0 and (not left[large[at]] or large[at] == a and left[a] < 2):
            at -= 1
        if at < 0:
            count = left[a]
            put(a, count, sequence, 0)
            leave(capacity - a, sequence, count)
        else:
            b = large[at]
            count = left[a] // 2 if a == b else min(left[a], left[b])
            put(a, count, sequence, 0)
            put(b, count, sequence, a)
            leave(capacity - a - b, sequence, count)
        sequence += count
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(at)
            else:
                gap, first = capacity, sequence
                count = -(-left[length] // (capacity // length))
                sequence += count
            took = min(count, left[length])
            put(length, took, first, capacity - gap)
            if took < count:
                leave(gap, first + took, count - took)
            leave(gap - length, first, took)
    return runs


def _placed(table):
    """Look up sequence and offset of the k-th piece of a length."""
    def run(batches):
        index = {}
        for length, number, count, first, offset in table.value:
            index.setdefault(length, ([], [], []))
            for column, value in zip(index[length], (number, first, offset)):
                column.append(value)
        index = {n: tuple(np.array(c, np.int64) for c in columns) for n, columns in index.items()}
        for batch in batches:
            lengths, numbers = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "number"))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                number, first, offsets = index[int(n)]
                run_at = np.searchsorted(number, numbers[at], "right") - 1
                sequence[at] = first[run_at] + numbers[at] - number[run_at]
                offset[at] = offsets[run_at]
            kept = batch.select([c for c in batch.schema.names if c != "number"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence), pa.array(offset)],
                                             [*kept.schema.names, "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    Sequences have no gaps: the offset of a piece is the length of what lies before it.
    Pieces of equal length are numbered by doc_id, piece, start and checksum, so the result
    is the same at each run; equal rows are interchangeable.  An empty table stays empty.
    """
    numbered = ranked(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "number", keep=capacity)
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = sorted(plan(histogram, capacity))
    table = pieces.sparkSession.sparkContext.broadcast(runs)
    return numbered.mapInArrow(_placed(table), f"doc_id long, {PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, files: tuple[str, ...], capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack all documents; one row per piece.

    ``files`` are a name, the vocabulary as ranks, its word pattern and, if given, the json
    that lists added tokens.  Extra columns are ignored, repeated rows are packed as often as
    they occur, a null id stays null.
    """
    return pack(settle(cut_pieces(docs, files, capacity)), capacity)
