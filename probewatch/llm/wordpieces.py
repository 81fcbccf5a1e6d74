"""SentencePiece encoding and decoding by a forward pass over shared prefixes.

The distinct marked words of a batch are sorted, which is a depth-first walk of their trie:
a word takes over the forward states of the prefix that it shares with the word before it
and computes only the rest.  For a model of merges the state of a prefix is its last piece.
A sequence of pieces is what the merges give exactly when each two neighbours are (they
would not merge otherwise if they stood alone), so for every prefix one last piece fits the
state before it; this takes the place of the best score, whose maximum the merges do not
in general reach.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words that a Python worker remembers, and pairs of pieces before it starts anew.
CACHE_WORDS, CACHE_PAIRS = 400_000, 1_000_000

_SPACED = re.compile(f"{MARK}*[^{MARK}]*")


class Pieces:
    """Pieces of a merge model with byte fallback, read from its file by the library."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes = [0] * 256
        self.text: list[bytes] = []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                value = int(piece[3:5], 16)
                self.bytes[value] = k
                self.text.append(bytes([value]))
            elif model.is_control(k) or model.is_unknown(k):
                self.text.append(b"" if model.is_control(k) else " ⁇ ".encode())
            else:
                self.rank[piece] = k
                self.score[piece] = model.get_score(k)
                self.text.append(piece.replace(MARK, " ").encode())
        # pieces that merges never build are no last pieces
        self.built = {p: k for p, k in self.rank.items() if len(p) == 1 or self.merge(p) == [p]}
        self.name = {k: p for p, k in self.built.items()}
        #: lengths of the longer pieces that end with two characters, longest first
        lengths: dict[str, set[int]] = {}
        for p in self.built:
            if len(p) > 1:
                lengths.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {end: sorted(n, reverse=True) for end, n in lengths.items()}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, word: str) -> list[str]:
        """The pieces of a word by plain merging: the best adjacent pair first, then the leftmost."""
        parts, score = list(word), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """The two pieces stay apart when they stand alone."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        left_piece, right_piece = self.name[left], self.name[right]
        known = self.pairs[left << 32 | right] = self.merge(left_piece + right_piece) == [left_piece, right_piece]
        return known

    def learn(self, words) -> None:
        """Walk the trie of the words and remember the ids of each."""
        built, lengths, pairs, fits = self.built.get, self.lengths.get, self.pairs, self.fits
        known_pair = pairs.get
        before, last, sizes = "", [0], [0]  # of each prefix: its last piece and the length of that
        for word in sorted(words):
            shared, limit = 0, min(len(word), len(before))
            while shared < limit and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], sizes[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                piece, size = built(word[end - 1], -1), 1  # if no longer piece fits; -1 is an unknown character
                if end > 1:
                    for length in lengths(word[end - 2:end], ()):
                        if length > end:
                            continue
                        right = built(word[end - length:end])
                        if right is None:
                            continue
                        if length < end:
                            left = last[end - length]
                            if left >= 0:
                                fit = known_pair(left << 32 | right)
                                if fit is None:
                                    fit = fits(left, right)
                                if not fit:
                                    continue
                        piece, size = right, length
                        break
                last.append(piece)
                sizes.append(size)
            before = word
            ids, end = [], len(word)
            while end:
                if last[end] >= 0:
                    ids.append(last[end])
                else:
                    ids.extend(self.bytes[b] for b in reversed(word[end - 1].encode("utf-8", "surrogatepass")))
                end -= sizes[end]
            ids.reverse()
            self.words[word] = array("i", ids).tobytes()

    def split(self, text: str) -> list[str]:
        """Marked words: a run of marks and what follows it, cut at line breaks as well."""
        marked = (MARK + text).replace(" ", MARK)
        words = []
        for k, line in enumerate(marked.split("\n")):
            if k:
                words.append("\n")
            if f"{MARK}{MARK}" in line or not line.startswith(MARK):
                words.extend(w for w in _SPACED.findall(line) if w)
            else:
                words.extend([MARK + w for w in line[1:].split(MARK)])
        return words

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self.split(t) if t else [] for t in texts]
        # two generations: words that occur again are taken over from the older one
        if len(self.words) > CACHE_WORDS // 2:
            self.older, self.words = self.words, {}
        new = set()
        for words in split:
            new.update(words)
        new.difference_update(self.words)
        for word in new.intersection(self.older):
            self.words[word] = self.older[word]
        self.learn(new.difference(self.older))
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        text = b"".join(map(self.text.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_models: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One model per Python worker and file."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def _encode(path):
    def run(batches):
        model = pieces(path)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            for k in range(0, len(texts), 512):
                blobs = model.encode(texts[k:k + 512])
                offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), "<i4")))
                part = batch.slice(k, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*batch.schema.names, "ids"])
    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text, ids) of every row; ``path`` is the model file.

    A null or empty text has no ids.  A word's ids are those of the merges; characters
    without a piece become byte pieces.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_encode(path), "doc_id long, text string, ids array<int>")


def _decode(path):
    def run(batches):
        model = pieces(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            texts = [None if x is None else model.decode(x) for x in _arrays(ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])
    return run


def _arrays(lists):
    flat, offsets = np.asarray(lists.values), np.asarray(lists.offsets)
    for k, here in enumerate(lists.is_valid().to_pylist()):
        yield flat[offsets[k]:offsets[k + 1]] if here else None


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded``, the text of ``ids``; null ids give null.  Other columns stay."""
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    return encoded.mapInArrow(_decode(path), schema)


def _digest(batches):
    for batch in batches:
        at = batch.schema.get_field_index
        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in _arrays(batch.column(at("ids")))]
        size = [len(x) for x in _arrays(batch.column(at("ids")))]
        same = [(t or "") == d for t, d in zip(batch.column(at("text")).to_pylist(), batch.column(at("decoded")).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(at("doc_id")), pa.array(size, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)],
            ["doc_id", "n_ids", "ids_crc32", "round_trip"])


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 and round_trip (the decoded ids give the text) of every row.

    The mark itself in a text reads as a space, so such a text does not round-trip.
    """
    def run(batches):  # ``encode`` and ``decode`` one after the other in one worker, so that texts travel once
        return _digest(_decode(path)(_encode(path)(batches)))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
