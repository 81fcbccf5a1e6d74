"""Removal of byte strings that occur more than once, found by suffix arrays.

Every string of ``LENGTH`` bytes is told by its anchor: the leftmost of its ``GRAM``-byte
pieces with the least hash.  Equal strings have equal anchors at equal places, so they meet
under the anchor's hash.  The strings of one anchor are neighbours; the bytes they cover
are a *stretch* (a string of a text lies in exactly one).

1. Stretches are counted by (anchor, content), combined per batch before the exchange.
   Anchors met only once are done with.
2. One copy of each distinct stretch (two, if it occurs more than once) goes to a bucket of
   its anchor, and ``suffixes.suffix_arrays`` orders all suffixes there.  Strings that occur
   twice are neighbours in this order, and the neighbours' bytes are compared.  An anchor
   whose stretches are all the same text needs no order.
3. An anchor with more than ``LARGE`` distinct stretches is not gathered in one place.  Its
   stretches are cut into pieces of ``WIDTHS[0]`` strings that start about as far before the
   anchor; these strings share a core of bytes, and pieces meet under the core's hash as
   stretches did under the anchor's.  Where even a core has too many pieces, the next width
   does; at width 1 the core is the string, so nothing is left to order.
4. Repeated strings go back to all places of their stretches and become ranges of bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from probewatch.llm.common import _BYTE, _inverses_to, _powers_to, mix, settle
from probewatch.llm.suffixes import suffix_arrays

LENGTH = 200
GRAM = 40
#: Bytes whose strings are looked at in one go.
SLICE = 1 << 19
#: Distinct stretches of an anchor up to which it is ordered in one place.
LARGE = 512
#: Strings in a piece of a large anchor's stretch, and in a piece of such a piece.
WIDTHS = (16, 1)
#: Bytes of stretches in a bucket, and of those ordered at once.
BUCKET, AT_ONCE = 1 << 20, 1 << 19

_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


# ---------------------------------------------------------------- stretches of texts

def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    n = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0))]).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1:width - 1 + n])


def stretches(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(anchor hash, content hash, text number, first byte in the text, anchor's place behind it, strings - 1) of all stretches.

    ``data`` holds the texts' bytes in a row, ``ends`` where each ends.  A stretch may be cut
    where a slice ends; its strings then lie in two.
    """
    found = [[], [], [], [], []]
    begins = np.concatenate([[0], ends[:-1]])
    for a in range(0, max(0, len(data) - length + 1), SLICE):
        part = data[a:a + SLICE + length - 1]
        n = len(part) - length + 1
        inverse = _inverses_to(len(part))
        with np.errstate(over="ignore"):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * _powers_to(len(part)))])
            grams = mix((total[gram:] - total[:-gram]) * inverse[:len(part) - gram + 1])
            anchor = (_least((grams & _HIGH) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & _LOW).astype(np.int64)
            # strings over the end of a text are none
            over = np.zeros(n + 1, np.int32)
            first, last = np.searchsorted(ends, [a, a + n + length], "right")
            near = slice(first, min(last + 1, len(ends)))
            np.add.at(over, np.clip(np.maximum(ends[near] - length + 1, begins[near]) - a, 0, n), 1)
            np.add.at(over, np.clip(ends[near] - a, 0, n), -1)
            inside = np.flatnonzero(np.cumsum(over)[:n] == 0)
            if not len(inside):
                continue
            at = anchor[inside]
            new = np.concatenate([[True], (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)])
            cut = np.flatnonzero(new)
            low, high, at = inside[cut], inside[np.append(cut[1:], len(inside)) - 1], at[cut]
            content = mix((total[high + length] - total[low]) * inverse[low])
            content = mix(content ^ ((high - low).astype(np.uint64) << np.uint64(32)) ^ (at - low).astype(np.uint64), 3)
        for out, values in zip(found, (grams[at].view(np.int64), content.view(np.int64), low + a, at - low, high - low)):
            out.append(values)
    if not found[0]:
        none = np.empty(0, np.int64)
        return none, none, none, none, none, none
    anchor, content, low, behind, more = (np.concatenate(x) for x in found)
    text = np.searchsorted(ends, low, "right")
    return anchor, content, text, low - begins[text], behind, more


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ends of a column of strings without nulls."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets[1:] - offsets[0]


#: A spot is a place in a text, how far behind it the anchor stands, and the strings there - 1, in one number.
_WIDE = 1 << 16
#: Rows of a batch that are worked on together.
ROWS = 2000
PLACE = "anchor long, content long, key long, spot long"


def _sliced(batches):
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def _places(batch):
    anchor, content, text, low, behind, more = stretches(*_texts(batch.column("text")))
    return anchor, content, batch.column("key").to_numpy(zero_copy_only=False)[text], low * _WIDE + behind * 256 + more


def _spots(batches):
    for batch in _sliced(batches):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _places(batch)], ["anchor", "content", "key", "spot"])


def _tallies(batches):
    """Distinct stretches of some rows: how often each occurs, and where first."""
    for batch in _sliced(batches):
        anchor, content, key, spot = _places(batch)
        sort = np.lexsort((content, anchor))
        a, c = anchor[sort], content[sort]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])])) if len(a) else np.empty(0, np.int64)
        at = sort[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (anchor[at], content[at], np.diff(np.append(first, len(a))), key[at], spot[at])],
            ["anchor", "content", "n", "key", "spot"])


def _pack(batches):
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in _sliced(batches):
        packed = [pack(t.as_buffer()) for t in batch.column("text")]
        columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(packed, pa.binary())], [*columns, "packed"])


# ---------------------------------------------------------------- order within an anchor

def _cut(batches):
    """The bytes of each listed stretch."""
    unpack = zstandard.ZstdDecompressor().decompress
    names = ["anchor", "content", "n", "forms", "spot"]
    for batch in _sliced(batches):
        wanted = batch.column("wanted")
        fields = wanted.flatten()
        number = np.diff(wanted.offsets.to_numpy())
        low, shape = np.divmod(fields.field("spot").to_numpy(), _WIDE)
        ends = (low + shape % 256 + LENGTH).tolist()
        low, at, found = low.tolist(), 0, []
        for k, packed in enumerate(batch.column("packed")):
            text = unpack(packed.as_py())
            found += [text[low[j]:ends[j]] for j in range(at, at + number[k])]
            at += number[k]
        columns = [fields.field(name) for name in names[:-1]]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(shape // 256), pa.array(found, pa.binary())], [*names[:-1], "behind", "bytes"])


def _equal_to_neighbours(text: bytes, at: np.ndarray, length: int) -> np.ndarray:
    """Of strings in ascending order, the starts of those that equal the one before or behind."""
    view = np.ndarray(len(text) - length + 1, f"S{length}", text, strides=(1,))
    # numpy compares such strings without their final zero bytes, which all have the same length to fill
    same = np.empty(max(len(at) - 1, 0), bool)
    for k in range(0, len(same), 1 << 16):
        stretch = view[at[k:k + (1 << 16) + 1]]
        same[k:k + (1 << 16)] = stretch[1:] == stretch[:-1]
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    return at[twice]


def _runs(marked: np.ndarray) -> list[int]:
    """First and last places of the runs of true values, in a row."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    return [x for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) for x in (a, b - 1)]


def repeated_strings(groups: list[list[tuple[int, bytes]]], length: int = LENGTH) -> list[list[list[int]]]:
    """For each group of (occurrences, stretch): runs of string starts in each stretch that occur twice in the group."""
    texts, starts = [], []
    for group in groups:
        parts, own, at = [], [], 0
        for n, stretch in group:
            own.append(at)
            for _ in range(min(n, 2)):
                parts.append(stretch)
                at += len(stretch)
        texts.append(b"".join(parts))
        starts.append(own)
    out = []
    for group, text, own, order in zip(groups, texts, starts, suffix_arrays(texts)):
        whole = np.zeros(len(text), bool)  # starts of strings that lie in one stretch
        at = 0
        for n, stretch in group:
            for _ in range(min(n, 2)):
                whole[at:at + len(stretch) - length + 1] = True
                at += len(stretch)
        order = order[whole[order]]
        twice = np.zeros(len(text), bool)
        if len(order) > 1:
            twice[_equal_to_neighbours(text, order, length)] = True
        out.append([_runs(twice[a:a + len(stretch) - length + 1]) for a, (_, stretch) in zip(own, group)])
    return out


def _order(table: pa.Table) -> pa.Table:
    """Runs of repeated strings in the stretches of one bucket."""
    groups: dict[int, dict[int, tuple[int, bytes]]] = {}
    columns = (table.column(name).to_pylist() for name in ("anchor", "content", "n", "bytes"))
    for anchor, content, n, stretch in zip(*columns):
        groups.setdefault(anchor, {})[content] = (n, stretch)
    size = {anchor: sum(min(n, 2) * len(s) for n, s in own.values()) for anchor, own in groups.items()}
    out = {"anchor": [], "content": [], "runs": []}
    batch, total = [], 0
    for anchor in [*sorted(groups, key=size.get), None]:  # texts of like size step together
        if batch and (anchor is None or total + size[anchor] > AT_ONCE):
            for a, runs in zip(batch, repeated_strings([list(groups[a].values()) for a in batch])):
                for content, run in zip(groups[a], runs):
                    if run:
                        out["anchor"].append(a)
                        out["content"].append(content)
                        out["runs"].append(run)
            batch, total = [], 0
        if anchor is not None:
            batch.append(anchor)
            total += size[anchor]
    return pa.table([pa.array(out["anchor"], pa.int64()), pa.array(out["content"], pa.int64()), pa.array(out["runs"], pa.list_(pa.int32()))],
                    ["anchor", "content", "runs"])


def _pieces(width: int):
    """Pieces of at most ``width`` strings, under the hash of the core that all strings at such a place share."""
    def run(batches):
        names = ["anchor", "content", "start", "core", "piece", "n", "behind", "bytes"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        number = lambda *parts: int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)
        for batch in _sliced(batches):
            rows = []
            for anchor, content, n, behind, text in zip(*(batch.column(k).to_pylist() for k in ("anchor", "content", "n", "behind", "bytes"))):
                far, near = behind, behind - (len(text) - LENGTH)  # of the first and the last string before the anchor
                for k in range(near // width, far // width + 1):
                    start, last = behind - min(width * k + width - 1, far), behind - max(width * k, near)
                    own = text[start:last + LENGTH]
                    core = text[behind - width * k:behind - width * k - width + 1 + LENGTH]
                    tag = anchor.to_bytes(8, "little", signed=True) + k.to_bytes(2, "little")
                    rows.append((anchor, content, start, number(tag, core), number(tag, (behind - start).to_bytes(2, "little"), own),
                                 n, behind - start, own))
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names)
    return run


#: Distinct stretches (or pieces) with the number of them that share their anchor (or core).
FORMS = "anchor long, content long, n long, forms long, behind long, bytes binary"
RUNS = "anchor long, content long, runs array<int>"


def _ordered(forms: DataFrame) -> DataFrame:
    """Runs of repeated strings by suffix arrays, for anchors of a bounded number of forms."""
    size = forms.agg(F.sum(F.length("bytes"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(size // BUCKET + 1)).cast("int")
    return forms.select(bucket.alias("bucket"), "anchor", "content", "n", "bytes").groupBy("bucket").applyInArrow(_order, RUNS)


def _refined(forms: DataFrame, widths: tuple[int, ...]) -> DataFrame:
    """Runs of repeated strings of anchors with any number of forms, by pieces that share a core."""
    pieces = settle(forms.mapInArrow(_pieces(widths[0]), "anchor long, content long, start int, core long, piece long, n long, behind long, bytes binary"))
    tallies = pieces.groupBy(F.col("core").alias("anchor"), F.col("piece").alias("content")).agg(
        F.sum("n").alias("n"), F.first("behind").alias("behind"), F.first("bytes").alias("bytes"))
    several = tallies.groupBy("anchor").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("forms")).where(F.col("all") > 1)
    met = settle(tallies.join(several, "anchor").select("anchor", "content", "n", "forms", "behind", "bytes"))
    whole = met.where("forms = 1").select("anchor", "content", F.array(F.lit(0), F.length("bytes") - LENGTH).alias("runs"))
    found = whole.unionByName(_ordered(met.where(F.col("forms").between(2, LARGE))))
    large = met.where(F.col("forms") > LARGE)
    if large.limit(1).count():
        found = found.unionByName(_refined(large, widths[1:]))
    found = found.select(F.col("anchor").alias("core"), F.col("content").alias("piece"), "runs")
    found = pieces.join(found, ["core", "piece"]).select("anchor", "content", F.struct("start", "runs").alias("part"))
    found = found.groupBy("anchor", "content").agg(F.collect_list("part").alias("parts"))
    moved = F.flatten(F.transform("parts", lambda p: F.transform(p["runs"], lambda r: r + p["start"])))
    return found.select("anchor", "content", moved.alias("runs"))


# ---------------------------------------------------------------- ranges of bytes

REMOVED = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def _spans(found, length: int = LENGTH) -> list[tuple[int, int]]:
    """Merged ranges of bytes of repeated strings, from (spot, runs)."""
    ranges = []
    for one in found or ():
        low = one["spot"] // _WIDE
        ranges += [(low + a, low + b + length) for a, b in zip(one["runs"][::2], one["runs"][1::2])]
    out = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kept(batches):
    unpack = zstandard.ZstdDecompressor().decompress
    names = ["doc_id", "n_bytes", "spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    for batch in _sliced(batches):
        out = [batch.column("doc_id").to_pylist(), [], [], []]
        for packed, found in zip(batch.column("packed").to_pylist(), batch.column("found").to_pylist()):
            text = unpack(packed)
            spans = _spans(found)
            edges = [0, *(x for span in spans for x in span), len(text)]
            out[1].append(len(text))
            out[2].append([{"start": a, "end": b} for a, b in spans])
            out[3].append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds)], names)


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): a key of its own for every row, the id itself where all ids are there and differ."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").limit(1).count():
        return settle(rows.withColumn("key", F.monotonically_increasing_id())).select("key", "doc_id", "text")
    return rows.select(F.col("doc_id").alias("key"), "doc_id", "text")


def repeated(rows: DataFrame) -> DataFrame:
    """(anchor, content, runs) of all stretches of (key, text) with strings that occur twice; a table in the shared folder."""
    tallies = rows.select("key", "text").mapInArrow(_tallies, "anchor long, content long, n long, key long, spot long")
    # one exchange serves the distinct stretches and their anchors
    distinct = tallies.repartition("anchor").groupBy("anchor", "content").agg(
        F.sum("n").alias("n"), F.first("key").alias("key"), F.first("spot").alias("spot"))
    anchor = Window.partitionBy("anchor")
    met = distinct.withColumns({"all": F.sum("n").over(anchor), "forms": F.count(F.lit(1)).over(anchor)})
    met = settle(met.where(F.col("all") > 1).drop("all"))
    wanted = met.where("forms > 1").groupBy("key").agg(
        F.collect_list(F.struct("anchor", "content", "n", "forms", "spot")).alias("wanted"))
    packed = rows.select("key", "text").mapInArrow(_pack, "key long, packed binary")
    forms = settle(packed.join(wanted, "key").select("packed", "wanted").mapInArrow(_cut, FORMS))
    whole = met.where("forms = 1").select("anchor", "content", F.array(F.lit(0), (F.col("spot") % 256).cast("int")).alias("runs"))
    found = whole.unionByName(_ordered(forms.where(F.col("forms") <= LARGE)))
    large = forms.where(F.col("forms") > LARGE)
    if large.limit(1).count():
        found = found.unionByName(_refined(large, WIDTHS))
    return settle(found)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): every text without the bytes of repeated strings of ``LENGTH`` bytes.

    ``spans`` are the maximal removed ranges of bytes, ``kept`` the remaining bytes, which may
    cut a code point.  All occurrences go, the first one too; strings are judged on the whole
    input and never cross texts, but may overlap in one.  A null text is empty, a text under
    ``LENGTH`` bytes is kept, repeated rows are texts of their own (so long ones vanish),
    ids may be null or repeated.  An empty table gives an empty result; extra columns are
    ignored.
    """
    rows = _keyed(docs)
    runs = repeated(rows)
    found = rows.select("key", "text").mapInArrow(_spots, PLACE).join(runs, ["anchor", "content"])
    found = found.groupBy("key").agg(F.collect_list(F.struct("spot", "runs")).alias("found"))
    packed = rows.mapInArrow(_pack, "key long, doc_id long, packed binary")
    return packed.join(found, "key", "left").select("doc_id", "packed", "found").mapInArrow(_kept, REMOVED)


def digests(docs: DataFrame) -> DataFrame:
    """Per document: sizes of the text and of what goes, number of removed ranges, hash of what stays."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
