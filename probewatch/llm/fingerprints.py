"""I-Match fingerprints: hashes of the distinct mid-frequency terms under random lexicons.

Document frequencies are counted over all documents.  The lexicon keeps the terms whose
inverse document frequency lies in a band; the band's lower frequency is a share of the
documents, so the lexicon has at most (mean distinct terms / share) terms however large
the corpus is, and it is broadcast.  Each randomised lexicon is a fixed random subset of
it.  A document keeps the sorted distinct terms that a subset holds and hashes them; the
fingerprint is the list of these hashes.  The subsets differ in density, so that short
and long documents both have subsets that keep a few of their terms: a hash then survives
an edit that leaves those terms alone.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probewatch.llm.common import mix

#: Band of document frequency, as shares of all documents, and the least number of documents.
LOW, HIGH, LEAST = 0.0005, 0.2, 2
#: Random lexicons: for each density (a term is in with this chance) so many subsets.
DENSITIES, PER_DENSITY = (1.0, 1 / 8, 1 / 32, 1 / 128, 1 / 512, 1 / 2048), (1, 6, 10, 12, 12, 8)
#: A density tells two texts' likeness only if at least so many of its subsets keep terms of either.
TELLING = 3
#: Words that a task counts before it hands the counts on.
COUNT_WORDS = 300_000
EMPTY = "-"


def terms(text: str | None) -> set[str]:
    return set(text.lower().split()) if text else set()


def _count(batches):
    counts = Counter()

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "df"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(terms(text))
            if len(counts) > COUNT_WORDS:
                yield out()
                counts = Counter()
    if counts:
        yield out()


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> list[str]:
    """Terms of the band, by document frequencies over all documents."""
    texts = docs.select("text")
    n = texts.count()
    df = texts.mapInArrow(_count, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))
    kept = df.where(F.col("df").between(F.greatest(F.lit(LEAST), F.lit(low * n)), F.lit(max(high * n, LEAST))))
    return sorted(r["term"] for r in kept.select("term").collect())


class Lexicons:
    """A 64-bit hash and the subsets, as columns of a boolean row, of each term."""

    def __init__(self, words: list[str], densities=DENSITIES, per_density=PER_DENSITY):
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        columns, k = [], 0
        for density, times in zip(densities, per_density):
            for _ in range(times):
                k += 1
                columns.append(mix(hashes.copy(), k + 1000) <= np.uint64(min(int(density * 2**64), 2**64 - 1)))
        self.member = np.stack(columns, 1) if len(words) else np.zeros((0, sum(per_density)), bool)
        self.hash = mix(hashes.copy(), 5) if len(words) else hashes
        self.place = {w: i for i, w in enumerate(words)}

    def fingerprint(self, text: str | None) -> str:
        """32-bit hashes of the subsets, comma-joined; a subset that keeps no term reads ``-``.

        A text without any lexicon term ends with a 64-bit hash of all its sorted terms.
        """
        place, words = self.place, terms(text)
        at = np.array([place[w] for w in words if w in place], np.int64)
        if not len(at):
            own = xxhash.xxh3_64_hexdigest(" ".join(sorted(words)).encode("utf-8", "surrogatepass"))
            return ",".join([EMPTY] * self.member.shape[1] + [own])
        at.sort()  # the words are sorted, so this is the order of the terms
        member = self.member[at]
        # the hash of a sorted list of distinct terms: a sum over terms mixed beforehand
        with np.errstate(over="ignore"):
            total = mix((member * self.hash[at][:, None]).sum(0, dtype=np.uint64)) if len(at) else np.zeros(member.shape[1], np.uint64)
        some = member.any(0)
        return ",".join(f"{h & 0xFFFFFFFF:08x}" if s else EMPTY for h, s in zip(total.tolist(), some.tolist()))


def likeness(a: str, b: str) -> float:
    """The largest share of equal hashes that one density has, among its subsets that keep terms of either.

    Densities of fewer than ``TELLING`` such subsets are passed over unless none has more;
    texts without lexicon terms are like those of the same terms only.
    """
    if a == b:
        return 1.0
    a, b, at, best, few = a.split(","), b.split(","), 0, None, []
    if max(len(a), len(b)) > sum(PER_DENSITY):
        return 0.0
    for times in PER_DENSITY:
        pairs = [(x, y) for x, y in zip(a[at:at + times], b[at:at + times]) if x != EMPTY or y != EMPTY]
        at += times
        same = sum(x == y for x, y in pairs)
        if len(pairs) >= TELLING:
            best = max(best or 0.0, same / len(pairs))
        elif pairs:
            few.append((same, len(pairs)))
    return best if best is not None else sum(s for s, _ in few) / sum(n for _, n in few)


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _row(lex, doc_id, text, own, following, theirs):
    changed = edited(text, following)
    print_ = lex.fingerprint(changed) if changed != text else own
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, print_,
            likeness(own, print_), likeness(own, theirs))


def _batch(rows, fields):
    schema = pa.schema(fields)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _pack(batches):
    """Texts compressed, as nearly all that the exchange moves is text."""
    pack = zstandard.ZstdCompressor(level=5).compress
    for batch in batches:
        texts = [pack(t.encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
        columns = [batch.column(k) for k in range(batch.num_columns)]
        columns[1] = pa.array(texts, pa.binary())
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _neighbours(table):
    """Every row with the next one's text; a row that is only a successor ends its stretch."""
    def run(batches):
        lex = table.value
        unpack = zstandard.ZstdDecompressor().decompress
        before = None
        for batch in batches:
            out = []
            for doc_id, text, ends in zip(*(batch.column(k).to_pylist() for k in range(3))):
                text = unpack(text).decode("utf-8", "surrogatepass")
                own = lex.fingerprint(text)
                if before is not None:
                    out.append(_row(lex, *before, text, own))
                before = None if ends else (doc_id, text, own)
            yield _batch(out, _FIELDS)
    return run


def _with_successors(texts: DataFrame, parts: int) -> DataFrame:
    """(doc_id, text, ends), sorted in stretches of ids; each is ended by the first row of the next.

    Stretches are cut at quantiles of the ids, so rows of one id share a stretch.
    """
    probes = [k / parts for k in range(1, parts)]
    cuts = sorted({int(c) for c in texts.select("doc_id").approxQuantile("doc_id", probes, 1 / (4 * parts))}) if parts > 1 else []
    part = F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c <= F.col("doc_id"))), F.lit(0))
    rows = texts.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.when(F.col("doc_id").isNull(), 0).otherwise(part).alias("part"))
    heads = sorted((r["part"], r["h"]["doc_id"], r["h"]["tie"]) for r in rows.groupBy("part").agg(F.min(F.struct("doc_id", "tie")).alias("h")).collect())
    # one row per stretch; the first stretch follows the last
    follow = [(heads[k - 1][0], part, doc_id, tie) for k, (part, doc_id, tie) in enumerate(heads)]
    spark = texts.sparkSession
    table = F.broadcast(spark.createDataFrame(follow, "ended int, head_part int, head_id long, head_tie long"))
    first = rows.join(table, (F.col("part") == F.col("head_part")) & F.col("doc_id").eqNullSafe(F.col("head_id"))
                      & (F.col("tie") == F.col("head_tie"))).dropDuplicates(["ended"])
    columns = ["doc_id", "text", "tie"]
    every = rows.select(*columns, "part", F.lit(False).alias("ends")).unionByName(
        first.select(*columns, F.col("ended").alias("part"), F.lit(True).alias("ends")))
    packed = every.mapInArrow(_pack, "doc_id long, text binary, tie long, part int, ends boolean")
    dealt = packed.repartition(parts, "part").sortWithinPartitions("part", "ends", "doc_id", "tie")
    return dealt.select("doc_id", "text", "ends")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likeness.

    The edited text replaces the last floor(n_chars / 2) code points by the first as many
    of the next document in ascending (doc_id, text hash); the last document takes the
    first one's.  A null text is empty.  Texts without lexicon terms have a fingerprint of
    all their terms.  Null ids come first; repeated rows are neighbours;
    extra columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(Lexicons(lexicon(texts)))
    rows = _with_successors(texts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.mapInArrow(_neighbours(table), SCHEMA)
