"""Fill-in-middle and vector codes against brute force, and their edge cases."""

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from probewatch.llm import codes, middles

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, codes string, distances int, ints string"


# ---------------------------------------------------------------- fill in middle

def middle_of(doc_id, text):
    text = text or ""
    units = re.findall(middles.UNIT, text, re.S)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def check_middles(df):
    rows = df.select("doc_id", "text").collect()
    got = middles.transform(df).select("*", middles.restored().alias("back")).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=str) == sorted((middle_of(*r) for r in rows), key=str)
    assert sorted(r["back"] for r in got) == sorted(r["text"] or "" for r in rows)
    return got


def test_middles_of_all_documents(spark):
    got = check_middles(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_middles_of_odd_texts(spark):
    """Nulls, empty, marks, halves of marks, code points beyond 16 bits, line ends, very long texts, repeated rows."""
    texts = [None, "", " ", "a", "ab", "<", "<P", "x <P> y", "<M>", "a<S", "<S", "P>", "S>", "é日本😀😀ab\r\n\x00  c", "\n\n\n",
             "$1 \\1 \\$2 {3}", "w" * 300_000, "word, " * 100_000, "😀" * 50_000, "<" * 2000]
    rows = [(i, t, "s", 3, "form") for t in texts for i in (None, 0, -5, 7, 8, 9, 10, 11, 12, 2**62)]
    rows += [(7, "twice here", "s", 3, "form")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, n int, form string").repartition(8)
    check_middles(df)
    assert middles.digests(df.limit(0)).count() == 0


def test_restored_text_of_every_digest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    same = middles.digests(docs).join(docs.select("doc_id", "text"), "doc_id")
    assert same.where(F.col("restored_sha256") != F.sha2(F.coalesce("text", F.lit("")), 256)).count() == 0


# ---------------------------------------------------------------- vector codes

def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        out = []
        for row in cut:
            near = []
            for p in range(parts):
                near.append(min((sum((a - b) ** 2 for a, b in zip(row[p], e)), k) for k, e in enumerate(books[p])))
            out.append(near)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            members = defaultdict(list)
            for row, near in zip(cut, found):
                members[near[p][1]].append(row[p])
            for k, own in members.items():
                books[p][k] = tuple(sum(c) // len(own) for c in zip(*own))
    found = assign()
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in near) for near in found]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    return sorted(((i, "".join(f"{k:02x}" for _, k in near), e, by_label[label], digest)
                   for (i, _, label), near, e in zip(kept, found, errors)), key=str)


def got_codes(df):
    return sorted((tuple(r) for r in codes.codes(df).collect()), key=str)


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "y") for i, v, label in rows], VECTORS)


def test_codes_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert got_codes(df) == brute_codes([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])


@pytest.mark.parametrize("size", [1, 5, 64, 300])
def test_codes_with_ties_repeats_and_odd_rows(spark, size):
    """Few distinct values, so that distances tie; null, empty-component and non-finite vectors; null labels and ids."""
    rng = np.random.default_rng(size)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 32) / 128], [None, 1, 2][i % 3]) for i in rng.integers(0, size, size)]
    rows += rows[:3]
    rows += [(1, None, 1), (2, [1.0] * 31 + [None], 1), (0, [float("nan")] * 32, 2), (0, [float("inf")] * 32, 2)]
    rows.append((None, [0.5] * 32, None))
    assert got_codes(vectors_of(spark, rows)) == brute_codes(rows)


def test_codes_of_large_components_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1e4 if i % 2 else 1e7, 16)], 1) for i in range(200)]
    expected = [(i, c, e if e < 2**63 else None, total if total < 2**63 else None, d) for i, c, e, total, d in brute_codes(rows)]
    assert got_codes(vectors_of(spark, rows)) == sorted(expected, key=str)


def test_codes_without_kept_vectors_and_of_odd_lengths(spark):
    assert got_codes(vectors_of(spark, [])) == []
    assert got_codes(vectors_of(spark, [(1, None, 1)])) == []
    padded = [(1, [1.0, 2.0, 3.0], 1), (2, [4.0, 5.0, 6.0], 2)]
    full = [(i, v + [0.0] * 13, label) for i, v, label in padded]
    assert got_codes(vectors_of(spark, padded + [(3, [1.0], 1)])) == brute_codes(full)


def test_renewed_codes_equal_full_scans():
    """Whatever entries move, and with many ties, the active-entry step gives what a full scan gives."""
    rng = np.random.default_rng(5)
    for _ in range(40):
        parts = rng.integers(-3, 4, (50, codes.PARTS, 2))
        books = rng.integers(-3, 4, (codes.PARTS, 9, 2))
        own, far = codes.nearest(parts, books)
        moved = rng.random((codes.PARTS, 9)) < rng.choice([0, 0.2, 0.7, 1])
        books = np.where(moved[:, :, None], rng.integers(-3, 4, books.shape), books)
        codes.renew(parts, books, moved, own, far)
        expected = codes.nearest(parts, books)
        assert (own == expected[0]).all() and (far == expected[1]).all()
