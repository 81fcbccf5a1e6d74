"""Suffix arrays and the removal of repeated passages against brute force, and their edge cases."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from probewatch.llm import passages
from probewatch.llm.suffixes import suffix_arrays

SF = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text("ab").map(str.encode), st.binary(max_size=30), st.integers(0, 40).map(lambda n: b"ab" * n),
                          st.integers(0, 60).map(lambda n: b"\0" * n)), max_size=6))
def test_suffix_arrays_equal_sorted_suffixes(texts):
    assert [a.tolist() for a in suffix_arrays(texts)] == [sorted(range(len(t)), key=lambda i: t[i:]) for t in texts]


def test_suffix_arrays_of_long_repeats():
    rng = np.random.default_rng(2)
    line = bytes(rng.integers(97, 101, 150).astype(np.uint8).tolist())
    texts = [line * 12, b"a" * 3000, b"ab" * 700 + b"a", bytes(rng.integers(0, 256, 4000).astype(np.uint8).tolist()), b"ba" * 900]
    assert [a.tolist() for a in suffix_arrays(texts)] == [sorted(range(len(t)), key=lambda i: t[i:]) for t in texts]


def expected(rows, length=passages.LENGTH):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[s:s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 2, bool)
        for s in range(len(b) - length + 1):
            if count[b[s:s + length]] > 1:
                gone[s + 1:s + length + 1] = True
        spans = int((np.diff(gone.astype(np.int8)) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone[1:-1]].tobytes()
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in passages.digests(df).collect()), key=str)


def check(df):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    found = got(df)
    assert found == expected(rows)
    return found


def test_removal_equals_brute_force(spark):
    found = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert any(r[2] for r in found) and any(not r[2] for r in found)


@pytest.fixture(scope="module")
def shared(spark):
    """Copies with edits, passages of 199 to 201 bytes, periods shorter and longer than an anchor, code points of four bytes."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(chr(97 + k) for k in rng.integers(0, 26, rng.integers(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    origin, texts = prose(120), []
    for _ in range(40):
        words = origin.split()
        for at in rng.choice(len(words), rng.integers(0, 6), replace=False):
            words[at] = word()
        texts.append(" ".join(words))
    for size in (198, 199, 200, 201, 202):
        line = prose(60)[:size]
        texts += [prose(20) + "#" + line + "#" + prose(20), "~" + line + "~", line + prose(3)]
    texts += ["ab" * 120, "ab" * 99 + "a", "x" * 200, "x" * 199, "x" * 201, "y" * 200, origin[:45] * 9, prose(300), prose(300)]
    texts += ["😀é日" * 60, "😀é日" * 21 + "!", "\0" * 500, None, "", " ", prose(40) + "\0" * 200]
    texts += [texts[0]] * 3 + [prose(50) + texts[1] + prose(50) + texts[1][:400]]
    rows = [(k, t, "s", 1, 2, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, n int, spot int, found string").repartition(7)


def test_removal_of_shared_passages(shared):
    check(shared)


def test_removal_where_ids_repeat_or_lack(spark, shared):
    check(shared.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 5)))
    twice = shared.unionByName(shared)
    found = check(twice)
    assert all(r[2] == r[1] for r in found if r[1] >= passages.LENGTH)


def test_removal_with_all_limits_small(shared, monkeypatch):
    """Anchors of more than one or three forms are cut into pieces, twice, and the others lie in many buckets."""
    monkeypatch.setattr(passages, "BUCKET", 2000)
    for large in (1, 3):
        monkeypatch.setattr(passages, "LARGE", large)
        check(shared)


def test_stretches_of_small_slices_hold_every_string(monkeypatch):
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8).tolist()) for n in (0, 5, 199, 200, 201, 900, 0, 2500, 150)]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    for size in (1 << 20, 300, 37):
        monkeypatch.setattr(passages, "SLICE", size)
        anchor, _, text, low, _, more = passages.stretches(data, ends)
        held = sorted((t, s) for t, a, m in zip(text.tolist(), low.tolist(), more.tolist()) for s in range(a, a + m + 1))
        assert held == [(k, s) for k, t in enumerate(texts) for s in range(len(t) - passages.LENGTH + 1)]


def test_repeated_strings_in_small_batches(monkeypatch):
    rng = np.random.default_rng(7)
    groups = [[(int(rng.integers(1, 4)), bytes(rng.integers(97, 99, rng.integers(4, 12)).astype(np.uint8).tolist())) for _ in range(rng.integers(1, 6))]
              for _ in range(50)]
    for group, runs in zip(groups, passages.repeated_strings(groups, 4)):
        count = Counter()
        for n, s in group:
            count.update({w: n * c for w, c in Counter(s[k:k + 4] for k in range(len(s) - 3)).items()})
        for (_, s), run in zip(group, runs):
            marked = {k for a, b in zip(run[::2], run[1::2]) for k in range(a, b + 1)}
            assert marked == {k for k in range(len(s) - 3) if count[s[k:k + 4]] > 1}


def test_removal_from_nothing_and_from_a_very_long_text(spark, shared):
    assert got(shared.limit(0)) == []
    rng = np.random.default_rng(8)
    long = "".join(chr(97 + k) for k in rng.integers(0, 26, 700_000))
    df = spark.createDataFrame([(1, long), (2, long[5000:5400]), (3, "z" * 100 + long[600_000:600_250])], "doc_id long, text string")
    assert [r[2] for r in got(df)] == [650, 400, 250]
