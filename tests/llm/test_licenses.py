"""The license scan against plain containment: edited whole texts, long documents, many templates."""

import random
import re

from probewatch.llm import licenses


def _shingles(text):
    words = re.findall(r"[^\W_]+", text.lower())
    return [tuple(words[k:k + licenses.WIDTH]) for k in range(len(words) - licenses.WIDTH + 1)]


def _best(doc, template):
    """Greatest containment of a template in a stretch of its own length, over all places."""
    doc, want = _shingles(doc), _shingles(template)
    n, kinds = len(want), set(want)
    return max((len(kinds & set(doc[k:k + n])) / len(kinds) for k in range(max(1, len(doc) - n + 1))), default=0)


def _edited(text, rate, rng):
    return " ".join(f"edit{rng.randrange(10**6)}" if rng.random() < rate else w for w in text.split())


def test_edited_license_texts_are_found(spark):
    """Of notices with 2, 5 and 10 % edited words, all that still contain enough shingles are found."""
    rng = random.Random(5)
    rows, want = [], {}
    for rate in (0, 0.02, 0.05, 0.1):
        for name, text in licenses.NOTICES.items():
            around = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(700))) for _ in range(2)]
            rows.append((len(rows), f"{around[0]} {_edited(text, rate, rng)} {around[1]}"))
    for i, text in rows:
        for name, notice in licenses.NOTICES.items():
            want[i, name] = _best(text, notice)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = licenses.scan(df, licenses.notices(spark)).collect()
    got = {(r["doc_id"], r["template_id"]) for r in found}
    expected = {k for k, v in want.items() if v >= licenses.CONTAINED}
    assert len(expected) >= 45 and len(expected & got) >= 0.98 * len(expected)
    # a stretch is longer than its template by two windows, so a match may hold a little more than the best place
    assert all(want[k] >= licenses.CONTAINED - 0.2 for k in got)


def test_long_texts_full_of_notices(spark):
    """No row carries the whole text: places are found all along 80,000 words, at the ends of pieces too."""
    words = []
    for k in range(13_000):
        words += [f"w{k}", *"released under the mit license".split()]
    df = spark.createDataFrame([(1, " ".join(words)), (None, " ".join(words[:7])), (2, None), (3, "")], "doc_id long, text string")
    got = {(r["doc_id"], r["word"]) for r in licenses.scan(df, licenses.notices(spark)).where("containment = 1").collect()}
    assert {(1, 6 * k + 1) for k in range(13_000)} <= got and (None, 1) in got and {d for d, _ in got} == {1, None}


def test_many_templates_and_repeats(spark):
    """Hundreds of templates, repeated ones and two texts under one id, through the same path."""
    rng = random.Random(6)
    made = [(f"t{k % 390}", " ".join(f"v{rng.randrange(4000)}" for _ in range(60))) for k in range(400)] * 2
    known = spark.createDataFrame(made, "template_id string, text string")
    rows = [(k, f"start here {text} and end") for k, (_, text) in enumerate(made[:400])]
    df = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string")
    found = licenses.scan(df, known)
    assert set(found.columns) == {"doc_id", "text_hash", "template_id", "word", "containment"}
    full = found.where("containment = 1").collect()
    assert {(r["doc_id"], r["template_id"]) for r in full} == {(k, name) for k, (name, _) in enumerate(made[:400])}
    assert len(full) == len({(r["doc_id"], r["template_id"], r["word"]) for r in full})
