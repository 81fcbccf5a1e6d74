"""Rates of the character models on random strings and on identifiers and paths that training does not see."""

import random

import numpy as np
import pytest

from probewatch.llm import secrets

ORDINARY = (
    "/api/v2/customers/1234/orders org/apache/spark/sql/functions AbstractSingletonProxyFactoryBean getElementsByTagName "
    "node_modules/react-dom/index 2024-01-31T12-00-00 internationalization /usr/local/lib/python3 MAX_RETRY_COUNT_2 "
    "HttpServletRequestWrapper Geschwindigkeitsbegrenzung /wiki/Special_Search =============== 12345678901234567890 "
    "XMLHttpRequestEventTarget sha256-checksum utf8mb4_unicode_ci kubernetes-dashboard -----BEGIN aaaaaaaaaaaaaaaa "
    "com/watch/list/page/2019/10/11 2024-01-31-release-notes").split()


@pytest.fixture(scope="module")
def models(spark):
    return secrets.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_random_strings_of_every_alphabet_are_found(models):
    rng = random.Random(3)
    for letters in secrets.ALPHABETS:
        for length in (16, 18, 24, 40):
            found = [models.random("".join(rng.choices(letters, k=length))) for _ in range(300)]
            assert np.mean(found) >= 0.9, (letters, length)


def test_ordinary_words_are_left_alone(spark, models):
    assert [w for w in ORDINARY if models.random(w)] == []
    held_out = secrets.ordinary_words(1)
    assert np.mean([models.random(w) for w in held_out]) <= secrets.FALSE_ALARMS
    assert not set(secrets.VOCABULARY[0::2]) & set(secrets.VOCABULARY[1::2])
    documents = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    free = {w for t in documents for _, w in secrets._free(t, secrets.base_spans(t))}
    assert len(free) > 100 and np.mean([models.random(w) for w in free]) <= 0.01


def test_models_without_documents(spark):
    """An empty table leaves the labelled samples, which tell random strings by themselves."""
    empty = secrets.train(spark.createDataFrame([], "doc_id long, text string"))
    rng = random.Random(4)
    assert np.mean([empty.random("".join(rng.choices(secrets.ALPHABETS[6], k=24))) for _ in range(200)]) >= 0.95
    assert np.mean([empty.random(w) for w in ORDINARY]) <= 0.1


def test_planted_strings_are_reported_with_their_places(spark):
    rng = random.Random(5)
    planted = ["".join(rng.choices(secrets.ALPHABETS[6], k=20)) for _ in range(50)]
    rows = [(k, f"the key is {w} and /api/v2/customers/1234/orders is a path") for k, w in enumerate(planted)] + [(None, None), (99, "")]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[k] == "markov:11:31" for k in range(50)) >= 47
    assert {got[k] for k in range(50)} <= {"markov:11:31", ""} and got[None] == got[99] == ""
    masked = secrets.redact(spark.createDataFrame(rows[:50], "doc_id long, text string")).collect()
    assert sum(r["text"] == "the key is [SECRET] and /api/v2/customers/1234/orders is a path" for r in masked) >= 47
