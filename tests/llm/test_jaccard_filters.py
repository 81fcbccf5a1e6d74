"""The filters of the n-gram Jaccard join on sets in memory."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from probewatch.llm import jaccard
from probewatch.llm.common import distinct, mix

WORDS = [f"w{i}" for i in range(400)]


def tables(texts, of):
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    return pa.Table.from_batches(list(of([batch])))


def asked(judge, rows):
    """What the judge says of the first row as centre and all others as members."""
    members = rows.slice(1).rename_columns(["b", "n", "tokens"])
    return judge(members, rows.slice(0, 1)).to_pylist()


@pytest.fixture(scope="module")
def table():
    """The first 300 words are heavy."""
    heavy = np.sort(np.concatenate([jaccard.shingle_set(w, 1) for w in WORDS[:300]]))
    return SimpleNamespace(value=(heavy, np.arange(len(heavy)) + 20))


def test_further_orders_lose_no_link(table):
    rng = np.random.default_rng(4)
    texts = [" ".join(WORDS[:200])]
    for k in range(150):
        own = [w for w in WORDS[:200] if rng.random() < 1 - k / 400]
        texts.append(" ".join([*own, *(f"x{k}_{i}" for i in range(rng.integers(0, 40)))]))
    whole = asked(jaccard._verify(75, table), tables(texts, jaccard._sets(1)))
    likely = asked(jaccard._intersect(75), tables(texts, jaccard._sketches(1, 75, table)))
    links, kept = ({x["b"] for x in rows} for rows in (whole, likely))
    near = {jaccard.set_key(jaccard.shingle_set(t, 1)) for t in texts[1:]
            if 100 * len(set(texts[0].split()) & set(t.split())) >= 75 * len(set(texts[0].split()) | set(t.split()))}
    assert links == near and links <= kept and 0 < len(links) < len(kept) < 150


def test_a_set_stands_for_those_whose_heavy_part_it_holds(table):
    origin = WORDS[:100]
    texts = [" ".join(origin),
             " ".join([*origin[5:], *(f"a{i}" for i in range(5))]),   # no larger set holds more: left to the origin
             " ".join([*origin[5:], *(f"b{i}" for i in range(2))]),   # smaller than the origin: stays
             " ".join([*origin[5:], *WORDS[200:205]])]                # a heavy part of its own: stays
    key = [jaccard.set_key(jaccard.shingle_set(t, 1)) for t in texts]
    got = {x["b"]: x["low"] for x in asked(jaccard._verify(75, table), tables(texts, jaccard._sets(1)))}
    assert got == {key[1]: key[1], key[2]: None, key[3]: None}
    assert len(distinct(mix(np.array(key, np.int64).view(np.uint64)))) == 4
