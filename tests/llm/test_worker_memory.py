"""Python workers live on for later tasks: what a task took is given back when it ends."""

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from probewatch.llm import jaccard
from probewatch.llm.common import shingle_set

REPO = Path(__file__).resolve().parents[2]

RUN = """
import re
import numpy as np
import pyarrow as pa
from probewatch.llm import jaccard

def held():
    with open("/proc/self/smaps_rollup") as lines:
        return int(re.search(r"Pss_Anon:\\s+(\\d+)", lines.read())[1]) / 1024

def batches(seed):
    rng = np.random.default_rng(seed)
    texts = [" ".join(map(str, rng.integers(0, 1 << 20, 400))) for _ in range(5000)]
    yield pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])

run = jaccard._scan(5)
for _ in batches(0):  # what making the texts takes
    pass
before = held()
for seed in range(3):
    for _ in run(batches(seed)):
        pass
print(held() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory can't be read here")
def test_tasks_leave_their_worker_small():
    env = os.environ | {"PYTHONPATH": str(REPO), "OMP_NUM_THREADS": "1"}
    out = subprocess.run([sys.executable, "-c", RUN], env=env, capture_output=True, text=True, check=True, timeout=120)
    assert float(out.stdout) < 20


def test_tokens_seen_often_are_counted_exactly():
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 4, 40))) for _ in range(200)] + ["", None, "one two"]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    rows = pa.Table.from_batches(list(jaccard._scan(5)(iter([batch])))).to_pylist()
    expected, seen = Counter(), set()
    for text in texts:
        tokens = shingle_set(text)
        if len(tokens) and jaccard.set_key(tokens) not in seen:
            seen.add(jaccard.set_key(tokens))
            expected.update(tokens.view(np.int64).tolist())
    assert {r["key"]: r["n"] for r in rows if r["kind"] == 1} == {t: c for t, c in expected.items() if c >= jaccard.HEAVY_IN_TASK}
    assert [r["n"] for r in rows if r["kind"] == 0] == [len(shingle_set(t)) for t in texts]
