"""Sharding by histogram sort: splitters by exact counts, then one exchange.

Rows are ordered by a hash of their text.  Candidate boundaries are refined round by
round: each round counts, across all partitions, the exact bytes below the candidates
inside the intervals that still hold a splitter, 4,096 candidates each, until the bytes
below every splitter are within the tolerance.  Rows then move once.

Equal texts stay in one shard.  A group that exceeds the tolerance is placed as a whole on
the lightest shard before the rest is cut (there are at most ``shards / tolerance`` of
them); only a group that exceeds a whole shard is cut, between documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probewatch.llm.common import offered, ranked, settle

SHARDS = 16
TOLERANCE = 0.002
_BITS, _STEP = 64, 12


def _splitters(keyed: DataFrame, targets: list[float], slack: float) -> list[int]:
    """Smallest keys (unsigned, as Python ints) with at least each target below them, up to ``slack``.

    ``keyed`` has ``hi`` (unsigned order as a signed long) and ``size``.
    """
    found: dict[int, int] = {}
    # interval of each target: prefix, its width in bits, bytes below it
    open_ = {k: (0, _BITS, 0.0) for k in range(len(targets))}
    while open_:
        bits = next(iter(open_.values()))[1]
        step = min(_STEP, bits)
        prefixes = sorted({p for p, _, _ in open_.values()})
        here = keyed
        if bits < _BITS:
            here = keyed.where(F.shiftright("hi", bits).isin([_signed(p, _BITS - bits) for p in prefixes]))
        counts = here.groupBy(F.shiftright("hi", bits - step).alias("probe")).agg(F.sum("size").alias("bytes")).collect()
        table = sorted((_unsigned(r["probe"], _BITS - bits + step), r["bytes"]) for r in counts)
        probes, sums = [p for p, _ in table], [b for _, b in table]
        following = {}
        for k, (prefix, _, below) in open_.items():
            lo, hi = prefix << step, (prefix + 1) << step
            best = (prefix << bits, below)
            inner = None
            for p, b in ((p, b) for p, b in zip(probes, sums) if lo <= p < hi):
                after = best[1] + b
                if after >= targets[k]:
                    if after - targets[k] <= slack or bits == step:
                        best = min(best, ((p + 1) << (bits - step), after), key=lambda x: abs(x[1] - targets[k]))
                    elif targets[k] - best[1] > slack:
                        inner = (p, bits - step, best[1])
                    break
                best = ((p + 1) << (bits - step), after)
            if inner:
                following[k] = inner
            else:
                found[k] = best[0]
        open_ = following
    return list(np.maximum.accumulate([found[k] for k in range(len(targets))])) if targets else []


def _unsigned(value: int, bits: int) -> int:
    """Place of a prefix of ``bits`` bits of a signed 64-bit number in signed order, from 0."""
    return value + (1 << (bits - 1)) if bits else 0


def _signed(place: int, bits: int) -> int:
    return place - (1 << (bits - 1)) if bits else 0


def _crc(texts: pd.Series) -> pd.Series:
    return pd.Series([zlib.crc32((t or "").encode("utf-8", "surrogatepass")) for t in texts], dtype="int64")


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null) of every row.

    A row's size is the UTF-8 bytes of its text (null: none) plus 1.  Shards hold nearly
    equal bytes; ``slot`` numbers a shard's rows from 0 in the order of (text hash, id).
    Null and empty texts are one group.  Repeated rows count as often as they occur, extra
    columns are ignored, an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = settle(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hi")))
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = total / shards
    slack = tolerance * share
    groups = rows.groupBy("hi").agg(F.sum("size").alias("bytes"))
    big = [(r["hi"], r["bytes"]) for r in groups.where(F.col("bytes") > F.lit(2 * slack)).orderBy(F.desc("bytes"), "hi").collect()]
    # a group beyond a whole shard is cut between its documents: its rows get keys of their own
    giant = [h for h, b in big if b > share]
    placed: dict[int, int] = {}
    load = np.zeros(shards)
    for h, b in big:
        if b <= share:
            s = int(np.argmin(load))
            placed[h] = s
            load[s] += b
    if giant:
        rows = settle(rows.withColumn("hi", F.when(F.col("hi").isin(giant), F.xxhash64("hi", "doc_id")).otherwise(F.col("hi"))))
    spark = docs.sparkSession
    where = spark.createDataFrame([(h, s) for h, s in placed.items()], "hi long, fixed int")
    loose = rows.join(offered(where, len(placed), 12), "hi", "left_anti") if placed else rows
    # what is loose fills each shard up to an equal level
    free = max(total - load.sum(), 0)
    level = _level(load, free)
    targets = list(np.cumsum(np.maximum(level - load, 0))[:-1])
    cuts = [_signed(int(c), 64) for c in _splitters(loose, targets, slack)] if total else []
    number = F.lit(0)
    for c in cuts:
        number = number + (F.col("hi") >= F.lit(c)).cast("int") if c < 1 << 63 else number
    marked = rows
    if placed:
        marked = rows.join(offered(where, len(placed), 12), "hi", "left")
        number = F.coalesce("fixed", number)
    marked = marked.select("doc_id", "size", "text_crc32", "hi", number.cast("int").alias("shard"))
    slots = ranked(marked, ["shard"], ["hi", "doc_id"], "slot", keep=shards)
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def _level(load: np.ndarray, free: float) -> float:
    """Height to which ``free`` bytes fill shards that already hold ``load``."""
    order = np.sort(load)
    for k in range(1, len(order) + 1):
        level = (order[:k].sum() + free) / k
        if k == len(order) or level <= order[k]:
            return float(level)
    return 0.0
