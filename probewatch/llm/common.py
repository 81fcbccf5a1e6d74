"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: White space between words: space and the control characters tab to carriage return.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

#: Broadcast a side only up to this many bytes; beyond it, join by shuffle.
BROADCAST_BYTES = 64 << 20


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; below the warehouse only where none is set."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints").rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to a table in the shared folder and read them again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/probewatch-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table of a settled frame that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getName().startswith("probewatch-"):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def offered(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark a side for broadcast when its counted size is within ``BROADCAST_BYTES``."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def ranked(df: DataFrame, groups: list[str], order: list[str], name: str, keep: int) -> DataFrame:
    """Number the rows of each group from 0 by ``order``, without one task per group.

    Rows are range-partitioned once over (groups, order); a row's number is its place in
    its partition plus the counts of earlier partitions.  ``keep`` bounds the number of
    groups, so the table of counts (groups + partitions rows) may be broadcast.
    """
    keys = [*groups, *order]
    placed = settle(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    spark = df.sparkSession
    if keep + int(spark.conf.get("spark.sql.shuffle.partitions")) <= 1 << 20:
        counts = F.broadcast(counts)
    names = [f"_g{k}" for k in range(len(groups))]
    counts = counts.toDF(*names, "_p", "_first", "_before")
    same = [F.col(c).eqNullSafe(F.col(g)) for c, g in zip(groups, names)] + [F.col("_part") == F.col("_p")]
    joined = placed.join(counts, same)
    return joined.select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias(name))


# ---------------------------------------------------------------- memory of Python workers

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # only glibc has it
    _trim = None


def give_back() -> None:
    """Return this process's free memory to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def tidy(run):
    """``run`` over the batches of a task, after which the Python worker gives back what it freed.

    Workers live on for later tasks; without this each stays as large as its largest task made it.
    """
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


def values(column, rows: int = 512):
    """The values of an Arrow column, of which only a few rows at a time are Python objects."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


# ---------------------------------------------------------------- words and shingles in numpy

_rng = np.random.Generator(np.random.PCG64(20240131))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser over an array; another seed gives another order of the values."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
    return x


_powers = np.ones(1, np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1 << 16) - 1, _STEP)]))
    return _powers[:n]


_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_inverses = np.ones(1, np.uint64)


def _inverses_to(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < n:
        with np.errstate(over="ignore"):
            _inverses = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1 << 16) - 1, _STEP_INVERSE)]))
    return _inverses[:n]


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z read as a-z, in order."""
    if not text:
        return np.empty(0, np.uint64)
    data = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(_IS_SPACE[data], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers_to(len(data)))])
        return mix((total[end] - total[start]) * _inverses_to(len(data))[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words.

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    words = word_hashes(text)
    n = len(words)
    if n == 0:
        return words
    size = min(n, width)
    with np.errstate(over="ignore"):
        total = np.full(n - size + 1, np.uint64(size))
        for k in range(size):
            total = total * np.uint64(0xD6E8FEB86659FD93) + words[k:n - size + 1 + k]
    return distinct(mix(total))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges``: (node, component = smallest node).

    Alternates hooking every node to the smallest neighbour of its neighbourhood (large
    star, then small star); each round is written to the shared folder.  Rounds grow with
    the logarithm of the longest chain, and a node with many links only sends them
    through minima that are combined before the shuffle.
    """
    digest = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))]
    pairs = settle(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # every row of ``large`` runs from a node to a smaller one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        pairs = settle(small.where("u <> v").distinct())
        was, state = state, pairs.agg(*digest).first()
        if was == state:
            break
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
