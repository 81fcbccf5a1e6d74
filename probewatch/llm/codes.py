"""Vector code compression: each vector becomes the indexes of the nearest codebook entries of its parts.

Codebooks are refined by Lloyd's rounds that keep, for every part, its entry and the exact
distance to it.  When entries move, a part whose own entry stayed compares only the moved
entries with its stored distance; a part whose entry moved scans the whole codebook.  All
numbers are integers, so distances are exact and ties go to the lower index in both cases.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probewatch.llm.common import discard, offered, settle

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components below this size have squared distances that 64 bits hold; larger ones are computed without a bound.
NARROW = 1 << 26
#: Integers of this size or more are no component: sums of their squares could exceed 38 digits.
LIMIT = float(1 << 48)

STATE = "vec_id long, label {label}, ints array<long>, codes array<int>, distances array<decimal(38,0)>"


def valid(column: str):
    """Whether a vector is there, and each component finite and below the limit."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < LIMIT)
    return F.col(column).isNotNull() & F.forall(F.col(column), lambda x: finite(x.cast("double")))


def _parts(ints: list, width: int) -> np.ndarray:
    """(row, part, component); integers without a bound where 64 bits would not do."""
    values = np.asarray(ints, np.int64).reshape(-1, PARTS, width)
    return values.astype(object) if values.size and max(values.max(), -values.min()) >= NARROW else values


def _wide(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as exact numbers of one kind."""
    if parts.dtype == books.dtype:
        return parts, books
    return parts.astype(object), books.astype(object)


def _squares(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(row, entry) squared distances, a component at a time."""
    total = 0
    for k in range(part.shape[1]):
        apart = part[:, k, None] - entries[None, :, k]
        total = total + apart * apart
    return total


def nearest(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each part's nearest entry, by full scans."""
    parts, books = _wide(parts, books)
    codes = np.empty(parts.shape[:2], np.int32)
    distances = np.empty(parts.shape[:2], parts.dtype)
    for p in range(parts.shape[1]):
        squares = _squares(parts[:, p], books[p])
        codes[:, p] = squares.argmin(1)
        distances[:, p] = squares[np.arange(len(squares)), codes[:, p]]
    return codes, distances


def renew(parts: np.ndarray, books: np.ndarray, moved: np.ndarray, codes: np.ndarray, distances: np.ndarray) -> None:
    """Bring codes and distances up to date after the entries marked ``moved`` (part, entry) changed."""
    parts, books = _wide(parts, books)
    for p in range(parts.shape[1]):
        active = np.flatnonzero(moved[p])
        if not len(active):
            continue
        gone = moved[p][codes[:, p]]
        scan, keep = np.flatnonzero(gone), np.flatnonzero(~gone)
        if len(scan):
            squares = _squares(parts[scan, p], books[p])
            codes[scan, p] = best = squares.argmin(1)
            distances[scan, p] = squares[np.arange(len(scan)), best]
        if len(keep):
            squares = _squares(parts[keep, p], books[p][active])
            at = squares.argmin(1)
            found, index = squares[np.arange(len(keep)), at], active[at]
            near, code = distances[keep, p], codes[keep, p]
            better = (found < near) | ((found == near) & (index < code))
            codes[keep[better], p] = index[better]
            distances[keep[better], p] = found[better]


def _rows(batch, width):
    return _parts(batch.column("ints").flatten().to_numpy(zero_copy_only=False), width)


def _matrix(column, dtype):
    flat = column.flatten()
    values = flat.cast(pa.int64()).to_numpy() if dtype != object else np.array([int(x) for x in flat.to_pylist()], object)
    return values.reshape(-1, PARTS).copy()


def _state(batch, codes, distances):
    offsets = pa.array(np.arange(0, codes.size + 1, PARTS, dtype=np.int32))
    if distances.dtype == object:
        flat = pa.array([int(x) for x in distances.ravel()], pa.decimal128(38, 0))
    else:
        flat = pa.array(distances.ravel()).cast(pa.decimal128(38, 0))
    columns = [batch.column("vec_id"), batch.column("label"), batch.column("ints"),
               pa.ListArray.from_arrays(offsets, pa.array(codes.ravel(), pa.int32())), pa.ListArray.from_arrays(offsets, flat)]
    return pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "ints", "codes", "distances"])


def _first(table, width):
    def run(batches):
        books, _ = table.value
        for batch in batches:
            if batch.num_rows:
                yield _state(batch, *nearest(_rows(batch, width), books))
    return run


def _again(table, width):
    def run(batches):
        books, moved = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _rows(batch, width)
            narrow = parts.dtype != object and books.dtype != object
            codes = _matrix(batch.column("codes"), np.int64).astype(np.int32)
            distances = _matrix(batch.column("distances"), np.int64 if narrow else object)
            renew(parts, books, moved, codes, distances)
            yield _state(batch, codes, distances)
    return run


def _sums(width):
    """Component sums and counts of each part's entries, one row for each entry and batch."""
    def run(batches):
        for batch in batches:
            parts = _rows(batch, width)
            codes = _matrix(batch.column("codes"), np.int64)
            rows = {"part": [], "entry": [], "count": [], "place": [], "total": []}
            for p in range(PARTS if len(codes) else 0):
                used, at, count = np.unique(codes[:, p], return_inverse=True, return_counts=True)
                for k in range(width):
                    total = np.zeros(len(used), object)
                    if parts.dtype == object:
                        np.add.at(total, at, parts[:, p, k])
                    else:
                        narrow = np.zeros(len(used), np.int64)
                        np.add.at(narrow, at, parts[:, p, k])
                        total = narrow
                    rows["part"] += [p] * len(used)
                    rows["entry"] += used.tolist()
                    rows["count"] += count.tolist()
                    rows["place"] += [k] * len(used)
                    rows["total"] += [int(x) for x in total]
            yield pa.RecordBatch.from_arrays([
                pa.array(rows["part"], pa.int32()), pa.array(rows["entry"], pa.int32()), pa.array(rows["count"], pa.int64()),
                pa.array(rows["place"], pa.int32()), pa.array(rows["total"], pa.decimal128(38, 0))],
                ["part", "entry", "count", "place", "total"])
    return run


def _moved(state: DataFrame, books: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The entries as the floored means of their parts, and which of them changed; unused ones stay.

    At most parts x entries x width rows reach the driver.
    """
    sums = state.select("ints", "codes").mapInArrow(_sums(width), "part int, entry int, count long, place int, total decimal(38,0)")
    fresh = books.astype(object)
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("count").alias("n"), F.sum("total").alias("total")).collect():
        fresh[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    moved = (fresh != books.astype(object)).any(2)
    return _narrowed(fresh), moved


def _narrowed(books: np.ndarray) -> np.ndarray:
    small = not books.size or max(abs(int(x)) for x in books.ravel()) < NARROW
    return books.astype(np.int64) if small else books.astype(object)


def compress(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Every kept vector's ``codes`` and squared ``distances`` by part, and the final codebooks (part, entry, place).

    Vectors that are null, or hold null, non-finite or (256 x) over-long components, are
    dropped (over-long: 2**40 or more in size).  Vectors are as long as that of the smallest id; others are dropped, and a
    length that 16 does not divide is filled up with zeros.  Repeated ids are ordered by
    their components, and repeated rows count as often as they occur.  Extra columns are
    ignored; without a kept vector the result is empty and so are the codebooks.
    """
    spark = vectors.sparkSession
    label = dict(vectors.dtypes).get("label", "int")
    floors = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    kept = vectors.where(valid("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", floors.alias("ints"))
    schema = STATE.format(label=label)
    head = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("ints").limit(1).collect()
    if not head:
        return spark.createDataFrame([], schema), np.zeros((PARTS, 0, 0), np.int64)
    length = len(head[0]["ints"])
    width = max(1, -(-length // PARTS))
    kept = kept.where(F.size("ints") == length)
    if width * PARTS > length:
        kept = kept.withColumn("ints", F.concat("ints", F.array_repeat(F.lit(0).cast("long"), width * PARTS - length)))
    first = [r["ints"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("ints").limit(ENTRIES).collect()]
    books = _narrowed(np.array(first, object).reshape(-1, PARTS, width).transpose(1, 0, 2))
    schema = STATE.format(label=label)
    state = settle(kept.mapInArrow(_first(spark.sparkContext.broadcast((books, None)), width), schema))
    for _ in range(ROUNDS):
        books, moved = _moved(state, books, width)
        before, state = state, settle(state.mapInArrow(_again(spark.sparkContext.broadcast((books, moved)), width), schema))
        discard(before)
    return state, books


def codes(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept vector.

    ``code`` has two hex digits a part.  Errors beyond a long are null.
    """
    state, books = compress(vectors)
    text = ",".join(str(int(x)) for x in books.ravel())
    digest = hashlib.sha256(text.encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0"))), "")
    error = F.aggregate("distances", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)"))
    rows = state.select("vec_id", "label", code.alias("code"), error.alias("wide"))
    sums = rows.groupBy("label").agg(F.sum("wide").alias("label_wide"))
    n = sums.count()
    sums = offered(sums.withColumnRenamed("label", "same"), n, 64)
    long = lambda c: F.col(c).try_cast("long")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", long("wide").alias("error"), long("label_wide").alias("label_error"),
        F.lit(digest).alias("codebooks_sha256"))
