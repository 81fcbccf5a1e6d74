"""Time-series operators over labelled samples, on an evaluation grid.

A *series* frame has the label columns, ``ts`` and ``value``.  A *vector* has
the label columns, ``eval_time`` and ``value``.  A range query evaluates at
``start, start + step, ...`` up to ``end``; with ``start == end`` it is an
instant query.  No operator joins samples to grid points by range: each sample
computes the grid points it covers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probewatch.functions.scalars import label_matches
from probewatch.operators.slices import slice_of, state_runs
from probewatch.schemas import GRID_STEP_SECONDS, LOOKBACK_SECONDS, SERIES_LABELS, SLICE_SECONDS

MICRO = 1_000_000
POINTS_PER_SLICE = 240


@dataclass(frozen=True)
class Grid:
    """Evaluation times; naive datetimes are UTC."""

    start: datetime
    end: datetime
    step: int = GRID_STEP_SECONDS

    @classmethod
    def instant(cls, at: datetime) -> Grid:
        return cls(at, at)

    @classmethod
    def aligned(cls, after: datetime, end: datetime, step: int = GRID_STEP_SECONDS) -> Grid:
        """Subquery grid: absolute multiples of ``step`` in ``(after, end]``."""
        lo, hi = _micros(after) // (step * MICRO) + 1, _micros(end) // (step * MICRO)
        return cls(_datetime(lo * step * MICRO), _datetime(hi * step * MICRO), step)

    @property
    def points(self) -> int:
        return (_micros(self.end) - _micros(self.start)) // (self.step * MICRO) + 1

    @property
    def origin(self) -> int:
        return _micros(self.start)


def _micros(t: datetime) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    delta = t - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * MICRO + delta.microseconds


def _datetime(micros: int) -> datetime:
    return datetime.fromtimestamp(micros // MICRO, timezone.utc).replace(microsecond=micros % MICRO)


def at_micros(micros: int) -> Column:
    """A timestamp literal that does not depend on the session zone."""
    return F.timestamp_micros(F.lit(micros).cast("long"))


def at(t: datetime) -> Column:
    return at_micros(_micros(t))


def _ceil_div(a: Column, b: int) -> Column:
    """Exact integer ceiling, also for negative numbers."""
    return ((a + F.pmod(-a, F.lit(b))) / F.lit(b)).cast("long")


def eval_time(k: Column, grid: Grid) -> Column:
    return F.timestamp_micros(F.lit(grid.origin).cast("long") + k * F.lit(grid.step * MICRO).cast("long"))


def eval_grid(spark, grid: Grid) -> DataFrame:
    return spark.range(grid.points).select(eval_time(F.col("id"), grid).alias("eval_time"))


def series(samples: DataFrame, value: Column) -> DataFrame:
    """Flat probe samples to a series; absent labels are empty strings."""
    labels = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in SERIES_LABELS]
    return samples.select(*labels, F.col("checked_at").alias("ts"), value.alias("value")).where(
        F.col("value").isNotNull()
    )


def success_series(samples: DataFrame) -> DataFrame:
    return series(samples, F.col("is_up").cast("double"))


def duration_series(samples: DataFrame) -> DataFrame:
    """Probe duration in seconds."""
    return series(samples, F.col("latency_ms").cast("double") / 1000)


def select_labels(df: DataFrame, **patterns: str) -> DataFrame:
    """Keep rows whose labels match the fully anchored patterns; ``.*`` is all."""
    for name, pattern in patterns.items():
        df = df.where(label_matches(F.col(name), pattern))
    return df


def label_values(df: DataFrame, name: str, **patterns: str) -> DataFrame:
    """Sorted distinct values of a label, chained by other filters."""
    found = select_labels(df, **patterns).select(F.coalesce(name, F.lit("")).alias(name))
    return found.where(F.col(name) != "").distinct().orderBy(name)


def _between(df: DataFrame, after: int, until: int) -> DataFrame:
    return df.where((F.col("ts") > at_micros(after)) & (F.col("ts") <= at_micros(until)))


def instant_vector(
    df: DataFrame, grid: Grid, *, labels: Sequence[str] = SERIES_LABELS,
    lookback: int = LOOKBACK_SECONDS, points_per_slice: int = POINTS_PER_SLICE,
) -> DataFrame:
    """The newest sample at or before each evaluation time, within the lookback.

    Samples are first reduced to the newest one per series and grid interval,
    on the map side already.  Such a sample stays valid on later grid points
    until the next interval that has one.  That interval matters only within
    the lookback, so a slice of grid points borrows the first intervals of the
    following slice as a halo, and its size never depends on the sample rate.
    """
    labels = list(labels)
    step = grid.step * MICRO
    last = grid.origin + (grid.points - 1) * step
    df = _between(df, grid.origin - lookback * MICRO, last)
    if grid.points == 1:
        return df.groupBy(*labels).agg(F.max_by("value", "ts").alias("value")).select(
            *labels, eval_time(F.lit(0), grid).alias("eval_time"), "value"
        )
    newest = (
        df.groupBy(*labels, _ceil_div(F.unix_micros("ts") - grid.origin, step).alias("_k"))
        .agg(F.unix_micros(F.max("ts")).alias("_at"), F.max_by("value", "ts").alias("value"))
    )
    reach = -(-lookback // grid.step)
    width = max(points_per_slice, 4 * reach)
    own = F.floor(F.col("_k") / width)
    spread = newest.withColumn("_own", own).withColumn("_slice", F.explode(
        F.when(F.col("_k") - own * width < reach, F.array(own, own - 1)).otherwise(F.array(own))))
    following = F.lead("_k").over(Window.partitionBy(*labels, "_slice").orderBy("_k"))
    valid = (
        spread.withColumn("_next", following).where(F.col("_slice") == F.col("_own"))
        .withColumn("_k0", F.greatest("_k", F.lit(0)))
        .withColumn("_k1", F.least(
            F.col("_next") - 1, _ceil_div(F.col("_at") + lookback * MICRO - grid.origin, step) - 1,
            F.lit(grid.points - 1)))
        .where(F.col("_k0") <= F.col("_k1"))
    )
    return valid.select(*labels, "value", F.explode(F.sequence("_k0", "_k1")).alias("_k")).select(
        *labels, eval_time(F.col("_k"), grid).alias("eval_time"), "value"
    )


_PARTS = {
    "min": ({"a": lambda v: F.min(v)}, lambda: F.min("a")),
    "max": ({"a": lambda v: F.max(v)}, lambda: F.max("a")),
    "sum": ({"a": lambda v: F.sum(v)}, lambda: F.sum("a")),
    "count": ({"a": lambda v: F.count(v)}, lambda: F.sum("a").cast("double")),
    "avg": ({"a": lambda v: F.sum(v), "b": lambda v: F.count(v)}, lambda: F.sum("a") / F.sum("b")),
}


#: Windows of more steps than this do not repeat panes.
REPEATED = 4


def _spread(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """A row for each grid point ``_k`` from ``first`` to ``last``."""
    bounded = df.withColumn("_k0", first).withColumn("_k1", last).where(F.col("_k0") <= F.col("_k1"))
    return bounded.withColumn("_k", F.explode(F.sequence("_k0", "_k1")))


def _two_pieces(panes: DataFrame, fn: str, labels: list[str], width: int, per_step: int, grid: Grid) -> DataFrame:
    """At most two partial results (a[, b]) for each series and grid point ``_k``, however long the window.

    Panes are cut into blocks as long as the window (``width`` panes).  A window ends in one
    block and begins in the one before, so its result is that of a block's panes up to the
    window's end and of the panes of the block before from the window's start on.  Both are
    running aggregates over one block, whose length does not follow the time range; a pane's
    running values serve the grid points up to the next pane that exists.
    """
    merge = F.min if fn == "min" else F.max if fn == "max" else F.sum
    parts = [c for c in ("a", "b") if c in panes.columns]
    p = F.col("_p")
    block = (p - F.pmod(p, F.lit(width))).cast("long")  # its first pane
    up = Window.partitionBy(*labels, "_block").orderBy("_p")
    down = Window.partitionBy(*labels, "_block").orderBy(F.col("_p").desc())
    running = panes.withColumn("_block", block).withColumns({
        **{f"_up_{c}": merge(c).over(up.rowsBetween(Window.unboundedPreceding, 0)) for c in parts},
        **{f"_down_{c}": merge(c).over(down.rowsBetween(Window.unboundedPreceding, 0)) for c in parts},
        "_next": F.lead("_p").over(up), "_before": F.lag("_p").over(up)})
    begin, last = F.col("_block"), F.lit(grid.points - 1)
    # first and last pane that a grid point's window may end with
    own = (p, F.least(F.coalesce(F.col("_next"), begin + width) - 1, begin + width - 1))
    following = (F.greatest(F.coalesce(F.col("_before"), begin - 1) + width, begin + width), p + width - 1)
    side = lambda name, ends: F.struct(
        F.greatest(_ceil_div(ends[0], per_step), F.lit(0)).alias("k0"), F.least(F.floor(ends[1] / per_step), last).alias("k1"),
        *[F.col(f"_{name}_{c}").alias(c) for c in parts])
    pieces = running.select(*labels, F.explode(F.array(side("up", own), side("down", following))).alias("e"))
    pieces = pieces.select(*labels, *[F.col(f"e.{c}").alias(c) for c in parts], F.col("e.k0").alias("_from"), F.col("e.k1").alias("_to"))
    return _spread(pieces, F.col("_from"), F.col("_to"))


def over_time(
    df: DataFrame, fn: str, window: int, grid: Grid, *, labels: Sequence[str] = SERIES_LABELS,
) -> DataFrame:
    """``min/max/sum/count/avg`` over the left-open range ``(t - window, t]``.

    Samples are first reduced to panes of ``gcd(window, step)`` seconds.  Windows of up to
    ``REPEATED`` steps repeat panes; longer ones are put together from two pieces each.
    """
    labels = list(labels)
    parts, final = _PARTS[fn]
    pane = gcd(window, grid.step)
    per_step, per_window = grid.step // pane, window // pane
    last = grid.origin + (grid.points - 1) * grid.step * MICRO
    df = _between(df, grid.origin - window * MICRO, last)
    paned = df.withColumn("_p", _ceil_div(F.unix_micros("ts") - grid.origin, pane * MICRO))
    partial = paned.groupBy(*labels, "_p").agg(*[f("value").alias(n) for n, f in parts.items()])
    if per_step == per_window == 1:
        covered = partial.withColumn("_k", F.col("_p")).where(F.col("_k").between(0, grid.points - 1))
    elif per_window > REPEATED * per_step:
        covered = _two_pieces(partial, fn, labels, per_window, per_step, grid)
    else:
        k0 = F.greatest(_ceil_div(F.col("_p"), per_step), F.lit(0))
        k1 = F.least(_ceil_div(F.col("_p") + per_window, per_step) - 1, F.lit(grid.points - 1))
        covered = _spread(partial, k0, k1)
    return covered.groupBy(*labels, "_k").agg(final().alias("value")).select(
        *labels, eval_time(F.col("_k"), grid).alias("eval_time"), "value"
    )


def subquery(vector: DataFrame, fn: str, at: Column, *, labels: Sequence[str] = SERIES_LABELS) -> DataFrame:
    """Outer range function of ``fn((expr)[range:step])``; ``vector`` is on the inner grid."""
    value = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max}[fn]("value")
    return vector.groupBy(*labels).agg(value.alias("value")).select(
        *labels, at.alias("eval_time"), "value"
    )


def subquery_over_time(
    vector: DataFrame, fn: str, window: int, grid: Grid, *, labels: Sequence[str] = SERIES_LABELS,
) -> DataFrame:
    """``fn((expr)[window:step])`` on a grid of its own: ``vector`` is on the inner grid, ``grid`` the outer one.

    The inner results are computed once and shared by all outer windows that hold them.
    """
    return over_time(vector.withColumnRenamed("eval_time", "ts"), fn, window, grid, labels=labels)


def changes(
    df: DataFrame, after: datetime, end: datetime, *, labels: Sequence[str] = SERIES_LABELS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Number of value changes inside ``(after, end]`` per series.

    Changes inside a slice are counted there; each slice then adds the change
    between the last value of the slice before and its own first value.
    """
    labels = list(labels)
    inside = _between(df, _micros(after), _micros(end)).withColumn("_slice", slice_of(F.col("ts"), slice_seconds))
    w = Window.partitionBy(*labels, "_slice").orderBy("ts")
    before = F.lag("value").over(w)
    per_slice = (
        inside.withColumn("_changed", (before.isNotNull() & (before != F.col("value"))).cast("long"))
        .groupBy(*labels, "_slice")
        .agg(F.sum("_changed").alias("n"), F.min_by("value", "ts").alias("v0"),
             F.max_by("value", "ts").alias("v1"))
    )
    edge = F.lag("v1").over(Window.partitionBy(*labels).orderBy("_slice"))
    return (
        per_slice.withColumn("n", F.col("n") + (edge.isNotNull() & (edge != F.col("v0"))).cast("long"))
        .groupBy(*labels).agg(F.sum("n").cast("double").alias("value"))
        .select(*labels, at(end).alias("eval_time"), "value")
    )


def absent_over_time(df: DataFrame, window: int, grid: Grid) -> DataFrame:
    """Value 1 at each evaluation time whose range holds no sample of any series."""
    pane = gcd(window, grid.step)
    per_step, per_window = grid.step // pane, window // pane
    last = grid.origin + (grid.points - 1) * grid.step * MICRO
    panes = (
        _between(df, grid.origin - window * MICRO, last)
        .select(_ceil_div(F.unix_micros("ts") - grid.origin, pane * MICRO).alias("_p")).distinct()
    )
    k0 = F.greatest(_ceil_div(F.col("_p"), per_step), F.lit(0))
    k1 = F.least(_ceil_div(F.col("_p") + per_window, per_step) - 1, F.lit(grid.points - 1))
    covered = (
        panes.withColumn("_k0", k0).withColumn("_k1", k1).where(F.col("_k0") <= F.col("_k1"))
        .select(F.explode(F.sequence("_k0", "_k1")).alias("_k")).distinct()
        .select(eval_time(F.col("_k"), grid).alias("eval_time"))
    )
    return eval_grid(df.sparkSession, grid).join(covered, "eval_time", "left_anti").withColumn(
        "value", F.lit(1.0)
    )


_COMPARE = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
}


def compare(vector: DataFrame, op: str, scalar: float, *, as_bool: bool = False) -> DataFrame:
    """Comparison with a scalar: keeps matching elements, or yields 0/1 for all."""
    hit = _COMPARE[op](F.col("value"), F.lit(float(scalar)))
    return vector.withColumn("value", hit.cast("double")) if as_bool else vector.where(hit)


def scale(vector: DataFrame, factor: float) -> DataFrame:
    return vector.withColumn("value", F.col("value") * F.lit(factor))


def seconds_since(vector: DataFrame) -> DataFrame:
    """``time() - x`` where the values are epoch seconds."""
    return vector.withColumn("value", F.unix_micros("eval_time") / MICRO - F.col("value"))


def vector_and(left: DataFrame, right: DataFrame, labels: Sequence[str] = SERIES_LABELS) -> DataFrame:
    """Left elements that have a right element with the same labels and time."""
    on = [*labels, "eval_time"]
    return left.join(right.select(*on), on, "left_semi")


def aggregate(vector: DataFrame, fn: str, by: Sequence[str] = ()) -> DataFrame:
    """``count/sum/avg/min/max [by (labels)]``; no row when there is no input."""
    value = {"count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[fn]("value")
    return vector.groupBy("eval_time", *by).agg(value.cast("double").alias("value")).select(
        *by, "eval_time", "value"
    )


def merge_equal(
    vector: DataFrame, *, labels: Sequence[str] = SERIES_LABELS, slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Neighbouring equal values of a series merged to intervals."""
    runs = state_runs(
        vector, list(labels), "eval_time", state=F.col("value"),
        wanted=F.lit(True), closes=F.lit(True), slice_seconds=slice_seconds,
        local={"n": F.count(F.lit(1))}, merged={"points": F.sum("n")},
    )
    return runs.select(
        *labels, F.col("_state").alias("value"), F.col("run_start").alias("from_time"),
        F.col("run_last").alias("last_time"), F.col("run_end").alias("until_time"), "points",
    )
