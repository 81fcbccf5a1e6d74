"""Ordered computations per key that never put a whole key into one task.

A key (a probed target) may own a large share of all rows, so a window over
``partitionBy(key)`` would sort that share in a single task.  Everything here
works on *slices*: fixed-width time intervals of one key.

1.  A cheap summary pass reads only key, time and state, and combines on the
    map side to one row per slice.  A window over these rows passes what a
    slice needs from its neighbours.  Its length per key is the number of
    slices in the time range and does not grow with the number of samples.
2.  The full rows are shuffled once by (key, slice), so a hot key spreads over
    as many tasks as it has slices, and are joined to their slice's summary.
    That join keeps the partitioning and order of step 2.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probewatch.schemas import SLICE_SECONDS


def slice_of(ts: Column, seconds: int = SLICE_SECONDS) -> Column:
    return F.floor(F.unix_seconds(ts) / F.lit(seconds))


def slice_seconds_for(
    df: DataFrame, keys: Sequence[str], ts: str, max_rows: int = 2_000_000,
    widest: int = 3600,
) -> int:
    """Widest slice, in seconds, whose fullest instance stays near ``max_rows``.

    One aggregation over two columns; a single row reaches the driver.  Use it
    when some key is sampled far more densely than the default width assumes.
    """
    fullest = (
        df.groupBy(*keys, slice_of(F.col(ts), widest).alias("_slice")).count()
        .agg(F.max("count")).first()[0]
    )
    width = widest
    while fullest and width > 1 and fullest * width / widest > max_rows:
        width = max(1, width // 2)
    return width


def with_previous(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, out: str,
    *, slice_seconds: int = SLICE_SECONDS, changed_only: bool = False,
) -> DataFrame:
    """Add ``out``: the value of the preceding row of the same key (``lag``).

    ``ts`` is unique per key.  With ``changed_only`` the result keeps the rows
    whose value differs from the preceding one, the first row included.
    """
    sliced = df.withColumn("_slice", slice_of(F.col(ts), slice_seconds))
    carry = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.max_by(value, ts).alias("_tail"))
        .select(
            *keys, "_slice",
            F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_carry"),
        )
    )
    w = Window.partitionBy(*keys, "_slice").orderBy(ts)
    local = sliced.withColumns({"_head": F.lag(ts).over(w).isNull(), out: F.lag(value).over(w)})
    if changed_only:
        local = local.where(F.col("_head") | ~F.col(out).eqNullSafe(F.col(value)))
    joined = local.join(carry, [*keys, "_slice"], "left").withColumn(
        out, F.when(F.col("_head"), F.col("_carry")).otherwise(F.col(out))
    )
    if changed_only:
        joined = joined.where(~F.col(out).eqNullSafe(F.col(value)))
    return joined.drop("_slice", "_head", "_carry")


def state_runs(
    df: DataFrame, keys: Sequence[str], ts: str, *,
    state: Column, wanted: Column, closes: Column,
    local: Mapping[str, Column], merged: Mapping[str, Column],
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Maximal runs of consecutive rows with one state, per key.

    ``state`` is a (nullable) column over ``df``; a change, also to or from
    NULL, ends a run.  ``wanted`` and ``closes`` are conditions over the column
    ``_state``: the runs to return, and the rows that end them.  ``run_end`` is
    the time of the first closing row after the run, NULL while there is none;
    a row that neither continues nor closes only splits the run.

    ``local`` aggregates the wanted rows of a run inside one slice, ``merged``
    aggregates these partial results over ``local`` names.  Returns ``keys``,
    ``run_start``, ``run_last``, ``run_end``, ``_state`` and the merged names.
    """
    rows = df.withColumns({"_state": state, "_slice": slice_of(F.col(ts), slice_seconds)})
    # Other rows matter by time and state only: their wide columns become NULL
    # before the shuffle.
    narrow = [*keys, ts, "_state", "_slice"]
    rows = rows.select(*narrow, *[
        F.when(wanted, F.col(c)).alias(c) for c in rows.columns if c not in narrow
    ])
    at = F.col(ts)

    # Pass 1: one narrow row per slice.
    per_key = Window.partitionBy(*keys).orderBy("_slice")
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    # Descending order: a running minimum instead of a frame that is
    # re-aggregated for every row.
    after = (
        Window.partitionBy(*keys).orderBy(F.col("_slice").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summary = (
        rows.groupBy(*keys, "_slice")
        .agg(
            F.min_by("_state", ts).alias("_first_state"),
            F.max_by("_state", ts).alias("_last_state"),
            F.max(ts).alias("_slice_last"),
            F.min(F.when(closes, at)).alias("_first_close"),
            (
                F.min("_state").eqNullSafe(F.max("_state"))
                & F.count("_state").isin(F.lit(0), F.count(F.lit(1)))
            ).alias("_uniform"),
        )
        .withColumns({
            "_before_slice": F.lag("_slice").over(per_key),
            "_before_state": F.lag("_last_state").over(per_key),
        })
    )
    # Slices whose last run began inside them.
    starts_tail = (
        ~F.col("_uniform") | F.col("_before_slice").isNull()
        | ~F.col("_first_state").eqNullSafe(F.col("_before_state"))
    )
    summary = summary.select(
        *keys, "_slice", "_slice_last", "_before_slice", "_before_state",
        F.last(F.when(starts_tail, F.col("_slice")), ignorenulls=True).over(before).alias("_origin"),
        F.min("_first_close").over(after).alias("_next_close"),
    )

    # Pass 2: runs inside each slice.  Only wanted rows and rows that open a
    # run are numbered; only wanted rows and openers of closing runs go on.
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(ts)
    numbered = (
        rows.withColumns({"_head": F.lag(ts).over(in_slice).isNull(), "_lag": F.lag("_state").over(in_slice)})
        .withColumn("_new", F.col("_head") | ~F.col("_lag").eqNullSafe(F.col("_state")))
        .where(wanted | F.col("_new"))
        .withColumn("_run", F.sum(F.col("_new").cast("int")).over(in_slice))
        .where(wanted | (closes & F.col("_new")))
    )
    later_runs = (
        Window.partitionBy(*keys, "_slice").orderBy(F.col("_run").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    pieces = (
        numbered.groupBy(*keys, "_slice", "_run", "_state")
        .agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"),
             *[c.alias(n) for n, c in local.items()])
        .withColumn("_local_close", F.min(F.when(closes, F.col("_from"))).over(later_runs))
        .where(wanted)
    )
    # A run that reaches the slice's end is named after the slice where it
    # began; all other runs are complete already.
    joined = pieces.join(summary, [*keys, "_slice"])
    continued = (
        (F.col("_run") == 1) & F.col("_before_slice").isNotNull()
        & F.col("_before_state").eqNullSafe(F.col("_state"))
    )
    at_tail = F.col("_to") == F.col("_slice_last")
    named = joined.withColumns({
        "_home": F.when(continued, F.col("_origin")).otherwise(F.col("_slice")),
        "_no": F.when(continued | at_tail, F.lit(-1)).otherwise(F.col("_run")),
        "_close": F.coalesce("_local_close", "_next_close"),
    })
    return (
        named.groupBy(*keys, "_home", "_no")
        .agg(
            F.min("_from").alias("run_start"), F.max("_to").alias("run_last"),
            F.max_by("_close", "_from").alias("run_end"), F.min("_state").alias("_state"),
            *[c.alias(n) for n, c in merged.items()],
        )
        .drop("_home", "_no")
    )
