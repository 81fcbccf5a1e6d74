"""Repair of status changes and incidents after late or amended samples.

A late sample can change only what lies between the last *closing* sample before it and
the first one after it: no incident reaches over a closing sample, and an incident's end is
the first one behind it.  Hourly KPI rows tell in which hours a target has closing samples,
so the hours to read are found without the samples: from the last such hour before a late
hour to the first one after it.  Ranges of one target that meet are merged.  The samples of
these hours give the exact edges; events between them are computed anew and replace the
stored ones there, also those that exist no longer.  Cost follows the affected hours.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probewatch.functions.scalars import is_slow
from probewatch.operators import events
from probewatch.schemas import SLOW_MS


def hours_of(samples: DataFrame) -> DataFrame:
    """Distinct (target, hour) of samples."""
    return samples.select("target_name", F.date_trunc("hour", "checked_at").alias("period_hour")).distinct()


def late_hours(new_rows: DataFrame, last: DataFrame) -> DataFrame:
    """Hours of new rows that are older than their target's newest stored sample."""
    newest = last.select("target_name", F.col("checked_at").alias("_newest"))
    return hours_of(new_rows.join(newest, "target_name").where(F.col("checked_at") < F.col("_newest")))


#: Per event table: its time column, and the hourly rows and the samples that close its incidents.
KINDS = {
    "status_events": "event_at",
    "downtime_events": "down_start",
    "latency_events": "slow_start",
}


def _closing_hours(name: str) -> Column:
    if name == "latency_events":
        return (F.col("down_probes") > 0) | (F.col("latency_ms_count") > F.col("slow_probes"))
    return F.col("up_probes") > 0


def _closes(name: str, slow_ms) -> Column:
    return ~is_slow(slow_ms) if name == "latency_events" else F.col("is_up") == 1


def affected_ranges(late: DataFrame, hourly: DataFrame, closing: Column, first_day: date | None = None) -> DataFrame:
    """(target_name, from_hour, until_hour, first_day, last_day): disjoint ranges of hours around ``late`` ones.

    A null hour leaves the range open on that side; the days are those that hold its samples.
    Ranges that reach back before ``first_day`` are left out.
    """
    marked = hourly.join(late.select("target_name").distinct(), "target_name", "left_semi").select(
        "target_name", "period_hour", closing.alias("_closing"))
    marked = marked.join(late.withColumn("_late", F.lit(True)), ["target_name", "period_hour"], "full")
    # one row per target and hour: a window's length follows the time range, not the samples
    per = Window.partitionBy("target_name")
    closing_hour = F.when(F.col("_closing"), F.col("period_hour"))
    around = marked.withColumns({
        "from_hour": F.max(closing_hour).over(per.orderBy("period_hour").rowsBetween(Window.unboundedPreceding, -1)),
        "until_hour": F.min(closing_hour).over(per.orderBy(F.col("period_hour").desc()).rowsBetween(Window.unboundedPreceding, -1)),
        "_first": F.min("period_hour").over(per), "_last": F.max("period_hour").over(per),
    }).where("_late")
    ordered = per.orderBy("period_hour")
    before = F.lag("until_hour").over(ordered)
    apart = F.lag("period_hour").over(ordered).isNull() | F.coalesce(F.col("from_hour") > before, F.lit(False))
    merged = around.withColumn("_no", F.sum(apart.cast("int")).over(ordered)).groupBy("target_name", "_no").agg(
        F.min_by("from_hour", "period_hour").alias("from_hour"), F.max_by("until_hour", "period_hour").alias("until_hour"),
        F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    ranges = merged.select(
        "target_name", "from_hour", "until_hour", F.to_date(F.coalesce("from_hour", "_first")).alias("first_day"),
        F.to_date(F.coalesce("until_hour", "_last")).alias("last_day"))
    return ranges if first_day is None else ranges.where(F.col("first_day") >= F.lit(first_day))


def _by_day(ranges: DataFrame) -> DataFrame:
    """A row for each day of a range, so that rows meet the ranges of their own day only."""
    return ranges.withColumn("_day", F.explode(F.sequence("first_day", "last_day"))).drop("first_day", "last_day")


def regions(samples: DataFrame, ranges: DataFrame, closes: Column) -> tuple[DataFrame, DataFrame]:
    """The exact regions (target_name, after, until, first_day, last_day), and the samples from edge to edge.

    A region without the closing sample that its hour promised, as its sample was removed, is left out.
    """
    at, hour = F.col("checked_at"), F.make_dt_interval(hours=F.lit(1))
    inside = samples.withColumn("_day", F.to_date(at)).join(_by_day(ranges), ["target_name", "_day"]).where(
        (F.col("from_hour").isNull() | (at >= F.col("from_hour")))
        & (F.col("until_hour").isNull() | (at < F.col("until_hour") + hour)))
    near = inside.where(closes).groupBy("target_name", "from_hour", "until_hour").agg(
        F.max(F.when(at < F.col("from_hour") + hour, at)).alias("after"), F.min(F.when(at >= F.col("until_hour"), at)).alias("until"))
    keys = [F.col("r.target_name") == F.col("n.target_name"), F.col("r.from_hour").eqNullSafe(F.col("n.from_hour"))]
    found = ranges.alias("r").join(near.alias("n"), keys, "left").select("r.*", "n.after", "n.until")
    found = found.where((F.col("from_hour").isNull() | F.col("after").isNotNull())
                        & (F.col("until_hour").isNull() | F.col("until").isNotNull()))
    exact = found.select("target_name", "after", "until", "first_day", "last_day")
    rows = samples.withColumn("_day", F.to_date(at)).join(_by_day(exact), ["target_name", "_day"]).where(
        (F.col("after").isNull() | (at >= F.col("after"))) & (F.col("until").isNull() | (at <= F.col("until"))))
    return exact, rows.drop("_day", "after", "until")


def _within(df: DataFrame, ts: str, exact: DataFrame, how: str) -> DataFrame:
    """Events behind a region's start, up to its end; ``left_semi`` or ``left_anti``."""
    at = F.col(f"e.{ts}")
    same = (F.col("e.target_name") == F.col("x.target_name")) & (F.to_date(at) == F.col("x._day"))
    same = same & (F.col("x.after").isNull() | (at > F.col("x.after"))) & (F.col("x.until").isNull() | (at <= F.col("x.until")))
    return df.alias("e").join(_by_day(exact).alias("x"), same, how)


def repair(
    name: str, stored: DataFrame, samples: DataFrame, late: DataFrame, hourly: DataFrame, *,
    slow_ms=SLOW_MS, first_day: date | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, replaced, fresh) events of one table of ``KINDS`` after samples in ``late`` hours came or changed.

    ``kept`` and ``replaced`` split the stored events, ``fresh`` are computed from
    ``samples``; kept and fresh together are the repaired table.  ``samples`` and ``hourly``
    hold the late samples already.  Regions that begin before ``first_day``, the first day of
    which all samples are kept, stay as they are.
    """
    ranges = affected_ranges(late, hourly, _closing_hours(name), first_day)
    exact, rows = regions(samples, ranges, _closes(name, slow_ms))
    if name == "status_events":
        fresh = _within(events.status_events(rows), "event_at", exact, "left_semi")
    elif name == "downtime_events":
        fresh = events.downtime_events(rows)
    else:
        fresh = events.latency_events(rows, slow_ms)
    ts = KINDS[name]
    return _within(stored, ts, exact, "left_anti"), _within(stored, ts, exact, "left_semi"), fresh


def repair_events(name: str, stored: DataFrame, samples: DataFrame, late: DataFrame, hourly: DataFrame, **how) -> DataFrame:
    """The repaired table of events."""
    kept, _, fresh = repair(name, stored, samples, late, hourly, **how)
    return kept.unionByName(fresh)


def event_changes(replaced: DataFrame, fresh: DataFrame) -> DataFrame:
    """What a repair publishes: ``added`` events, and ``removed`` ones that are gone or have another form."""
    added = fresh.exceptAll(replaced).withColumn("change", F.lit("added"))
    return added.unionByName(replaced.exceptAll(fresh).withColumn("change", F.lit("removed")))
