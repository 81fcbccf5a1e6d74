"""Management reports over stored daily KPI rows and incidents."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probewatch.functions.scalars import availability_pct, label_matches, seconds_between
from probewatch.operators.kpi import kpi_raw, minute_samples, ratio_of_sums
from probewatch.operators.series import at
from probewatch.schemas import HOURLY_RETENTION_DAYS, RAW_RETENTION_DAYS


def report_filter(df: DataFrame, **patterns: str) -> DataFrame:
    """Filter by environment, db_type, target_name, criticality or team."""
    for name, pattern in patterns.items():
        df = df.where(label_matches(F.col(name), pattern))
    return df


def report_period(daily: DataFrame, unit: str, by: Sequence[str] = ()) -> DataFrame:
    """Availability per day, week or month, optionally broken down by labels."""
    period = F.date_trunc(unit, F.col("period_start")).alias("period_start")
    return daily.groupBy(period, *by).agg(*ratio_of_sums())


def breakdown(daily: DataFrame, by: Sequence[str]) -> DataFrame:
    return daily.groupBy(*by).agg(*ratio_of_sums())


def sla_compliance(daily: DataFrame, sla_pct: float, by: Sequence[str] = ("target_name",)) -> DataFrame:
    """Pass or fail against a threshold in percent; NULL without probes."""
    threshold = F.lit(str(sla_pct)).cast("decimal(7,4)")
    return breakdown(daily, by).select(
        *by, "probes", "up_probes", "availability_pct", threshold.alias("sla_pct"),
        (F.col("availability_pct") >= threshold).alias("sla_met"),
    )


def error_budget(daily: DataFrame, sla_pct: float, by: Sequence[str] = ("target_name",)) -> DataFrame:
    """Allowed, used and remaining DOWN probes under the threshold."""
    share = F.lit(1).cast("decimal(9,6)") - F.lit(str(sla_pct)).cast("decimal(9,4)") / F.lit(100)
    budget = F.round(F.col("probes").cast("decimal(20,0)") * share, 4)
    used = F.col("down_probes").cast("decimal(20,0)")
    return breakdown(daily, by).select(
        *by, "probes", "down_probes", budget.alias("budget_probes"),
        (budget - used).alias("remaining_probes"),
        F.round(used * 100 / F.nullif(budget, F.lit(0).cast("decimal(20,4)")), 2).alias("burn_pct"),
    )


def year_over_year(daily: DataFrame, by: Sequence[str] = ("target_name",)) -> DataFrame:
    """Each month next to the same month one year earlier; NULL without history."""
    monthly = report_period(daily, "month", by)
    prior = monthly.select(
        *by, F.add_months("period_start", 12).cast("timestamp").alias("period_start"),
        F.col("availability_pct").alias("previous_availability_pct"),
        F.col("avg_latency_ms").alias("previous_avg_latency_ms"),
    )
    return monthly.join(prior, [*by, "period_start"], "left").select(
        *by, "period_start", "availability_pct", "previous_availability_pct",
        (F.col("availability_pct") - F.col("previous_availability_pct")).alias("availability_change"),
        "avg_latency_ms", "previous_avg_latency_ms",
    )


def history_coverage(daily: DataFrame, start: Column, end: Column, targets: DataFrame | None = None) -> DataFrame:
    """Days with data against days expected in ``[start, end]``, per target.

    With the inventory ``targets`` a target without any day is listed with 0 %.
    """
    expected = F.datediff(end, start) + 1
    inside = daily.where(F.col("period_start").between(start, end))
    found = inside.groupBy("target_name").agg(
        F.count(F.lit(1)).alias("days_present"),
        F.min("period_start").alias("first_day"), F.max("period_start").alias("last_day"),
    )
    if targets is not None:
        found = targets.select("target_name").distinct().join(found, "target_name", "full")
    present = F.coalesce("days_present", F.lit(0))
    return found.select(
        "target_name", present.cast("long").alias("days_present"), expected.cast("long").alias("days_expected"),
        availability_pct(present, expected).alias("coverage_pct"),
        "first_day", "last_day",
    )


def incident_report(downtime: DataFrame, start: Column, end: Column) -> DataFrame:
    """Downtime incidents that touch ``[start, end)``, clipped to it."""
    finish = F.least(F.coalesce("down_end", end), end)
    begin = F.greatest("down_start", start)
    touching = (F.col("down_start") < end) & (F.col("down_end").isNull() | (F.col("down_end") > start))
    return downtime.where(touching).select(
        "target_name", "environment", "db_type", "criticality", "team",
        begin.alias("clipped_start"), finish.alias("clipped_end"),
        F.round(seconds_between(finish, begin), 2).alias("downtime_seconds"),
        F.col("down_end").isNull().alias("is_open"), "down_samples", "last_error_text",
    )


def kpi_drift(samples: DataFrame, stored_daily: DataFrame) -> DataFrame:
    """Differences between stored daily KPI rows and those recomputed from raw samples.

    Compared are the days that the raw tier holds in full: the day of its first sample may
    have lost samples to retention, and older days are stored without raw samples.
    """
    parts = ["probes", "up_probes", "down_probes", "slow_probes", "latency_ms_count", "latency_ms_sum", "max_latency_ms"]
    keys = ["period_start", "target_name"]
    first = samples.agg(F.to_date(F.min("checked_at")).alias("_first"))  # one row

    def inside(rows):
        return rows.join(F.broadcast(first), F.col("period_start") > F.col("_first")).drop("_first")

    fresh = inside(kpi_raw(samples, "day")).select(*keys, *[F.col(c).alias(f"raw_{c}") for c in parts])
    kept = inside(stored_daily).select(*keys, *[F.col(c).alias(f"kpi_{c}") for c in parts])
    both = fresh.join(kept, keys, "full_outer")

    def diff(c):
        return F.coalesce(f"raw_{c}", F.lit(0)) - F.coalesce(f"kpi_{c}", F.lit(0))

    wrong = F.lit(False)
    for c in parts:
        wrong = wrong | (diff(c) != 0)
    return both.select(
        *keys, F.col("raw_probes").isNull().alias("missing_raw"),
        F.col("kpi_probes").isNull().alias("missing_kpi"),
        *[diff(c).alias(f"{c}_drift") for c in parts], wrong.alias("has_drift"),
    )


def year_to_date(daily: DataFrame, as_of: Column, by: Sequence[str] = ("target_name",)) -> DataFrame:
    first = F.date_trunc("year", as_of).cast("date")
    return breakdown(daily.where(F.col("period_start").between(first, as_of.cast("date"))), by)


def choose_tier(unit: str, start: datetime, as_of: datetime) -> str:
    """Coarsest stored tier that answers a grain; ValueError when it is gone.

    Minute needs raw samples, hour needs hourly rows, everything longer uses
    the daily rows.
    """
    tier, days = {
        "minute": ("raw", RAW_RETENTION_DAYS), "hour": ("hourly", HOURLY_RETENTION_DAYS),
    }.get(unit, ("daily", None))
    if days is not None and start < as_of - timedelta(days=days):
        raise ValueError(f"{unit} grain before the {tier} tier's {days} days is not stored")
    return tier


def tiered_report(
    samples: DataFrame, hourly: DataFrame, daily: DataFrame, *,
    unit: str, start: datetime, end: datetime, as_of: datetime, weight: str = "samples",
) -> DataFrame:
    """Availability per target and period of ``[start, end)`` from the chosen tier.

    ``weight`` names what the stored hourly and daily rows count, ``samples`` or (after a
    normalisation) ``minutes``; the raw tier is counted alike, so the numbers do not depend
    on the grain.  It is returned as a column.
    """
    if weight not in ("samples", "minutes"):
        raise ValueError(f"unknown weight {weight}")
    tier = choose_tier(unit, start, as_of)
    lo, hi = at(start), at(end)
    if tier == "raw":
        inside = samples.where((F.col("checked_at") >= lo) & (F.col("checked_at") < hi))
        if weight == "minutes":
            inside = minute_samples(inside).withColumnRenamed("period_minute", "checked_at")
        rows = inside.select(
            F.col("checked_at").alias("_at"), "target_name", F.lit(1).alias("probes"),
            (F.col("is_up") == 1).cast("int").alias("up_probes"),
        )
    else:
        source, name = (hourly, "period_hour") if tier == "hourly" else (daily, "period_start")
        period = F.col(name).cast("timestamp")
        rows = source.where((period >= lo) & (period < hi)).select(
            period.alias("_at"), "target_name", "probes", "up_probes"
        )
    return rows.groupBy(F.date_trunc(unit, F.col("_at")).alias("period_start"), "target_name").agg(
        F.sum("probes").alias("probes"), F.sum("up_probes").alias("up_probes"),
        availability_pct(F.sum("up_probes"), F.sum("probes")).alias("availability_pct"),
    ).withColumn("tier", F.lit(tier)).withColumn("weight", F.lit(weight))


def _first_whole_day(as_of: datetime, days: int) -> datetime:
    """The first day of which a tier keeps everything."""
    edge = as_of - timedelta(days=days)
    day = edge.replace(hour=0, minute=0, second=0, microsecond=0)
    return day if day == edge else day + timedelta(days=1)


def tiered_report_stitched(
    samples: DataFrame, hourly: DataFrame, daily: DataFrame, *,
    unit: str, start: datetime, end: datetime, as_of: datetime, weight: str = "samples",
) -> DataFrame:
    """``tiered_report`` over any range: each period from the finest tier, up to ``unit``, that still holds it.

    Tiers meet at the first day that the finer one keeps whole, so every period comes from
    exactly one tier.  Only whole periods inside ``[start, end)`` are returned; ``grain`` says
    how long a period is.
    """
    grains = {"minute": ["minute", "hour", "day"], "hour": ["hour", "day"]}.get(unit, [unit])
    keeps = {"minute": RAW_RETENTION_DAYS, "hour": HOURLY_RETENTION_DAYS}
    out, until = None, end
    for grain in grains:
        since = max(start, _first_whole_day(as_of, keeps[grain])) if grain in keeps else start
        if since >= until:
            continue
        part = tiered_report(samples, hourly, daily, unit=grain, start=since, end=until, as_of=as_of, weight=weight)
        first = F.col("period_start")
        behind = F.date_trunc(grain, first) + F.expr(f"INTERVAL 1 {grain}")
        part = part.where((first >= at(since)) & (behind <= at(until))).withColumn("grain", F.lit(grain))
        out = part if out is None else out.unionByName(part)
        until = since
    if out is None:
        raise ValueError("the range is empty")
    return out
