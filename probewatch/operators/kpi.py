"""Minute, hourly, daily, monthly and yearly availability KPIs, and errors.

Two weights exist side by side.  ``*_raw`` counts every sample, as the
incremental path does; ``*_norm`` counts every minute once.

Aggregates over text keep a Spark aggregation from hashing, so the raw roll-ups
first group by the label columns themselves (numeric buffers only, combined on
the map side) and take the greatest label in a second, small step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probewatch.functions.scalars import availability_pct, is_slow, mean_latency
from probewatch.schemas import DEFAULT_ERROR_TEXT, LABELS, SLOW_MS

PERIOD = {"hour": "period_hour", "day": "period_start"}


def _period(unit: str, ts: Column) -> Column:
    value = F.to_date(ts) if unit == "day" else F.date_trunc(unit, ts)
    return value.alias(PERIOD[unit])


def minute_samples(samples: DataFrame, slow_ms=SLOW_MS) -> DataFrame:
    """One row per (minute, target): any DOWN sample makes the minute DOWN."""
    at, up, down = F.col("checked_at"), F.col("is_up") == 1, F.col("is_up") == 0
    latency = F.when(up, F.col("latency_ms"))
    keys = ["period_minute", "target_name"]
    # numbers only in the buffers: the texts are grouping columns here
    partial = samples.groupBy(
        F.date_trunc("minute", at).alias("period_minute"), "target_name", *LABELS,
        F.when(down, F.col("error_text")).alias("_text"),
    ).agg(
        F.min("is_up").alias("is_up"), F.sum(latency).alias("_sum"), F.count(latency).alias("_n"),
        F.max(latency).alias("max_latency_ms"), F.count_if(latency > F.lit(slow_ms)).alias("_slow"),
        F.min(at).alias("first_probe_at"), F.max(at).alias("last_probe_at"),
        F.min(F.when(down, at)).alias("first_down_at"), F.max(F.when(down, at)).alias("last_down_at"),
    )
    all_up = F.min("is_up") == 1
    # precisions that leave the quotient 17 digits
    count = F.nullif(F.sum("_n").cast("decimal(10,0)"), F.lit(0).cast("decimal(10,0)"))
    mean = (F.sum("_sum").cast("decimal(27,6)") / count).cast("decimal(24,10)")
    text_at = F.when(F.col("_text").isNotNull(), F.col("first_down_at"))
    out = partial.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in LABELS],
        F.min("is_up").alias("is_up"),
        F.when(all_up, mean).alias("latency_ms"),
        F.when(all_up, F.max("max_latency_ms")).alias("max_latency_ms"),
        F.when(~all_up, F.lit(False)).when(F.sum("_n") > 0, F.sum("_slow") > 0).alias("is_slow"),
        F.coalesce(F.min_by("_text", text_at), F.lit(DEFAULT_ERROR_TEXT)).alias("error_text"),
        F.min("first_probe_at").alias("first_probe_at"), F.max("last_probe_at").alias("last_probe_at"),
        F.min("first_down_at").alias("first_down_at"), F.max("last_down_at").alias("last_down_at"),
    )
    return out


def _top_labels(partial: DataFrame, keys: list[str], aggs: list[Column], order: list[str]) -> DataFrame:
    out = partial.groupBy(*keys).agg(*[F.max(c).alias(c) for c in LABELS], *aggs)
    return out.select(*keys, *LABELS, *order)


_KPI_ORDER = [
    "probes", "up_probes", "down_probes", "slow_probes", "latency_ms_sum", "latency_ms_count",
    "max_latency_ms", "first_probe_at", "last_probe_at",
]


def _kpi(rows: DataFrame, period: Column, period_name: str, slow: Column, peak: str,
         first: str, last: str) -> DataFrame:
    up = F.col("is_up") == 1
    latency = F.when(up, F.col("latency_ms"))
    partial = rows.groupBy(period, "target_name", *LABELS).agg(
        F.count(F.lit(1)).alias("probes"),
        F.count_if(up).alias("up_probes"),
        F.count_if(F.col("is_up") == 0).alias("down_probes"),
        F.count_if(slow).alias("slow_probes"),
        F.sum(latency).alias("latency_ms_sum"),
        F.count(latency).alias("latency_ms_count"),
        F.max(F.when(up, F.col(peak))).alias("max_latency_ms"),
        F.min(first).alias("first_probe_at"), F.max(last).alias("last_probe_at"),
    )
    sums = ["probes", "up_probes", "down_probes", "slow_probes", "latency_ms_count"]
    return _top_labels(partial, [period_name, "target_name"], [
        *[F.sum(c).alias(c) for c in sums],
        F.coalesce(F.sum("latency_ms_sum"), F.lit(0)).cast("decimal(38,10)").alias("latency_ms_sum"),
        F.max("max_latency_ms").alias("max_latency_ms"),
        F.min("first_probe_at").alias("first_probe_at"),
        F.max("last_probe_at").alias("last_probe_at"),
    ], _KPI_ORDER)


def kpi_raw(samples: DataFrame, unit: str, slow_ms=SLOW_MS) -> DataFrame:
    """Hourly or daily KPI where each sample weighs one."""
    return _kpi(samples, _period(unit, F.col("checked_at")), PERIOD[unit], is_slow(slow_ms),
                "latency_ms", "checked_at", "checked_at")


def kpi_norm(minutes: DataFrame, unit: str) -> DataFrame:
    """Hourly or daily KPI where each minute weighs one."""
    return _kpi(minutes, _period(unit, F.col("period_minute")), PERIOD[unit], F.col("is_slow"),
                "max_latency_ms", "first_probe_at", "last_probe_at")


def _errors(rows: DataFrame, day: Column, text: Column, first: str, last: str) -> DataFrame:
    partial = (
        rows.where(F.col("is_up") == 0)
        .groupBy(day.alias("period_start"), "target_name", text.alias("error_text"), *LABELS)
        .agg(F.count(F.lit(1)).alias("error_count"),
             F.min(first).alias("first_seen_at"), F.max(last).alias("last_seen_at"))
    )
    return _top_labels(partial, ["period_start", "target_name", "error_text"], [
        F.sum("error_count").alias("error_count"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    ], ["error_count", "first_seen_at", "last_seen_at"])


def daily_errors_raw(samples: DataFrame) -> DataFrame:
    text = F.coalesce("error_text", F.lit(DEFAULT_ERROR_TEXT))
    return _errors(samples, F.to_date("checked_at"), text, "checked_at", "checked_at")


def daily_errors_norm(minutes: DataFrame) -> DataFrame:
    text = F.coalesce("error_text", F.lit(DEFAULT_ERROR_TEXT))
    return _errors(minutes, F.to_date("period_minute"), text, "first_down_at", "last_down_at")


_VIEW_KEYS = ["target_name", "db_type", "environment", "criticality"]


def availability(kpi: DataFrame, unit: str) -> DataFrame:
    """Daily or hourly availability view over stored KPI rows."""
    period = F.col(PERIOD[unit]).cast("timestamp").alias(PERIOD[unit])
    return kpi.select(
        period, *_VIEW_KEYS, "probes", "up_probes", "down_probes", "slow_probes",
        availability_pct(F.col("up_probes"), F.col("probes")).alias("availability_pct"),
        mean_latency(F.col("latency_ms_sum"), F.col("latency_ms_count")).alias("avg_latency_ms"),
        F.round("max_latency_ms", 2).alias("max_latency_ms"), "last_probe_at",
    )


def ratio_of_sums() -> list[Column]:
    """Aggregates of KPI rows; ratios come from summed parts, never from ratios."""
    return [
        F.sum("probes").alias("probes"), F.sum("up_probes").alias("up_probes"),
        F.sum("down_probes").alias("down_probes"), F.sum("slow_probes").alias("slow_probes"),
        availability_pct(F.sum("up_probes"), F.sum("probes")).alias("availability_pct"),
        mean_latency(F.sum("latency_ms_sum"), F.sum("latency_ms_count")).alias("avg_latency_ms"),
        F.round(F.max("max_latency_ms"), 2).alias("max_latency_ms"),
        F.max("last_probe_at").alias("last_probe_at"),
    ]


def rollup_availability(daily: DataFrame, unit: str) -> DataFrame:
    """Monthly or yearly availability; a relabelled target keeps one row per label set."""
    period = F.date_trunc(unit, F.col("period_start")).alias("period_start")
    return daily.groupBy(period, *_VIEW_KEYS).agg(*ratio_of_sums())
