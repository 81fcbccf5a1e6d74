"""Full recompute of every derived table from raw samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from probewatch.operators import events, inventory, kpi
from probewatch.operators.ingest import rebuild_range, rebuild_summary, require_rows, upsert_replace
from probewatch.operators.lineage import cut_lineage
from probewatch.schemas import SLOW_MS


def recompute(samples: DataFrame, slow_ms=SLOW_MS) -> dict[str, DataFrame]:
    """Derived tables by name; minutes weigh one, whatever the probe rate.

    Several results read ``samples`` and ``minutes``: give stored (or
    persisted) samples, and persist ``minutes`` before writing more than one.
    """
    minutes = kpi.minute_samples(samples, slow_ms)
    return {
        "minute_samples": minutes,
        "hourly_kpi": kpi.kpi_norm(minutes, "hour"),
        "daily_kpi": kpi.kpi_norm(minutes, "day"),
        "daily_errors": kpi.daily_errors_norm(minutes),
        "status_events": events.status_events(samples),
        "downtime_events": events.downtime_events(samples),
        "latency_events": events.latency_events(samples, slow_ms),
    }


KEYS = {
    "hourly_kpi": ["period_hour", "target_name"],
    "daily_kpi": ["period_start", "target_name"],
    "daily_errors": ["period_start", "target_name", "error_text"],
    "status_events": ["target_name", "event_at"],
    "downtime_events": ["target_name", "down_start"],
    "latency_events": ["target_name", "slow_start", "threshold_ms"],
}


def upsert_recomputed(stored: dict[str, DataFrame], fresh: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Recomputed rows replace stored rows of the same key; others stay."""
    return {name: upsert_replace(stored[name], fresh[name], keys)
            for name, keys in KEYS.items() if name in stored}


def normalize_kpi(samples: DataFrame, hourly: DataFrame, daily: DataFrame, errors: DataFrame):
    """Rebuild KPI rows from minutes, from the first raw period on.

    Returns the three rebuilt tables and a one-row summary.
    """
    require_rows(samples)
    minutes = cut_lineage(kpi.minute_samples(samples))  # read by all four results
    new_hourly = rebuild_range(hourly, kpi.kpi_norm(minutes, "hour"), "period_hour", minutes)
    new_daily = rebuild_range(daily, kpi.kpi_norm(minutes, "day"), "period_start", minutes)
    new_errors = rebuild_range(errors, kpi.daily_errors_norm(minutes), "period_start", minutes)
    return new_hourly, new_daily, new_errors, rebuild_summary(minutes, new_hourly, new_daily, new_errors)


def register_views(tables: dict[str, DataFrame], as_of: Column) -> None:
    """Register the reporting and health views over stored tables by name."""
    recent = tables.get("last_sample", tables["samples"])
    views = {
        "daily_availability": kpi.availability(tables["daily_kpi"], "day"),
        "hourly_availability": kpi.availability(tables["hourly_kpi"], "hour"),
        "monthly_availability": kpi.rollup_availability(tables["daily_kpi"], "month"),
        "yearly_availability": kpi.rollup_availability(tables["daily_kpi"], "year"),
        "downtime_event_history": events.downtime_history(tables["downtime_events"], as_of),
        "latency_event_history": events.latency_history(tables["latency_events"], as_of),
        "ingest_health": inventory.ingest_health(tables["targets"], recent, as_of),
        "missing_recent_targets": inventory.missing_recent_targets(tables["targets"], recent, as_of),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
