"""Status changes, downtime incidents and slow-latency incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probewatch.functions.scalars import event_status, is_slow, mean_latency, seconds_between
from probewatch.operators.slices import state_runs, with_previous
from probewatch.schemas import DEC, DOWNTIME_EVENT, LABELS, LATENCY_EVENT, SLICE_SECONDS, SLOW_MS, STATUS_EVENT

TARGET = ["target_name"]


def _shape(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def status_events(samples: DataFrame, *, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Samples whose state differs from the one before; a first sample counts."""
    changed = with_previous(
        samples, TARGET, "checked_at", "is_up", "previous_is_up",
        slice_seconds=slice_seconds, changed_only=True,
    )
    return _shape(
        changed.withColumnsRenamed({"checked_at": "event_at", "is_up": "current_is_up"}), STATUS_EVENT
    )


def downtime_events(samples: DataFrame, *, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Runs of consecutive DOWN samples with their recovery time."""
    error_at = F.when(F.col("error_text").isNotNull(), F.col("checked_at"))
    state = F.col("_state")
    runs = state_runs(
        samples, TARGET, "checked_at",
        state=F.col("is_up"), wanted=state == 0, closes=state == 1,
        slice_seconds=slice_seconds,
        local={
            **{c: F.max(c) for c in LABELS},
            "n": F.count(F.lit(1)), "peak": F.max("latency_ms"),
            "e1": F.min_by("error_text", error_at), "e1_at": F.min(error_at),
            "e2": F.max_by("error_text", error_at), "e2_at": F.max(error_at),
        },
        merged={
            **{c: F.max(c) for c in LABELS},
            "down_samples": F.sum("n"), "max_latency_ms": F.max("peak"),
            "first_error_text": F.min_by("e1", "e1_at"),
            "last_error_text": F.max_by("e2", "e2_at"),
        },
    )
    names = {"run_start": "down_start", "run_last": "last_down_at", "run_end": "down_end"}
    return _shape(runs.withColumnsRenamed(names), DOWNTIME_EVENT)


def latency_events(samples: DataFrame, threshold_ms=SLOW_MS, *, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Runs of slow UP samples.

    An UP sample without latency is neither slow nor fast: it splits a run but
    does not end it, so two runs may share their end.
    """
    slow = F.col("_state")
    runs = state_runs(
        samples, TARGET, "checked_at",
        state=is_slow(threshold_ms), wanted=slow, closes=~slow,
        slice_seconds=slice_seconds,
        local={
            **{c: F.max(c) for c in LABELS},
            "n": F.count(F.lit(1)), "total": F.sum("latency_ms"),
            "with_latency": F.count("latency_ms"), "peak": F.max("latency_ms"),
        },
        merged={
            **{c: F.max(c) for c in LABELS},
            "slow_samples": F.sum("n"), "latency_ms_sum": F.coalesce(F.sum("total"), F.lit(0)),
            "latency_ms_count": F.sum("with_latency"), "max_latency_ms": F.max("peak"),
        },
    )
    names = {"run_start": "slow_start", "run_last": "last_slow_at", "run_end": "slow_end"}
    return _shape(
        runs.withColumnsRenamed(names).withColumn("threshold_ms", F.lit(threshold_ms).cast(DEC)),
        LATENCY_EVENT,
    )


def _duration(start: str, end: str, as_of: Column) -> list[Column]:
    seconds = seconds_between(F.coalesce(F.col(end), as_of), F.col(start))
    return [
        event_status(F.col(end)).alias("event_status"),
        F.round(seconds, 2).alias("duration_seconds"),
        F.round(seconds / F.lit(60).cast("decimal(2,0)"), 2).alias("duration_minutes"),
    ]


_WHO = ["target_name", "environment", "db_type", "instance", "criticality", "team"]


def downtime_history(events: DataFrame, as_of: Column) -> DataFrame:
    return events.select(
        *_WHO, "down_start", "down_end", "last_down_at",
        *_duration("down_start", "down_end", as_of),
        "down_samples", "first_error_text", "last_error_text",
        F.round("max_latency_ms", 2).alias("max_latency_ms"),
    )


def latency_history(events: DataFrame, as_of: Column) -> DataFrame:
    return events.select(
        *_WHO, "threshold_ms", "slow_start", "slow_end", "last_slow_at",
        *_duration("slow_start", "slow_end", as_of), "slow_samples",
        mean_latency(F.col("latency_ms_sum"), F.col("latency_ms_count")).alias("avg_latency_ms"),
        F.round("max_latency_ms", 2).alias("max_latency_ms"),
    )
