"""Deduplication, merging and retention of stored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probewatch.functions.scalars import seconds_between
from probewatch.schemas import (
    HOURLY_RETENTION_DAYS, LABELS, RAW_RETENTION_DAYS, REPORT_RETENTION_DAYS,
)

SAMPLE_KEY = ["checked_at", "target_name"]


def high_water(samples: DataFrame) -> DataFrame:
    """Whole epoch second of the newest stored sample, 0 when there is none."""
    newest = F.floor(F.unix_micros(F.max("checked_at")) / 1_000_000)
    return samples.agg(F.coalesce(newest, F.lit(0)).alias("high_water"))


def _least_rows(batch: DataFrame) -> DataFrame:
    """One row per (time, target); ``min`` over a struct combines on the map side."""
    rest = [c for c in batch.columns if c not in SAMPLE_KEY and c != "instance"]
    best = batch.groupBy(*SAMPLE_KEY).agg(F.min(F.struct("instance", *rest)).alias("r"))
    return best.select(*[
        F.col(c) if c in SAMPLE_KEY else F.col(f"r.{c}").alias(c) for c in batch.columns
    ])


def unique_samples(batch: DataFrame) -> DataFrame:
    """One row per (time, target); the lowest instance wins, then the other columns.

    Keys are counted by hashing first.  Only rows of the few repeated keys are sorted, and
    many copies of one of them cost one row per map task.
    """
    repeated = batch.groupBy(*SAMPLE_KEY).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    single = batch.join(repeated, SAMPLE_KEY, "left_anti").select(*batch.columns)
    return single.unionByName(_least_rows(batch.join(repeated, SAMPLE_KEY, "left_semi").select(*batch.columns)))


def within_retention(as_of: Column, days: int = RAW_RETENTION_DAYS) -> Column:
    """Condition of samples whose key the store still remembers."""
    return F.to_date("checked_at") >= F.date_sub(as_of.cast("date"), days)


def dedup_new_rows(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of the batch whose key is not stored yet, one per key."""
    return unique_samples(batch).join(stored.select(*SAMPLE_KEY), SAMPLE_KEY, "left_anti")


def upsert_replace(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows replace stored rows of the same key."""
    kept = stored.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming)


def _merge(stored: DataFrame, incoming: DataFrame, keys, labels, aggs) -> DataFrame:
    both = stored.withColumn("_in", F.lit(0)).unionByName(incoming.withColumn("_in", F.lit(1)))
    merged = both.groupBy(*keys).agg(
        F.max_by(F.struct(*labels), "_in").alias("_labels"), *aggs
    )
    types = dict(stored.dtypes)
    return merged.select(*[
        (F.col(f"_labels.{c}") if c in labels else F.col(c)).cast(types[c]).alias(c)
        for c in stored.columns
    ])


def merge_kpi(stored: DataFrame, incoming: DataFrame, period: str) -> DataFrame:
    """Additive upsert of KPI rows; labels come from the incoming row."""
    sums = ["probes", "up_probes", "down_probes", "slow_probes", "latency_ms_sum", "latency_ms_count"]
    return _merge(stored, incoming, [period, "target_name"], LABELS, [
        *[F.sum(c).alias(c) for c in sums],
        F.max("max_latency_ms").alias("max_latency_ms"),
        F.min("first_probe_at").alias("first_probe_at"),
        F.max("last_probe_at").alias("last_probe_at"),
    ])


def merge_errors(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    return _merge(stored, incoming, ["period_start", "target_name", "error_text"], LABELS, [
        F.sum("error_count").alias("error_count"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    ])


def rebuild_range(stored: DataFrame, rebuilt: DataFrame, period: str, minutes: DataFrame) -> DataFrame:
    """Stored rows of periods before the first minute, plus the rebuilt rows.

    The edge comes from the minutes for every table: a rebuilt table may lack rows at the
    edge, or altogether, as daily errors do when nothing was down.
    """
    first = F.min("period_minute")
    first = F.date_trunc("hour", first) if period == "period_hour" else F.to_date(first)
    edge = minutes.agg(first.alias("_edge"))  # one row
    kept = stored.join(F.broadcast(edge), F.col("_edge").isNull() | (F.col(period) < F.col("_edge"))).drop("_edge")
    return kept.unionByName(rebuilt)


def rebuild_summary(minutes: DataFrame, hourly: DataFrame, daily: DataFrame, errors: DataFrame) -> DataFrame:
    def size(df, name):
        return df.agg(F.count(F.lit(1)).alias(name))

    return (
        size(minutes, "normalized_minute_samples")
        .crossJoin(size(hourly, "hourly_kpi_rows"))
        .crossJoin(size(daily, "daily_kpi_rows"))
        .crossJoin(size(errors, "daily_error_rows"))
    )


def require_rows(samples: DataFrame) -> None:
    """Refuse a rebuild from nothing: it would erase the stored periods."""
    if samples.isEmpty():
        raise ValueError("cannot normalize KPI rows: there are no raw samples")


def raw_summary(samples: DataFrame) -> DataFrame:
    return samples.agg(
        F.count(F.lit(1)).alias("samples"),
        F.min("checked_at").alias("first_checked_at"),
        F.max("checked_at").alias("last_checked_at"),
    )


def _days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def keep_samples(samples: DataFrame, as_of: Column, days: int = RAW_RETENTION_DAYS) -> DataFrame:
    return samples.where(F.col("checked_at") >= _days_before(as_of, days))


def keep_hourly(hourly: DataFrame, as_of: Column, days: int = HOURLY_RETENTION_DAYS) -> DataFrame:
    return hourly.where(F.col("period_hour") >= _days_before(as_of, days))


def keep_daily(daily: DataFrame, as_of: Column, days: int = REPORT_RETENTION_DAYS) -> DataFrame:
    """Daily KPI and daily errors: compared by date, not by instant."""
    return daily.where(F.col("period_start") >= F.date_sub(as_of.cast("date"), days))


def keep_status_events(events: DataFrame, as_of: Column, days: int = REPORT_RETENTION_DAYS) -> DataFrame:
    return events.where(F.col("event_at") >= _days_before(as_of, days))


def keep_events(events: DataFrame, end: str, as_of: Column, days: int = REPORT_RETENTION_DAYS) -> DataFrame:
    """Incident rows by their end; open incidents never expire."""
    return events.where(F.col(end).isNull() | (F.col(end) >= _days_before(as_of, days)))


def batch_metrics(
    fetched: DataFrame, inserted: DataFrame, as_of: Column, backlog_seconds: int | None = None,
) -> DataFrame:
    """One row of self-metrics of an ingest batch that succeeded.

    Without a given backlog it is the age of the newest fetched sample.
    """
    age = F.floor(seconds_between(as_of, F.col("newest"))).cast("long")
    behind = age if backlog_seconds is None else F.lit(backlog_seconds).cast("long")
    return (
        fetched.agg(F.count(F.lit(1)).alias("samples_fetched_last_cycle"),
                    F.max("checked_at").alias("newest"))
        .crossJoin(inserted.agg(F.count(F.lit(1)).alias("rows_inserted_last_cycle")))
        .select(
            as_of.alias("cycle_at"),
            F.lit(1).alias("cycle_success"),
            F.unix_seconds(as_of).alias("last_success_timestamp_seconds"),
            "samples_fetched_last_cycle", "rows_inserted_last_cycle",
            F.greatest(F.coalesce(behind, F.lit(0)), F.lit(0)).alias("backfill_remaining_seconds"),
        )
    )


def metrics_row(spark, as_of: Column, fetched: int, newest: Column, inserted: int, backlog_seconds: int | None = None) -> DataFrame:
    """``batch_metrics`` from counts that earlier steps have made already."""
    age = F.floor(seconds_between(as_of, newest)).cast("long")
    behind = age if backlog_seconds is None else F.lit(backlog_seconds).cast("long")
    whole = lambda n: F.lit(n).cast("long")
    return spark.range(1).select(
        as_of.alias("cycle_at"), F.lit(1).alias("cycle_success"), F.unix_seconds(as_of).alias("last_success_timestamp_seconds"),
        whole(fetched).alias("samples_fetched_last_cycle"), whole(inserted).alias("rows_inserted_last_cycle"),
        F.greatest(F.coalesce(behind, whole(0)), whole(0)).alias("backfill_remaining_seconds"))


def failed_metrics(before: DataFrame, as_of: Column) -> DataFrame:
    """Self-metrics of a failed batch: nothing moved, the last success stays."""
    last = before.agg(
        F.coalesce(F.max("last_success_timestamp_seconds"), F.lit(0)).alias("last_success_timestamp_seconds"),
        F.coalesce(F.max_by("backfill_remaining_seconds", "cycle_at"), F.lit(0)).alias("backfill_remaining_seconds"),
    )
    none = F.lit(0).cast("long")
    return last.select(
        as_of.alias("cycle_at"), F.lit(0).alias("cycle_success"), "last_success_timestamp_seconds",
        none.alias("samples_fetched_last_cycle"), none.alias("rows_inserted_last_cycle"),
        "backfill_remaining_seconds",
    )
