"""The ingest path: bounded micro-batches from documents to stored tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from probewatch import schemas as S
from probewatch.operators import ingest as ops
from probewatch.operators import inventory, kpi
from probewatch.operators.repair import late_hours
from probewatch.operators.series import _datetime, _micros, at, at_micros
from probewatch.sources.constraints import split_valid
from probewatch.sources.documents import pair_points, points_of, rejected_documents, stream_documents
from probewatch.sources.samples import range_window
from probewatch.streaming.maintenance import maintain
from probewatch.streaming.store import Store
from probewatch.streaming.tracker import (
    advance_downtime, advance_latency, broadcast_if_small, incremental_status_events, split_open,
)


def backfill_windows(
    high_water: int, now: int, *, overlap: int = S.OVERLAP_SECONDS, chunk: int = S.BACKFILL_CHUNK_SECONDS,
    per_cycle: int = S.BACKFILL_CHUNKS_PER_CYCLE, initial: int = S.BACKFILL_INITIAL_SECONDS,
    maximum: int = S.BACKFILL_MAX_SECONDS,
) -> tuple[list[tuple[int, int]], int]:
    """Epoch windows ``(start, end]`` to read in one cycle, and the seconds left over.

    Every window reaches back by ``overlap`` for late samples; an empty window
    does not stop the cursor.
    """
    floor = now - maximum
    if high_water == 0:
        cursor = now - initial
    else:
        cursor = min(max(high_water, floor), now)
    windows = []
    while len(windows) < per_cycle:
        start, end = max(cursor - overlap, floor), min(cursor + chunk, now)
        windows.append((min(start, end - 1), end))
        cursor = end
        if cursor >= now:
            break
    return windows, now - cursor


def dedup_stream(samples: DataFrame, delay: str = "3 minutes") -> DataFrame:
    """Stateful deduplication within the watermark, for streams without a store."""
    return samples.withWatermark("checked_at", delay).dropDuplicatesWithinWatermark(ops.SAMPLE_KEY)


def hourly_stream(samples: DataFrame) -> DataFrame:
    """Hourly sample counts of a stream with a watermark, by event-time window."""
    up = F.col("is_up") == 1
    return (
        samples.groupBy(F.window("checked_at", "1 hour"), "target_name")
        .agg(F.count(F.lit(1)).alias("probes"), F.count_if(up).alias("up_probes"),
             F.count_if(F.col("is_up") == 0).alias("down_probes"))
        .select(F.col("window.start").alias("period_hour"), "target_name",
                "probes", "up_probes", "down_probes")
    )


def _context(store: Store, new_rows: DataFrame) -> DataFrame:
    """Stored rows that contain the predecessor of every new row.

    In order, that is the last sample of each target.  For late rows the hourly
    KPI rows tell how far back the raw partitions have to be read.
    """
    last = store.replaced("last_sample", S.LAST_SAMPLE)
    first_new = new_rows.groupBy("target_name").agg(F.min("checked_at").alias("_first"))
    late = first_new.join(last, "target_name").where(F.col("_first") <= F.col("checked_at")).select(
        "target_name", "_first")
    if late.isEmpty():
        return last
    hours = (
        store.replaced("hourly_kpi", S.HOURLY_KPI).join(broadcast_if_small(late), "target_name")
        .where(F.col("first_probe_at") < F.col("_first"))
        .groupBy("target_name").agg(F.max("period_hour").alias("h"))
    )
    lower = hours.agg(F.unix_micros(F.min("h"))).first()[0]
    if lower is None:
        lower = late.agg(F.unix_micros(F.min("_first"))).first()[0]
    ordered = last.join(late, "target_name", "left_anti")
    stored = (
        store.appended("samples", S.SAMPLE, since=_datetime(lower).date())
        .where(F.col("checked_at") >= at_micros(lower))
        .join(broadcast_if_small(late.select("target_name")), "target_name", "left_semi")
        .select("target_name", "checked_at", "is_up")
    )
    return ordered.select("target_name", "checked_at", "is_up").unionByName(stored)


def _together(spark: SparkSession, steps: list[Callable[[], None]]) -> None:
    """Run independent write steps as concurrent Spark jobs; the first error is raised."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


def _days(df: DataFrame, column: str) -> list[str]:
    """Days touched by a batch: bounded by the backfill limit, not by its rows."""
    return [str(r[0]) for r in df.select(F.to_date(column)).distinct().collect()]


def ingest_batch(
    store: Store, batch: DataFrame, batch_id: int, as_of: datetime, *,
    slow_ms=S.SLOW_MS, inactive_after: int = S.INACTIVE_AFTER_SECONDS,
    backlog_seconds: int | None = None, retention: bool = True, begun: bool = False,
) -> None:
    """Apply one batch of probe samples to all stored tables, exactly once.

    ``batch`` is used more than once: pass rows that are stable when read again.  With
    retention, samples of days whose keys the store no longer holds are set aside as too
    late, as a repeated delivery of them would count twice.
    """
    if batch_id <= store.committed:
        return
    if not begun:
        store.begin(batch_id, as_of)
    valid, rejected = split_valid(batch)
    now = at(as_of)
    if retention:
        in_time = ops.within_retention(now)
        rejected = rejected.unionByName(valid.where(~in_time).withColumn("reason", F.lit("too late")))
        valid = valid.where(in_time)
    # Stored keys are read only for the time span of the batch: by day
    # and, as most files hold one batch, by their row-group statistics.
    known = store.appended("samples", S.SAMPLE, days=[])
    fetched, first, last = valid.agg(
        F.count(F.lit(1)), F.unix_micros(F.min("checked_at")), F.unix_micros(F.max("checked_at"))).first()
    if first is not None:
        known = store.appended("samples", S.SAMPLE, since=_datetime(first).date(), until=_datetime(last).date())
        known = known.where(F.col("checked_at").between(at_micros(first), at_micros(last)))
    fresh = ops.dedup_new_rows(valid, known)
    inserted = Observation()
    fresh = fresh.observe(inserted, F.count(F.lit(1)).alias("rows"))  # counted by the write itself
    store.stage_append("samples", fresh.sortWithinPartitions("target_name", "checked_at"), "checked_at", batch_id)
    store.stage_append("rejected", rejected.withColumn("seen_at", now), "seen_at", batch_id)
    new_rows = store.batch_rows("samples", S.SAMPLE, batch_id)
    days = _days(new_rows, "checked_at")

    def kpi_table(table, schema, unit, period):
        current = store.replaced(table, schema, days)
        merged = ops.merge_kpi(current, kpi.kpi_raw(new_rows, unit, slow_ms), period)
        store.stage_replace(table, merged, batch_id, day=period, days=days)

    def status_table():
        status = incremental_status_events(new_rows, _context(store, new_rows))
        store.stage_append("status_events", status, "event_at", batch_id)

    def incident_tables(name, schema, advance, end):
        touched = advance(store.replaced(f"{name}_open", schema), new_rows)
        opened, closed = split_open(store.scratch(name, touched, schema), end)
        store.stage_replace(f"{name}_open", opened, batch_id)
        store.stage_append(f"{name}_closed", closed, end, batch_id)

    def error_table():
        errors = ops.merge_errors(
            store.replaced("daily_errors", S.DAILY_ERROR, days), kpi.daily_errors_raw(new_rows))
        store.stage_replace("daily_errors", errors, batch_id, day="period_start", days=days)

    def target_tables():
        targets = inventory.target_inventory(store.replaced("targets", S.TARGET), valid)
        store.stage_replace("targets", inventory.deactivate(targets, valid, now, inactive_after), batch_id)
        last = (
            store.replaced("last_sample", S.LAST_SAMPLE)
            .unionByName(new_rows.select(*S.LAST_SAMPLE.fieldNames()))
            .groupBy("target_name")
            .agg(F.max("checked_at").alias("newest"), F.max_by("is_up", "checked_at").alias("is_up"))
            .select("target_name", F.col("newest").alias("checked_at"), "is_up")
        )
        store.stage_replace("last_sample", last, batch_id)

    def late_table():
        late = late_hours(new_rows, broadcast_if_small(store.replaced("last_sample", S.LAST_SAMPLE)))
        if not late.isEmpty():
            store.stage_replace("late_hours", store.replaced("late_hours", S.TARGET_HOUR).unionByName(late).distinct(), batch_id)

    def metric_table():
        newest = F.lit(None).cast("timestamp") if last is None else at_micros(last)
        metrics = ops.metrics_row(store.spark, now, fetched, newest, inserted.get["rows"], backlog_seconds)
        store.stage_append("ingest_metrics", metrics, "cycle_at", batch_id)

    # The tables do not depend on each other before the commit, so their small
    # jobs share the cluster instead of queueing.
    slow = partial(advance_latency, threshold_ms=slow_ms)
    _together(store.spark, [
        partial(incident_tables, "downtime", S.DOWNTIME_EVENT, advance_downtime, "down_end"),
        partial(incident_tables, "latency", S.LATENCY_EVENT, slow, "slow_end"),
        status_table, target_tables,
        partial(kpi_table, "daily_kpi", S.DAILY_KPI, "day", "period_start"),
        partial(kpi_table, "hourly_kpi", S.HOURLY_KPI, "hour", "period_hour"),
        error_table, metric_table, late_table,
    ])

    def edge(n):
        return (as_of - timedelta(days=n)).date()

    drop = {}
    if retention:
        drop = {"daily_kpi": edge(S.REPORT_RETENTION_DAYS), "daily_errors": edge(S.REPORT_RETENTION_DAYS),
                "hourly_kpi": edge(S.HOURLY_RETENTION_DAYS), "samples": edge(S.RAW_RETENTION_DAYS)}
        drop |= dict.fromkeys(("status_events", "downtime_closed", "latency_closed"), edge(S.REPORT_RETENTION_DAYS))
    store.commit(batch_id, drop)


def ingest_cycle(store: Store, source: DataFrame, now: datetime) -> int:
    """Pull bounded windows of a sample table up to ``now``; returns the seconds left.

    The cursor is the newest stored sample or the end of the last cycle's
    windows, whichever is later, so a long gap in the source is passed.
    """
    stored = ops.high_water(store.replaced("last_sample", S.LAST_SAMPLE)).first()[0]
    done = store.appended("ingest_metrics", S.INGEST_METRICS).agg(
        F.max(F.unix_seconds("cycle_at") - F.col("backfill_remaining_seconds"))).first()[0]
    end = _micros(now) // 1_000_000
    windows, left = backfill_windows(max(stored, done or 0), end)
    for lo, hi in windows:
        part = range_window(source, "checked_at", at_micros(lo * 1_000_000), at_micros(hi * 1_000_000))
        try:
            # Read the source once: rows that arrive meanwhile belong to the next cycle.
            part = store.scratch("window", part, S.SAMPLE)
            ingest_batch(store, part, store.committed + 1, now, backlog_seconds=end - hi)
        except Exception:
            record_failure(store, now)
            raise
    maintain(store, now)
    return left


def tables(store: Store, as_of: datetime) -> dict[str, DataFrame]:
    """Stored tables by name, with exact retention edges applied."""
    now = at(as_of)
    down = store.replaced("downtime_open", S.DOWNTIME_EVENT).unionByName(
        store.appended("downtime_closed", S.DOWNTIME_EVENT))
    slow = store.replaced("latency_open", S.LATENCY_EVENT).unionByName(
        store.appended("latency_closed", S.LATENCY_EVENT))
    return {
        "samples": ops.keep_samples(store.appended("samples", S.SAMPLE), now),
        "targets": store.replaced("targets", S.TARGET),
        "last_sample": store.replaced("last_sample", S.LAST_SAMPLE),
        "daily_kpi": ops.keep_daily(store.replaced("daily_kpi", S.DAILY_KPI), now),
        "hourly_kpi": ops.keep_hourly(store.replaced("hourly_kpi", S.HOURLY_KPI), now),
        "daily_errors": ops.keep_daily(store.replaced("daily_errors", S.DAILY_ERROR), now),
        "status_events": ops.keep_status_events(store.appended("status_events", S.STATUS_EVENT), now),
        "downtime_events": ops.keep_events(down, "down_end", now),
        "latency_events": ops.keep_events(slow, "slow_end", now),
        "ingest_metrics": store.appended("ingest_metrics", S.INGEST_METRICS).unionByName(
            store.failures(S.INGEST_METRICS)),
    }


def record_failure(store: Store, as_of: datetime) -> None:
    """Keep the self-metrics of a failed cycle; its last success is the stored one."""
    before = store.appended("ingest_metrics", S.INGEST_METRICS)
    store.record_failure(ops.failed_metrics(before, at(as_of)))


def start_ingest(
    spark: SparkSession, documents_path: str, store_root: str, checkpoint: str, *,
    clock: Callable[[], datetime], once: bool = False,
    max_files_per_trigger: int = S.BACKFILL_CHUNKS_PER_CYCLE, interval: str = "60 seconds",
    wait_seconds: int = S.OVERLAP_SECONDS,
):
    """Start the streaming query: documents to stored tables, one commit per batch.

    The documents of a window may fall into different batches: points without their
    counterpart wait in a small table.  A success sample waits for ``wait_seconds`` after it
    arrived and is then stored without latency; a duration waits for its sample as long as
    samples of its time are accepted, and amends a stored one, so the stored tables do not
    depend on the order and the grouping in which the documents come.
    """
    store = Store(spark, store_root)

    def apply(documents: DataFrame, batch_id: int) -> None:
        if batch_id <= store.committed:
            return
        now = store.begin(batch_id, clock())
        try:
            # Parse once: the batch is read several times below.
            points = store.scratch("points", points_of(documents, at(now)), S.POINT)
            ready, waiting = pair_points(points, store.replaced("waiting_points", S.POINT), at(now), wait_seconds)
            samples = store.scratch("batch", ready, S.SAMPLE)
            store.stage_replace("waiting_points", waiting, batch_id)
            bad = rejected_documents(documents).withColumn("seen_at", at(now))
            store.stage_append("rejected_documents", bad, "seen_at", batch_id)
            ingest_batch(store, samples, batch_id, now, begun=True)
            maintain(store, now)
        except Exception:
            record_failure(store, now)
            raise

    writer = (
        stream_documents(spark, documents_path, max_files_per_trigger)
        .writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
