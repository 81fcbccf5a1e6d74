"""Jobs over the stored tables beside the batches: amended latencies, repair, normalisation, compaction.

Each job stages all it changes and publishes one version, so it may fail at any point and
run again.  Jobs and batches run one after another.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probewatch import schemas as S
from probewatch.functions.scalars import latency_from_seconds, number_of, timestamp_from_ms
from probewatch.operators import ingest as ops
from probewatch.operators import kpi, repair
from probewatch.streaming.store import Store

#: Appended tables and their schemas.
APPENDED = {
    "samples": S.SAMPLE, "status_events": S.STATUS_EVENT, "downtime_closed": S.DOWNTIME_EVENT,
    "latency_closed": S.LATENCY_EVENT, "ingest_metrics": S.INGEST_METRICS,
}
#: Name of the snapshot of the KPI tables before their first normalisation.
BEFORE_MINUTES = "pre_1m"
COMPACT_EVERY = 50


def first_raw_day(as_of: datetime):
    """The first day of which the store keeps all samples."""
    return (as_of - timedelta(days=S.RAW_RETENTION_DAYS)).date()


def _days(df: DataFrame, column: str) -> list[str]:
    return [str(r[0]) for r in df.select(F.to_date(column)).distinct().collect()]


# ---------------------------------------------------------------- durations that came after their samples

def amend_latency(store: Store, slow_ms=S.SLOW_MS) -> int:
    """Give waiting durations to stored samples that lack one; returns the samples amended.

    The days of amended samples are rewritten, their KPI rows gain latency only, and their
    hours are noted for ``repair_late``.  A duration whose sample has a latency is done with;
    one without a stored sample goes on waiting.
    """
    waiting = store.replaced("waiting_points", S.POINT)
    alone = waiting.where(F.col("metric") == S.DURATION_METRIC)
    if alone.isEmpty():
        return 0
    job = store.next_job()
    store.begin(job)
    readable = alone.withColumn("value", number_of(F.col("value"))).where("value is not null")
    took = readable.groupBy("ts_ms", "target_name", "instance").agg(F.max_by("value", "arrival").alias("seconds")).select(
        timestamp_from_ms(F.col("ts_ms")).alias("checked_at"), "ts_ms", "target_name", "instance",
        latency_from_seconds(F.col("seconds").cast("string")).alias("_took"))
    days = _days(took, "checked_at")
    stored = store.appended("samples", S.SAMPLE, days=days)
    key = ["checked_at", "target_name", "instance"]
    met = stored.join(took, key).select(*S.SAMPLE.fieldNames(), "_took", "ts_ms", F.col("latency_ms").isNull().alias("_lacked"))
    met = store.scratch("met", met, met.schema)
    if met.isEmpty():
        return 0
    amended = met.where("_lacked").withColumn("latency_ms", F.col("_took")).select(*S.SAMPLE.fieldNames())
    days = _days(amended, "checked_at")
    if days:
        all_rows = store.appended("samples", S.SAMPLE, days=days)
        given = amended.select(*key, F.col("latency_ms").alias("_took"))
        new = all_rows.join(given, key, "left").withColumn("latency_ms", F.coalesce("latency_ms", "_took"))
        new = new.select(*S.SAMPLE.fieldNames()).sortWithinPartitions("target_name", "checked_at")
        store.stage_days("samples", new, "checked_at", days, job)
        none = {c: F.lit(0).cast("long") for c in ("probes", "up_probes", "down_probes")}
        for table, schema, unit, period in (("daily_kpi", S.DAILY_KPI, "day", "period_start"), ("hourly_kpi", S.HOURLY_KPI, "hour", "period_hour")):
            more = kpi.kpi_raw(amended, unit, slow_ms).withColumns(none)
            current = store.replaced(table, schema, days)
            shaped = more.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
            # the stored rows come second, so that their labels stay
            store.stage_replace(table, ops.merge_kpi(shaped, current, period), job, day=period, days=days)
        noted = store.replaced("late_hours", S.TARGET_HOUR).unionByName(repair.hours_of(amended)).distinct()
        store.stage_replace("late_hours", noted, job)
    done = met.select(F.lit(S.DURATION_METRIC).alias("metric"), "ts_ms", "target_name", "instance").distinct()
    left = waiting.join(done, ["metric", "ts_ms", "target_name", "instance"], "left_anti").select(*S.POINT.fieldNames())
    store.stage_replace("waiting_points", left, job)
    n = amended.count()
    store.commit()
    return n


# ---------------------------------------------------------------- events after late samples

def repair_late(store: Store, as_of: datetime, slow_ms=S.SLOW_MS) -> int:
    """Repair the stored events around all hours noted since the last repair; returns the days rewritten.

    Afterwards the events of the affected regions are those of a full recompute.
    """
    late = store.replaced("late_hours", S.TARGET_HOUR)
    if late.isEmpty():
        return 0
    job = store.next_job()
    store.begin(job)
    first = first_raw_day(as_of)
    hourly = store.replaced("hourly_kpi", S.HOURLY_KPI)
    reach = [r for name in repair.KINDS if name != "status_events" for r in repair.affected_ranges(
        late, hourly, repair._closing_hours(name), first).agg(F.min("first_day"), F.max("last_day")).collect()]
    begin = min((r[0] for r in reach if r[0]), default=None)
    end = max((r[1] for r in reach if r[1]), default=None)
    rewritten = 0
    if begin is not None:
        samples = store.appended("samples", S.SAMPLE, since=begin, until=end)
        for name, closed, opened, schema, stop in (
            ("status_events", "status_events", None, S.STATUS_EVENT, "event_at"),
            ("downtime_events", "downtime_closed", "downtime_open", S.DOWNTIME_EVENT, "down_end"),
            ("latency_events", "latency_closed", "latency_open", S.LATENCY_EVENT, "slow_end"),
        ):
            # an event that starts in a region ends there too, at its last day at the latest
            stored = store.appended(closed, schema, since=begin, until=end)
            if opened:
                stored = stored.unionByName(store.replaced(opened, schema))
            kept, replaced, fresh = repair.repair(name, stored, samples, late, hourly, slow_ms=slow_ms, first_day=first)
            replaced, fresh = store.scratch(f"replaced_{name}", replaced, schema), store.scratch(f"fresh_{name}", fresh, schema)
            ended = F.col(stop).isNotNull()
            days = _days(repair.event_changes(replaced.where(ended), fresh.where(ended)), stop)
            if days:
                rows = kept.unionByName(fresh).where(ended & F.to_date(stop).cast("string").isin(days))
                store.stage_days(closed, rows, stop, days, job)
                rewritten += len(days)
            if opened:
                store.stage_replace(opened, kept.unionByName(fresh).where(~ended), job)
    store.stage_replace("late_hours", late.limit(0), job)
    store.commit()
    return rewritten


# ---------------------------------------------------------------- minutes instead of samples

def normalize(store: Store, as_of: datetime, slow_ms=S.SLOW_MS) -> DataFrame:
    """Rebuild the stored KPI and error rows from minutes, for the days whose samples are all kept.

    Rows of these days are deleted and inserted in one version.  Before the first run the
    three tables are kept as a snapshot (``BEFORE_MINUTES``), which names their files and
    copies nothing.  Returns the one-row summary of the tables afterwards.
    """
    samples = store.appended("samples", S.SAMPLE, since=first_raw_day(as_of))
    ops.require_rows(samples)
    job = store.next_job()
    store.begin(job)
    minutes = kpi.minute_samples(samples, slow_ms)
    minutes = store.scratch("minutes", minutes, minutes.schema)
    first = minutes.agg(F.to_date(F.min("period_minute"))).first()[0]
    tables = {
        "hourly_kpi": (S.HOURLY_KPI, "period_hour", kpi.kpi_norm(minutes, "hour")),
        "daily_kpi": (S.DAILY_KPI, "period_start", kpi.kpi_norm(minutes, "day")),
        "daily_errors": (S.DAILY_ERROR, "period_start", kpi.daily_errors_norm(minutes)),
    }
    days = set(_days(minutes, "period_minute"))
    for table, (schema, period, rows) in tables.items():
        held = {d for d in store.replaced_days(table) if d >= first.isoformat()}
        shaped = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        store.stage_replace(table, shaped, job, day=period, days=sorted(days | held))
    store.stage_snapshot(BEFORE_MINUTES, list(tables))
    store.commit()
    return ops.rebuild_summary(minutes, *(store.replaced(t, tables[t][0]) for t in ("hourly_kpi", "daily_kpi", "daily_errors")))


# ---------------------------------------------------------------- all together

def maintain(store: Store, as_of: datetime, slow_ms=S.SLOW_MS) -> None:
    """What a batch leaves to do: amended latencies and repair; now and then compaction and vacuum."""
    amend_latency(store, slow_ms)
    repair_late(store, as_of, slow_ms)
    if store.version % COMPACT_EVERY == COMPACT_EVERY - 1:
        store.compact(APPENDED, as_of.date())
        store.vacuum()
