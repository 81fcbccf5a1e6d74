"""One registered query per operator, over the projected samples."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import inputs as I
from probewatch import schemas as S
from probewatch.functions import scalars
from probewatch.operators import alerts, events, ingest, inventory, kpi, repair, series, slices
from probewatch.operators.lineage import cut_lineage, shared_folder
from probewatch.plans import dashboards, recompute, reports
from probewatch.sources import merge_success_duration, range_window, violations
from probewatch.sources.documents import rejected_documents, samples_from_documents
from probewatch.sources.samples import stage_to_samples
from probewatch.sources.staged import read_stage, write_stage
from probewatch.streaming import maintenance, tracker
from probewatch.streaming.ingest import ingest_batch
from probewatch.streaming.store import Store

def NOW():
    return series.at(I.AS_OF)


def HIST_NOW():
    return series.at(I.HISTORY_AS_OF)


MONTH = 30 * 86_400


def plain(df: DataFrame) -> DataFrame:
    """Types that compare directly: decimals as doubles, timestamps without zone."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif f.name == "value" and isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 10)
        out.append(c.alias(f.name))
    return df.select(*out)


def _daily(spark, sf, unit="day"):
    return kpi.kpi_raw(I.samples(spark, sf), unit)


def _history_daily(spark, sf):
    return kpi.kpi_raw(I.history_samples(spark, sf), "day")


def _minutes(spark, sf):
    return kpi.minute_samples(I.samples(spark, sf))


def _incremental(spark, sf, advance, schema, end):
    """Two consecutive batches through the tracker; open and closed incidents."""
    first = I.stored_samples(spark, sf)
    second = cut_lineage(ingest.dedup_new_rows(I.batch_samples(spark, sf), first))
    before = cut_lineage(advance(spark.createDataFrame([], schema), first))
    opened, closed = tracker.split_open(before, end)
    return closed.unionByName(advance(opened, second))


def _iv(spark, sf, **labels):
    src = series.success_series(series.select_labels(I.samples(spark, sf), **labels))
    return series.instant_vector(src, I.HOURS, lookback=I.LOOKBACK)


def _dv(spark, sf):
    return series.instant_vector(series.duration_series(I.samples(spark, sf)), I.HOURS, lookback=I.LOOKBACK)


def _up_series(spark, sf):
    """Scrape success: a DOWN sample without error text counts as a failed scrape."""
    failed = (F.col("is_up") == 0) & F.col("error_text").isNull()
    return series.series(I.samples(spark, sf), F.when(failed, 0.0).otherwise(1.0))


def _writer_up(spark, sf):
    hours = I.writer_metrics(spark, sf)
    return hours.select(F.lit("writer").alias("instance"), F.col("cycle_at").alias("ts"),
                        F.when(F.col("rows_inserted_last_cycle") < 6, 0.0).otherwise(1.0).alias("value"))


def _down_condition(spark, sf):
    src = series.success_series(I.samples(spark, sf))
    vector = series.instant_vector(src, I.RULE_GRID, lookback=I.RULE_LOOKBACK)
    return series.compare(vector, "==", 0)


_RULE = {"hold_seconds": I.RULE_HOLD, "lookback": I.RULE_LOOKBACK}
_LB = {"lookback": I.LOOKBACK}
#: What a target panel's variables select.
_ONE = {"target_name": "db-2", "environment": "production", "db_type": "oracle"}


def _incremental_alerts(spark, sf):
    """Slow targets, with the rule grid evaluated in three parts one after another."""
    src = series.duration_series(I.samples(spark, sf))
    step, cuts = I.RULE_GRID.step, [0, 400, 401, I.RULE_GRID.points]
    opened, closed = None, []
    for k0, k1 in zip(cuts, cuts[1:]):
        part = series.Grid(*[series._datetime(I.RULE_GRID.origin + k * step * series.MICRO) for k in (k0, k1 - 1)], step)
        slow = series.compare(series.instant_vector(src, part, lookback=I.RULE_LOOKBACK), ">", 3)
        if opened is None:
            rows = alerts.alert_history(slow, part, I.RULE_HOLD)
        else:
            rows = alerts.advance_alerts(opened, slow, part, I.RULE_HOLD)
        rows = cut_lineage(rows)
        opened = rows.where("resolved_at is null")
        closed.append(rows.where("resolved_at is not null"))
    for rows in closed:
        opened = opened.unionByName(rows)
    return opened


def _constraint_violations(spark, sf):
    return violations(I.raw_rows_with_errors(spark, sf))


def _rebuild(spark, sf, unit):
    """Stored rows counted per sample are replaced by rows counted per minute."""
    minutes = kpi.minute_samples(I.batch_samples(spark, sf))
    stored = kpi.kpi_raw(I.stored_samples(spark, sf), unit)
    return ingest.rebuild_range(stored, kpi.kpi_norm(minutes, unit), kpi.PERIOD[unit], minutes)


def _errors_rebuild(spark, sf):
    """The first raw day has no error: its stored errors go, those of older days stay."""
    batch = I.batch_without_first_errors(spark, sf)
    minutes = kpi.minute_samples(batch)
    stored = kpi.daily_errors_raw(I.stored_samples(spark, sf))
    return ingest.rebuild_range(stored, kpi.daily_errors_norm(minutes), "period_start", minutes)


def _rejected_values(spark, sf):
    """Samples whose delivered value is no state, with the text that was delivered."""
    points = I.success_points_with_bad_values(spark, sf)
    merged = stage_to_samples(merge_success_duration(points, I.duration_points(spark, sf)))
    return violations(merged).select("checked_at", "target_name", "error_text", "reason")


def _staged(spark, sf):
    """Samples through an exchange file: an absent label comes back as the empty text."""
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    write_stage(I.samples(spark, sf).withColumn("checked_at_ms", I.MILLIS()), path)
    return stage_to_samples(read_stage(spark, path))


def _documents_to_samples(spark, sf):
    """Both metrics in documents of their own, parsed and paired."""
    return plain_samples(samples_from_documents(I.range_documents(spark, sf)))


def plain_samples(samples):
    return samples.where("is_up is not null")


def _rebuild_summary(spark, sf):
    batch, stored = I.batch_samples(spark, sf), I.stored_samples(spark, sf)
    *_, summary = recompute.normalize_kpi(
        batch, kpi.kpi_raw(stored, "hour"), kpi.kpi_raw(stored, "day"), kpi.daily_errors_raw(stored))
    return summary


def _kpi_merge(spark, sf, unit):
    stored = I.stored_samples(spark, sf)
    new_rows = ingest.dedup_new_rows(I.batch_samples(spark, sf), stored)
    return ingest.merge_kpi(kpi.kpi_raw(stored, unit), kpi.kpi_raw(new_rows, unit), kpi.PERIOD[unit])


def _errors_merge(spark, sf):
    stored = I.stored_samples(spark, sf)
    new_rows = ingest.dedup_new_rows(I.batch_samples(spark, sf), stored)
    return ingest.merge_errors(kpi.daily_errors_raw(stored), kpi.daily_errors_raw(new_rows))


def _upsert_replace(spark, sf):
    stored = kpi.kpi_raw(I.stored_samples(spark, sf), "day")
    incoming = kpi.kpi_raw(I.batch_samples(spark, sf), "day")
    return ingest.upsert_replace(stored, incoming, ["period_start", "target_name"])


def _incremental_status(spark, sf):
    stored = I.stored_samples(spark, sf)
    new_rows = ingest.dedup_new_rows(I.batch_samples(spark, sf), stored)
    last = stored.groupBy("target_name").agg(
        F.max("checked_at").alias("at"), F.max_by("is_up", "checked_at").alias("is_up"))
    return tracker.incremental_status_events(
        new_rows, last.select("target_name", F.col("at").alias("checked_at"), "is_up"))


def _drift(spark, sf):
    """Stored KPI lack the samples after the store's end."""
    return reports.kpi_drift(I.samples(spark, sf), kpi.kpi_raw(I.stored_samples(spark, sf), "day"))


_EVENTS = {"status_events": events.status_events, "downtime_events": events.downtime_events, "latency_events": events.latency_events}


def _repair(name):
    """What late samples change in the stored events of the others: replacements and deletions."""
    def run(spark, sf):
        everything = I.samples(spark, sf)
        _, replaced, fresh = repair.repair(
            name, _EVENTS[name](I.timely_samples(spark, sf)), everything, repair.hours_of(I.late_samples(spark, sf)),
            kpi.kpi_raw(everything, "hour"))
        return repair.event_changes(replaced, fresh)
    return run


def _normalized(spark, sf):
    """Daily KPI of a store that took the samples and was normalised later."""
    store = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    ingest_batch(store, I.samples(spark, sf), 0, I.AS_OF)
    maintenance.normalize(store, I.NORMALIZED_AT)
    return store.replaced("daily_kpi", S.DAILY_KPI)


def _stitched(unit):
    """History from the tiers as they are kept at its end."""
    def run(spark, sf):
        raw = I.history_samples(spark, sf)
        return reports.tiered_report_stitched(
            ingest.keep_samples(raw, HIST_NOW()), ingest.keep_hourly(kpi.kpi_raw(raw, "hour"), HIST_NOW()),
            ingest.keep_daily(kpi.kpi_raw(raw, "day"), HIST_NOW()),
            unit=unit, start=I.STITCHED_FROM, end=I.HISTORY_AS_OF, as_of=I.HISTORY_AS_OF)
    return run


def _tier(unit, weight="samples"):
    def run(spark, sf):
        samples = I.samples(spark, sf)
        return reports.tiered_report(
            samples, kpi.kpi_raw(samples, "hour"), kpi.kpi_raw(samples, "day"),
            unit=unit, start=I.START, end=I.AS_OF, as_of=I.AS_OF, weight=weight)
    return run


def _host_port(spark, sf):
    split = I.success_points(spark, sf).select(
        "instance", scalars.host_of(F.col("instance")).alias("host"),
        scalars.port_text_of(F.col("instance")).alias("port"))
    return split.groupBy("instance", "host", "port").agg(F.count(F.lit(1)).alias("samples"))


def _grades(spark, sf):
    days = kpi.availability(_daily(spark, sf), "day")
    return days.select(
        "period_start", "target_name", "availability_pct",
        scalars.grade(F.col("availability_pct"), "availability").alias("availability_grade"),
        scalars.grade(F.col("avg_latency_ms") / 1000, "latency_seconds").alias("latency_grade"),
        scalars.grade(F.col("down_probes"), "down_group").alias("down_grade"))


def _ingest_metrics(spark, sf):
    batch, stored = I.batch_samples(spark, sf), I.stored_samples(spark, sf)
    return ingest.batch_metrics(batch, ingest.dedup_new_rows(batch, stored), NOW())


def _label_values(name, **patterns):
    return lambda s, d: series.label_values(I.samples(s, d), name, **patterns)


def _on(fn, *args, **kw):
    """Run over all samples; time arguments are built when a session exists."""
    return lambda s, d: fn(I.samples(s, d), *[a() if callable(a) else a for a in args], **kw)


QUERIES = {
    # ingest and storage
    "high_water": _on(ingest.high_water),
    "raw_summary": _on(ingest.raw_summary),
    "dedup_new_rows": lambda s, d: ingest.dedup_new_rows(I.batch_with_copies(s, d), I.stored_samples(s, d)),
    "kpi_upsert_replace": _upsert_replace,
    "kpi_merge_additive": lambda s, d: _kpi_merge(s, d, "day"),
    "kpi_merge_additive_hourly": lambda s, d: _kpi_merge(s, d, "hour"),
    "errors_merge_additive": _errors_merge,
    "kpi_rebuild": lambda s, d: _rebuild(s, d, "day"),
    "kpi_rebuild_hourly": lambda s, d: _rebuild(s, d, "hour"),
    "errors_rebuild": _errors_rebuild,
    "rebuild_summary": _rebuild_summary,
    "normalized_tables": _normalized,
    "documents_to_samples": _documents_to_samples,
    "staged_samples": _staged,
    "rejected_documents": lambda s, d: rejected_documents(I.range_documents(s, d)).select("source_file", "status"),
    "rejected_values": _rejected_values,
    "retention_raw": _on(ingest.keep_samples, NOW, 10),
    "retention_hourly": lambda s, d: ingest.keep_hourly(kpi.kpi_raw(I.history_samples(s, d), "hour"), HIST_NOW()),
    "retention_daily": lambda s, d: ingest.keep_daily(_history_daily(s, d), HIST_NOW()),
    "retention_events": lambda s, d: ingest.keep_events(events.downtime_events(I.samples(s, d)), "down_end", NOW(), 10),
    "retention_status_events": lambda s, d: ingest.keep_status_events(events.status_events(I.samples(s, d)), NOW(), 10),
    "ingest_metrics": _ingest_metrics,
    # projections and filters
    "range_window": _on(range_window, "checked_at", lambda: series.at(I.BATCH_FROM), NOW),
    "host_port_split": _host_port,
    "constraint_violations": _constraint_violations,
    "label_filter": _on(series.select_labels, environment="production", db_type="postgresql|ora.*"),
    "grade": _grades,
    # joins
    "merge_success_duration": lambda s, d: merge_success_duration(I.success_points(s, d), I.duration_points(s, d)),
    "previous_sample": lambda s, d: slices.with_previous(
        I.samples(s, d), ["target_name"], "checked_at", "is_up", "previous_is_up",
    ).select("target_name", "checked_at", "is_up", "previous_is_up"),
    "target_deactivate": lambda s, d: inventory.deactivate(I.targets(s, d), I.batch_samples(s, d), NOW()),
    "missing_recent_targets": lambda s, d: inventory.missing_recent_targets(
        I.targets(s, d), I.samples(s, d), NOW(), within_seconds=3600),
    "promql_and": lambda s, d: series.vector_and(
        series.compare(_dv(s, d), ">", 3), series.compare(_iv(s, d), "==", 1)),
    "instant_vector": _iv,
    # aggregations
    "minute_samples": lambda s, d: _minutes(s, d).withColumn("latency_ms", F.round("latency_ms", 6)),
    "hourly_kpi_raw": lambda s, d: _daily(s, d, "hour"),
    "daily_kpi_raw": _daily,
    "hourly_kpi_norm": lambda s, d: kpi.kpi_norm(_minutes(s, d), "hour"),
    "daily_kpi_norm": lambda s, d: kpi.kpi_norm(_minutes(s, d), "day"),
    "daily_errors_raw": _on(kpi.daily_errors_raw),
    "daily_errors_norm": lambda s, d: kpi.daily_errors_norm(_minutes(s, d)),
    "daily_availability": lambda s, d: kpi.availability(kpi.kpi_norm(_minutes(s, d), "day"), "day"),
    "hourly_availability": lambda s, d: kpi.availability(_daily(s, d, "hour"), "hour"),
    "monthly_availability": lambda s, d: kpi.rollup_availability(_history_daily(s, d), "month"),
    "yearly_availability": lambda s, d: kpi.rollup_availability(_history_daily(s, d), "year"),
    "latest_per_target": _on(inventory.latest_per_target),
    "target_inventory": lambda s, d: inventory.target_inventory(I.targets(s, d), I.batch_samples(s, d)),
    "ingest_health": lambda s, d: inventory.ingest_health(
        I.targets(s, d), I.samples(s, d), NOW(), within_seconds=3600),
    # events
    "status_events": _on(events.status_events),
    "downtime_events": _on(events.downtime_events),
    "latency_events": _on(events.latency_events),
    "downtime_history": lambda s, d: events.downtime_history(events.downtime_events(I.samples(s, d)), NOW()),
    "latency_history": lambda s, d: events.latency_history(events.latency_events(I.samples(s, d)), NOW()),
    "incremental_status_events": _incremental_status,
    "incremental_downtime_events": lambda s, d: _incremental(s, d, tracker.advance_downtime, S.DOWNTIME_EVENT, "down_end"),
    "incremental_latency_events": lambda s, d: _incremental(s, d, tracker.advance_latency, S.LATENCY_EVENT, "slow_end"),
    "repair_events": _repair("downtime_events"),
    "repair_latency_events": _repair("latency_events"),
    "repair_status_events": _repair("status_events"),
    # time series
    "min_over_time": lambda s, d: series.over_time(series.success_series(I.samples(s, d)), "min", I.LOOKBACK, I.HOURS),
    "avg_over_time": lambda s, d: series.over_time(series.duration_series(I.samples(s, d)), "avg", I.LOOKBACK, I.HOURS),
    "sliding_availability": lambda s, d: series.over_time(
        series.success_series(I.samples(s, d)), "avg", 86_400, I.SLIDING),
    "sliding_worst_latency": lambda s, d: series.over_time(
        series.duration_series(I.samples(s, d)), "max", 6 * 3600, series.Grid(I.START, I.AS_OF, 420)),
    "availability_trend": _on(dashboards.availability_trend, I.HOURS, 86_400, step=600),
    "availability_range": _on(dashboards.availability_range, I.AS_OF, MONTH, step=3600),
    "down_minutes": _on(dashboards.down_minutes, I.AS_OF, MONTH, step=3600),
    "status_changes": _on(dashboards.status_changes, I.START, I.AS_OF),
    "absent_over_time": lambda s, d: series.absent_over_time(
        series.success_series(I.samples(s, d)), 180, series.Grid(I.START, I.AS_OF, 60)),
    "label_values_env": _label_values("environment"),
    "label_values_db_type": _label_values("db_type", environment="production"),
    "label_values_db_name": _label_values("target_name", environment=".*", db_type="mysql|oracle"),
    # alerts
    "alert_states": lambda s, d: alerts.alert_states(_down_condition(s, d), I.RULE_GRID, I.RULE_HOLD),
    "alert_history": lambda s, d: alerts.alert_history(_down_condition(s, d), I.RULE_GRID, I.RULE_HOLD),
    "incremental_alert_history": _incremental_alerts,
    "alert_port_down": _on(alerts.port_down, I.RULE_GRID, **_RULE),
    "alert_probe_slow": _on(alerts.probe_slow, I.RULE_GRID, **_RULE),
    "alert_scrape_failed": lambda s, d: alerts.scrape_failed(_up_series(s, d), I.RULE_GRID, **_RULE),
    "alert_metrics_missing": _on(alerts.metrics_missing, series.Grid(I.START, I.AS_OF, 60)),
    "alert_writer_down": lambda s, d: alerts.writer_down(_writer_up(s, d), I.RULE_GRID, **_RULE),
    "alert_cycle_failed": lambda s, d: alerts.cycle_failed(I.writer_metrics(s, d), I.RULE_GRID, **_RULE),
    "alert_ingest_stale": lambda s, d: alerts.ingest_stale(
        I.writer_metrics(s, d), I.RULE_GRID, stale_seconds=3600, **_RULE),
    "alert_backfill_behind": lambda s, d: alerts.backfill_behind(I.writer_metrics(s, d), I.RULE_GRID, **_RULE),
    # dashboards
    "dash_active_targets": _on(dashboards.active_targets, I.HOURS, **_LB),
    "dash_up_now": _on(dashboards.up_now, I.HOURS, **_LB),
    "dash_down_now": _on(dashboards.down_now, I.HOURS, window=3600),
    "dash_availability": _on(dashboards.availability, I.AS_OF, MONTH, step=3600),
    "dash_avg_latency": _on(dashboards.avg_latency, I.HOURS, **_LB),
    "dash_slow_probes": _on(dashboards.slow_probes, I.HOURS, **_LB),
    "dash_down_by_env": _on(dashboards.down_by, I.HOURS, "environment", **_LB),
    "dash_down_by_db_type": _on(dashboards.down_by, I.HOURS, "db_type", **_LB),
    "dash_availability_by_env_type": _on(dashboards.availability_by_env_type, I.AS_OF, MONTH, step=3600),
    "dash_down_trend": _on(dashboards.down_trend, I.HOURS, **_LB),
    "dash_latency_trend": _on(dashboards.latency_trend, I.HOURS, window=3600),
    "dash_current_status": _on(dashboards.current_status, series.Grid.instant(I.AS_OF), lookback=86_400),
    "dash_worst_availability": _on(dashboards.worst_availability, I.AS_OF, MONTH, step=3600),
    "dash_target_status": _on(dashboards.current_status, I.HOURS, **_LB),
    "dash_target_availability": _on(dashboards.availability_range, I.AS_OF, MONTH, step=3600, **_ONE),
    "dash_target_last_latency": _on(dashboards.last_latency, I.HOURS, **_LB),
    "dash_target_status_changes": _on(dashboards.status_changes, I.BATCH_FROM, I.AS_OF, **_ONE),
    "dash_target_timeline": _on(dashboards.timeline, I.HOURS, **_LB),
    "dash_target_latency_history": _on(dashboards.latency_history, I.HOURS, **_LB),
    "dash_target_success_history": _on(dashboards.success_history, I.HOURS, **_LB, **_ONE),
    "dash_target_down_minutes": _on(dashboards.down_minutes, I.AS_OF, MONTH, step=3600, **_ONE),
    "dash_target_metadata": _on(dashboards.target_metadata, series.Grid.instant(I.AS_OF), lookback=86_400),
    "dash_target_down_windows": _on(dashboards.down_windows, I.HOURS, **_LB),
    # reports
    "report_period_daily": lambda s, d: reports.report_period(_history_daily(s, d), "day"),
    "report_period_weekly": lambda s, d: reports.report_period(_history_daily(s, d), "week"),
    "report_period": lambda s, d: reports.report_period(_history_daily(s, d), "month", ["environment"]),
    "report_filter": lambda s, d: reports.breakdown(
        reports.report_filter(_history_daily(s, d), environment="production", team="dba|platform"), ["target_name"]),
    "sla_compliance": lambda s, d: reports.sla_compliance(_history_daily(s, d), 93.5),
    "error_budget": lambda s, d: reports.error_budget(_history_daily(s, d), 99.5),
    "yoy": lambda s, d: reports.year_over_year(_history_daily(s, d)),
    "history_coverage": lambda s, d: reports.history_coverage(
        _history_daily(s, d), F.lit(date(1995, 1, 1)), F.lit(date(2001, 8, 1)), I.targets(s, d)),
    "breakdown": lambda s, d: reports.breakdown(_history_daily(s, d), ["environment", "db_type"]),
    "incident_report": lambda s, d: reports.incident_report(
        events.downtime_events(I.samples(s, d)), series.at(I.BATCH_FROM), series.at(I.STORED_UNTIL)),
    "kpi_drift": _drift,
    "ytd": lambda s, d: reports.year_to_date(_history_daily(s, d), HIST_NOW()),
    "tiered_report_minute": _tier("minute"),
    "tiered_report_minute_weight": _tier("minute", "minutes"),
    "tiered_report": _tier("hour"),
    "tiered_report_week": _tier("week"),
    "tiered_report_stitched": _stitched("minute"),
    "tiered_report_stitched_hour": _stitched("hour"),
}
