"""Hand-written fixtures for the semantics that are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from probewatch.functions.scalars import whole_seconds_between
from probewatch.operators import events, ingest, inventory, kpi, series
from probewatch.operators.alerts import alert_states
from probewatch.schemas import DAILY_KPI, DOWNTIME_EVENT, LATENCY_EVENT, TARGET
from probewatch.sources import split_valid, violations
from probewatch.streaming import tracker
from tests.conftest import hm, row, when


def track_downtime(opened, rows):
    return tracker.split_open(tracker.advance_downtime(opened, rows), "down_end")


def track_latency(opened, rows, *threshold):
    return tracker.split_open(tracker.advance_latency(opened, rows, *threshold), "slow_end")


def at(text):
    return series.at(when(text))


def test_two_samples_in_one_minute_weigh_differently(samples):
    df = samples(row("10:00:05", 1, 100), row("10:00:35", 0))
    raw = kpi.kpi_raw(df, "day").first()
    assert (raw.probes, raw.up_probes, raw.down_probes, raw.latency_ms_count) == (2, 1, 1, 1)
    norm = kpi.kpi_norm(kpi.minute_samples(df), "day").first()
    assert (norm.probes, norm.up_probes, norm.down_probes, norm.latency_ms_count) == (1, 0, 1, 0)
    assert norm.latency_ms_sum == 0 and norm.max_latency_ms is None


def test_minute_error_text_is_first_non_null_of_down_rows(samples):
    df = samples(row("10:00:05", 1, 1, "ignored"), row("10:00:10", 0, None, None),
                 row("10:00:20", 0, None, "first"), row("10:00:30", 0, None, "second"))
    assert kpi.minute_samples(df).first().error_text == "first"
    assert kpi.minute_samples(samples(row("10:00", 0))).first().error_text == "blackbox probe failed"


def slow_rows(samples):
    return samples(row("10:00", 1, 4000), row("10:01", 1, None), row("10:02", 1, 5000), row("10:03", 1, 10))


@pytest.mark.parametrize("slice_seconds", [60, 120, 900, 86_400])
def test_null_latency_splits_but_does_not_end_a_slow_run(samples, slice_seconds):
    got = events.latency_events(slow_rows(samples), slice_seconds=slice_seconds)
    assert sorted((hm(r.slow_start), hm(r.slow_end), r.slow_samples) for r in got.collect()) == [
        ("10:00:00", "10:03:00", 1), ("10:02:00", "10:03:00", 1)]


def test_null_latency_closes_an_incremental_slow_event(spark, samples):
    empty = spark.createDataFrame([], LATENCY_EVENT)
    opened, closed = track_latency(empty, slow_rows(samples))
    assert opened.count() == 0
    assert sorted((hm(r.slow_start), hm(r.slow_end)) for r in closed.collect()) == [
        ("10:00:00", "10:01:00"), ("10:02:00", "10:03:00")]


def test_open_incident_survives_retention(samples):
    df = samples(row("10:00", 1), row("10:01", 0), row("10:02", 0))
    event = ingest.keep_events(events.downtime_events(df), "down_end", at("12:00"), 0)
    shown = events.downtime_history(event, at("10:03")).first()
    assert (shown.event_status, shown.down_end, shown.down_samples) == ("OPEN", None, 2)
    assert float(shown.duration_seconds) == 120 and float(shown.duration_minutes) == 2


def test_first_sample_down(samples):
    df = samples(row("10:00", 0))
    status = events.status_events(df).first()
    assert (status.previous_is_up, status.current_is_up) == (None, 0)
    assert hm(events.downtime_events(df).first().down_start) == "10:00:00"


def test_late_down_extends_without_counting(spark, samples):
    stored = samples(row("10:00", 0), row("10:05", 0))
    late = samples(row("10:02", 0, 7, "late"))
    opened, _ = track_downtime(spark.createDataFrame([], DOWNTIME_EVENT), stored)
    opened, closed = track_downtime(opened, late)
    event = opened.first()
    assert closed.count() == 0
    assert (hm(event.down_start), hm(event.last_down_at), event.down_samples) == ("10:00:00", "10:05:00", 2)
    assert event.last_error_text == "late" and float(event.max_latency_ms) == 7
    assert events.downtime_events(stored.unionByName(late)).first().down_samples == 3


def test_late_up_closes_before_the_last_down(spark, samples):
    stored = samples(row("10:00", 0), row("10:05", 0))
    late = samples(row("10:02", 1))
    opened, _ = track_downtime(spark.createDataFrame([], DOWNTIME_EVENT), stored)
    opened, closed = track_downtime(opened, late)
    event = closed.first()
    assert opened.count() == 0
    assert (hm(event.down_end), hm(event.last_down_at)) == ("10:02:00", "10:05:00")
    assert events.downtime_events(stored.unionByName(late)).count() == 2


def test_late_rows_before_the_start_neither_close_nor_move_it(spark, samples):
    opened, _ = track_downtime(spark.createDataFrame([], DOWNTIME_EVENT), samples(row("10:00", 0)))
    opened, closed = track_downtime(opened, samples(row("09:58", 0), row("09:59", 1)))
    event = opened.first()
    assert closed.count() == 0 and hm(event.down_start) == "10:00:00" and event.down_samples == 1


def test_one_batch_closes_and_opens_again(spark, samples):
    opened, _ = track_downtime(spark.createDataFrame([], DOWNTIME_EVENT), samples(row("10:00", 0)))
    batch = samples(row("10:01", 0, 9, "x"), row("10:02", 1), row("10:03", 0), row("10:04", 1), row("10:05", 0))
    opened, closed = track_downtime(opened, batch)
    assert sorted((hm(r.down_start), hm(r.down_end), r.down_samples, r.first_error_text, r.last_error_text)
                  for r in closed.collect()) == [
        ("10:00:00", "10:02:00", 2, None, "x"), ("10:03:00", "10:04:00", 1, None, None)]
    assert [hm(r.down_start) for r in opened.collect()] == ["10:05:00"]


def test_first_error_text_differs_between_modes(spark, samples):
    df = samples(row("10:00", 0), row("10:01", 0, None, "boom"))
    opened, _ = track_downtime(spark.createDataFrame([], DOWNTIME_EVENT), df)
    assert opened.first().first_error_text is None
    assert events.downtime_events(df).first().first_error_text == "boom"


def test_slow_event_of_another_threshold_is_closed_not_extended(spark, samples):
    opened, _ = track_latency(spark.createDataFrame([], LATENCY_EVENT), samples(row("10:00", 1, 9000)), 5000)
    opened, closed = track_latency(opened, samples(row("10:01", 1, 4000), row("10:02", 1, 1)))
    got = sorted((float(r.threshold_ms), hm(r.slow_start), hm(r.slow_end), r.slow_samples) for r in closed.collect())
    assert opened.count() == 0
    assert got == [(3000.0, "10:01:00", "10:02:00", 1), (5000.0, "10:00:00", "10:02:00", 1)]


def test_downtime_latency_includes_failed_probes(samples):
    df = samples(row("10:00", 0, 9000), row("10:01", 1, 10))
    assert float(events.downtime_events(df).first().max_latency_ms) == 9000
    assert float(kpi.kpi_raw(df, "day").first().max_latency_ms) == 10


def test_replayed_batch_adds_nothing(samples):
    df = samples(row("10:00", 1, 5), row("10:01", 0))
    assert ingest.dedup_new_rows(df, df).count() == 0
    assert ingest.dedup_new_rows(df.unionByName(df), df.limit(0)).count() == 2


def test_lowest_instance_wins(samples):
    df = samples(row("10:00", 1, instance="z:1"), row("10:00", 0, instance="b:1"))
    kept = ingest.unique_samples(df).collect()
    assert [(r.instance, r.is_up) for r in kept] == [("b:1", 0)]


def test_relabelled_target(samples):
    first, second = when("10:00"), when("10:00", day=11)
    df = samples(row(first, 1, criticality="low"), row(when("11:00"), 1, criticality="high"),
                 row(second, 1, criticality="high"))
    daily = kpi.kpi_raw(df, "day")
    assert sorted((r.period_start.day, r.criticality, r.probes) for r in daily.collect()) == [
        (10, "low", 2), (11, "high", 1)]
    assert kpi.rollup_availability(daily, "month").count() == 2


def test_merge_takes_incoming_labels_even_null(spark, samples):
    old = kpi.kpi_raw(samples(row("10:00", 1, 5, team="x")), "day")
    new = kpi.kpi_raw(samples(row("10:01", 0, None, team=None)), "day")
    merged = ingest.merge_kpi(old, new, "period_start").first()
    assert (merged.team, merged.probes, merged.up_probes, float(merged.latency_ms_sum)) == (None, 2, 1, 5.0)
    assert (hm(merged.first_probe_at), hm(merged.last_probe_at)) == ("10:00:00", "10:01:00")


def test_bad_rows_are_rejected_with_reason(samples):
    df = samples(
        row("10:00", 1), row("10:01", 1, port=70_000), row("10:02", 2), row("10:03", 1, -1),
        row("10:04", 1, target=""), row("10:05", 1, port=None))
    assert sorted(r.reason for r in violations(df).collect()) == [
        "is_up not 0 or 1", "latency_ms negative", "port is null", "port out of range", "target_name is empty"]
    valid, rejected = split_valid(df)
    assert (valid.count(), rejected.count()) == (1, 5)


def test_zero_probes_give_null_availability(spark):
    empty_day = spark.createDataFrame([], DAILY_KPI).unionByName(
        spark.range(1).select(*[
            (F.lit(0) if f.name in ("probes", "up_probes", "down_probes", "slow_probes", "latency_ms_sum",
                                    "latency_ms_count") else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in DAILY_KPI.fields]))
    shown = kpi.availability(empty_day, "day").first()
    assert shown.availability_pct is None and shown.avg_latency_ms is None


def test_absent_series(samples):
    df = samples(row("10:00", 1), row("10:10", 1))
    grid = series.Grid(when("10:00"), when("10:12"), 60)
    absent = series.absent_over_time(series.success_series(df), 180, grid)
    assert sorted(hm(r.eval_time) for r in absent.collect()) == [f"10:0{m}:00" for m in range(3, 10)]


@pytest.mark.parametrize("hold_s, states", [(180, ["pending"] * 6 + ["firing"]), (210, ["pending"] * 7)])
def test_hold_time(spark, hold_s, states):
    grid = series.Grid(when("10:00"), when("10:10"), 30)
    times = [(when("10:00").replace(minute=i // 2, second=i % 2 * 30),) for i in range(7)]
    condition = spark.createDataFrame(times, "eval_time timestamp").withColumn("target_name", F.lit("a"))
    got = alert_states(condition, grid, hold_s, ["target_name"]).orderBy("eval_time")
    assert [r.state for r in got.collect()] == states


def test_lag_is_rounded(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:01.6' AS a, timestamp'2024-01-01' AS b")
    assert df.select(whole_seconds_between(F.col("a"), F.col("b"))).first()[0] == 2


def test_first_seen_is_kept_and_is_the_newest_of_the_first_batch(spark, samples):
    none = spark.createDataFrame([], TARGET)
    first = inventory.target_inventory(none, samples(row("10:00", 1), row("10:05", 1)))
    second = inventory.target_inventory(first, samples(row("10:03", 1, team="new")))
    got = second.first()
    assert (hm(got.first_seen_at), hm(got.last_seen_at), got.team) == ("10:05:00", "10:05:00", "new")


def test_deactivation_needs_age_and_absence(spark, samples):
    none = spark.createDataFrame([], TARGET)
    targets = inventory.target_inventory(none, samples(row("10:00", 1, target="a"), row("10:00", 1, target="b")))
    later = series.at(when("11:00", day=12))
    got = inventory.deactivate(targets, samples(row("09:00", 1, target="b")), later)
    assert {r.target_name: r.is_active for r in got.collect()} == {"a": False, "b": True}


def test_raw_retention_by_instant_daily_by_date(samples):
    df = samples(row("10:00", 1), row("12:00", 1))
    edge = series.at(when("11:00", day=11))
    assert ingest.keep_samples(df, edge, 1).count() == 1
    assert ingest.keep_daily(kpi.kpi_raw(df, "day"), edge, 1).count() == 1


def test_rebuild_refuses_empty_input(samples):
    with pytest.raises(ValueError):
        ingest.require_rows(samples(row("10:00", 1)).limit(0))
