import json
import os
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from probewatch.operators import events, kpi
from probewatch.plans import recompute
from probewatch.schemas import DURATION_METRIC, SAMPLE, SUCCESS_METRIC
from probewatch.streaming import ingest as stream
from probewatch.streaming.store import Store
from tests.conftest import row, rows_of, when
from tests.test_slices import random_rows

NOW = when("23:59")


def in_order(seed=21, n=240):
    """Rows with latency everywhere, so that both modes agree."""
    return [r[:10] + (r[10] if r[10] is not None else Decimal(20),) + r[11:] for r in random_rows(seed, n)]


def compare(store, samples_df):
    tables = stream.tables(store, NOW)
    assert rows_of(tables["daily_kpi"], *tables["daily_kpi"].columns) == rows_of(
        kpi.kpi_raw(samples_df, "day"), *tables["daily_kpi"].columns)
    assert rows_of(tables["hourly_kpi"], *tables["hourly_kpi"].columns) == rows_of(
        kpi.kpi_raw(samples_df, "hour"), *tables["hourly_kpi"].columns)
    assert rows_of(tables["daily_errors"], *tables["daily_errors"].columns) == rows_of(
        kpi.daily_errors_raw(samples_df), *tables["daily_errors"].columns)
    return tables


def split(rows, parts):
    rows = sorted(rows, key=lambda r: r[0])
    size = -(-len(rows) // parts)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def test_micro_batches_equal_batch_recompute(spark, tmp_path):
    rows = in_order()
    store = Store(spark, str(tmp_path / "s"))
    parts = split(rows, 3)
    for i, part in enumerate(parts):
        overlap = parts[i - 1][-20:] if i else []
        stream.ingest_batch(store, spark.createDataFrame(overlap + part, SAMPLE), i, NOW)
    everything = spark.createDataFrame(rows, SAMPLE)
    tables = compare(store, everything)
    assert rows_of(tables["samples"], *SAMPLE.fieldNames()) == rows_of(everything, *SAMPLE.fieldNames())
    for name, fresh in (("status_events", events.status_events(everything)),):
        assert rows_of(tables[name], *fresh.columns) == rows_of(fresh, *fresh.columns)
    down = ["target_name", "down_start", "down_end", "last_down_at", "down_samples", "max_latency_ms", "last_error_text"]
    assert rows_of(tables["downtime_events"], *down) == rows_of(events.downtime_events(everything), *down)
    slow = ["target_name", "slow_start", "slow_end", "last_slow_at", "slow_samples", "latency_ms_sum", "max_latency_ms"]
    assert rows_of(tables["latency_events"], *slow) == rows_of(events.latency_events(everything), *slow)
    open_per_target = tables["downtime_events"].where("down_end IS NULL").groupBy("target_name").count()
    assert open_per_target.where("count > 1").isEmpty()
    assert tables["daily_kpi"].where("probes <> up_probes + down_probes").isEmpty()
    assert tables["ingest_metrics"].count() == 3
    recompute.register_views(tables, F.lit(NOW))
    assert spark.sql("SELECT recent_target_count FROM ingest_health").count() == 1


def test_replay_changes_nothing_and_a_broken_batch_is_invisible(spark, tmp_path):
    rows = in_order(22, 80)
    store = Store(spark, str(tmp_path / "s"))
    first, second = split(rows, 2)
    stream.ingest_batch(store, spark.createDataFrame(first, SAMPLE), 0, NOW)
    before = rows_of(stream.tables(store, NOW)["daily_kpi"], "target_name", "probes")

    def fail(*_):
        raise RuntimeError("lost")

    broken = Store(spark, str(tmp_path / "s"))
    broken.commit = fail
    with pytest.raises(RuntimeError):
        stream.ingest_batch(broken, spark.createDataFrame(second, SAMPLE), 1, NOW)
    tables = stream.tables(Store(spark, str(tmp_path / "s")), NOW)
    assert rows_of(tables["daily_kpi"], "target_name", "probes") == before
    assert tables["samples"].count() == len(first)

    for _ in range(2):  # the same batch again, then once more after its commit
        stream.ingest_batch(store, spark.createDataFrame(second, SAMPLE), 1, NOW)
    compare(store, spark.createDataFrame(rows, SAMPLE))
    stream.ingest_batch(store, spark.createDataFrame(rows, SAMPLE), 2, NOW)  # all rows known already
    tables = compare(store, spark.createDataFrame(rows, SAMPLE))
    inserted = tables["ingest_metrics"].orderBy("rows_inserted_last_cycle").first()
    assert inserted.rows_inserted_last_cycle == 0


def test_late_rows_find_their_stored_predecessor(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    stored = [row("08:00", 1), row("09:00", 0), row("12:00", 1)]
    stream.ingest_batch(store, spark.createDataFrame(stored, SAMPLE), 0, NOW)
    late = [row("10:00", 0), row("11:00", 1), row("07:00", 0), row("13:00", 1)]
    stream.ingest_batch(store, spark.createDataFrame(late, SAMPLE), 1, NOW)
    got = stream.tables(store, NOW)["status_events"]
    assert [(r[0].hour, r[1], r[2]) for r in
            got.orderBy("event_at").select("event_at", "previous_is_up", "current_is_up").collect()] == [
        (7, None, 0), (8, None, 1), (9, 1, 0), (11, 0, 1), (12, 0, 1)]


def test_retention_drops_old_days_and_keeps_open_incidents(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    old = [row(when("10:00"), 0), row(when("10:00"), 0, target="b"), row(when("10:01"), 1, target="b")]
    stream.ingest_batch(store, spark.createDataFrame(old, SAMPLE), 0, NOW)
    later = NOW + timedelta(days=2300)
    stream.ingest_batch(store, spark.createDataFrame([row(later, 0)], SAMPLE), 1, later)
    tables = stream.tables(store, later)
    assert tables["samples"].count() == 1 and tables["daily_kpi"].count() == 1
    assert rows_of(tables["downtime_events"], "target_name") == [("a",)]
    assert not rows_of(tables["status_events"].where("event_at < '2025-01-01'"), "target_name")


def test_rejected_rows_are_kept_apart(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    stream.ingest_batch(store, spark.createDataFrame([row("10:00", 1), row("10:01", 5)], SAMPLE), 0, NOW)
    assert stream.tables(store, NOW)["samples"].count() == 1
    assert spark.read.parquet(str(tmp_path / "s" / "rejected")).first().reason == "is_up not 0 or 1"


def test_cycles_pass_a_long_gap_in_the_source(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    start = when("00:00")
    source = spark.createDataFrame([row(start, 1), row(start + timedelta(hours=9), 0)], SAMPLE).cache()
    stream.ingest_batch(store, source.where("is_up = 1"), 0, start)
    now = start + timedelta(hours=10)
    assert stream.ingest_cycle(store, source, now) == 4 * 3600  # six windows without a sample
    assert stream.ingest_cycle(store, source, now) == 0
    assert stream.tables(store, now)["samples"].count() == 2


def test_failed_cycle_is_recorded(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    stream.ingest_batch(store, spark.createDataFrame([row("10:00", 1)], SAMPLE), 0, when("10:01"))
    stream.record_failure(store, when("10:05"))
    got = stream.tables(store, NOW)["ingest_metrics"].orderBy("cycle_at").collect()
    assert [r.cycle_success for r in got] == [1, 0]
    assert {r.last_success_timestamp_seconds for r in got} == {int(when("10:01").timestamp())}


def test_stream_of_documents(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    base = int(when("10:00").timestamp())
    labels = {"db_name": "a", "db_type": "mysql", "env": "prod", "job": "db-port-availability", "instance": "h:1"}
    for w in range(8):  # one file per window, each overlapping the one before
        points = [base + 60 * i for i in range(max(0, 5 * w - 2), 5 * w + 5)]
        up = [[t, "0" if (t - base) // 60 % 7 == 0 else "1"] for t in points]
        took = [[t, "0.5"] for t in points]
        doc = {"status": "success", "data": {"result": [
            {"metric": {"__name__": SUCCESS_METRIC, **labels}, "values": up},
            {"metric": {"__name__": DURATION_METRIC, **labels}, "values": took}]}}
        (source / f"w{w}.json").write_text(json.dumps(doc))
    (source / "bad.json").write_text('{"status": "error"}')
    query = stream.start_ingest(spark, str(source), str(tmp_path / "s"), str(tmp_path / "cp"),
                                clock=lambda: NOW, once=True)
    query.awaitTermination(600)
    assert query.exception() is None
    store = Store(spark, str(tmp_path / "s"))
    assert store.committed == 1  # 9 files, at most 6 per batch
    assert spark.read.parquet(str(tmp_path / "s" / "rejected_documents")).first().status == "error"
    tables = stream.tables(store, NOW)
    assert tables["samples"].count() == 40
    assert tables["downtime_events"].count() == 6


@pytest.mark.parametrize("cap, durations_first", [(1, True), (3, False), (8, False)])
def test_documents_of_a_window_may_arrive_apart(spark, tmp_path, cap, durations_first):
    source = tmp_path / "in"
    source.mkdir()
    base = int(when("10:00").timestamp())
    labels = {"db_name": "a", "db_type": "mysql", "env": "prod", "job": "db-port-availability", "instance": "h:1"}
    for w in range(3):
        points = [base + 60 * i for i in range(5 * w, 5 * w + 5)]
        bad = {0: ["NaN", "1"], 1: ["x", "1"], 2: ["1"]}[w]  # the last point of a window is malformed
        values = [[t, "1"] for t in points[:4]] + [[points[4], *bad[:1]] if w < 2 else [points[4]]]
        for k, (metric, rows) in enumerate([(SUCCESS_METRIC, values), (DURATION_METRIC, [[t, "4.5"] for t in points])]):
            doc = {"status": "success", "data": {"result": [{"metric": {"__name__": metric, **labels}, "values": rows}]}}
            name = source / f"{metric}-{w}.json"
            name.write_text(json.dumps(doc))
            order = base + (w * 2 + (1 - k if durations_first else k))
            os.utime(name, (order, order))
    query = stream.start_ingest(spark, str(source), str(tmp_path / "s"), str(tmp_path / "cp"), clock=lambda: NOW,
                                once=True, max_files_per_trigger=cap)
    query.awaitTermination(600)
    assert query.exception() is None
    tables = stream.tables(Store(spark, str(tmp_path / "s")), NOW)
    assert tables["samples"].where("latency_ms = 4500 and is_up = 1").count() == tables["samples"].count() == 12
    assert [r.slow_samples for r in tables["latency_events"].collect()] == [12]
    rejected = spark.read.parquet(str(tmp_path / "s" / "rejected"))
    assert sorted(r.error_text for r in rejected.collect()) == [
        "unreadable value: NaN", "unreadable value: none", "unreadable value: x"]


def test_a_retry_after_midnight_leaves_one_attempt(spark, tmp_path):
    batch = spark.createDataFrame([row("10:00", 1), row("10:01", 5)], SAMPLE)

    def fail(*_):
        raise RuntimeError("lost")

    broken = Store(spark, str(tmp_path / "s"))
    broken.commit = fail
    with pytest.raises(RuntimeError):
        stream.ingest_batch(broken, batch, 0, NOW)
    later = NOW + timedelta(minutes=2)
    stream.ingest_batch(Store(spark, str(tmp_path / "s")), batch, 0, later)
    store = Store(spark, str(tmp_path / "s"))
    assert stream.tables(store, later)["ingest_metrics"].count() == 1
    assert spark.read.parquet(str(tmp_path / "s" / "rejected")).count() == 1


def test_delivery_after_retention_counts_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    batch = spark.createDataFrame([row("10:00", 1)], SAMPLE)
    stream.ingest_batch(store, batch, 0, NOW)
    later = NOW + timedelta(days=40)
    stream.ingest_batch(store, batch, 1, later)
    assert [r.probes for r in stream.tables(store, later)["daily_kpi"].collect()] == [1]
    assert spark.read.parquet(str(tmp_path / "s" / "rejected")).first().reason == "too late"


def test_rebuild_without_errors_keeps_older_and_drops_stale_ones(spark, samples):
    stored = kpi.daily_errors_raw(samples(row(when("10:00", day=8), 0), row(when("10:00", day=9), 0), row("10:00", 0)))
    from probewatch.operators.ingest import rebuild_range
    quiet = kpi.minute_samples(samples(row(when("11:00", day=9), 1), row("11:00", 1)))
    left = rebuild_range(stored, kpi.daily_errors_norm(quiet), "period_start", quiet)
    assert [r.period_start.day for r in left.collect()] == [8]


def test_minutes_are_hashed(samples):
    plan = kpi.minute_samples(samples(row("10:00", 1)))._jdf.queryExecution().executedPlan().toString()
    scan_side = plan[plan.rindex("SortAggregate"):]
    assert "HashAggregate" in scan_side and plan.count("SortAggregate") == 2  # over labels, after the hashed step


def test_deduplicated_and_windowed_streams(spark, tmp_path):
    rows = [row("10:00", 1), row("10:01", 0), row("10:01", 0), row("11:00", 1), row("12:30", 1)]
    spark.createDataFrame(rows, SAMPLE).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SAMPLE).parquet(str(tmp_path / "in"))
    query = (stream.hourly_stream(stream.dedup_stream(source)).writeStream.format("memory")
             .queryName("hours").outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    query.awaitTermination(300)
    assert query.exception() is None
    got = spark.table("hours").where("period_hour < '2024-01-10 11:00:00'").collect()
    assert [(r.probes, r.up_probes, r.down_probes) for r in got] == [(2, 1, 1)]


@pytest.mark.parametrize("high, now, windows, left", [
    (0, 100_000, [(96_220, 100_000)], 0),
    (99_940, 100_000, [(99_760, 100_000)], 0),
    (100_500, 100_000, [(99_820, 100_000)], 0),
    (60_000, 100_000, [(59_820 + 3600 * i, 63_600 + 3600 * i) for i in range(6)], 18_400),
    (1, 2_000_000, [(max(704_000, 703_820 + 3600 * i), 707_600 + 3600 * i) for i in range(6)], 1_274_400),
])
def test_backfill_windows(high, now, windows, left):
    assert stream.backfill_windows(high, now) == (windows, left)


def test_normalize_replaces_from_the_first_raw_period(spark, samples):
    old = [row(when("10:00", day=9), 1), row(when("10:00:05"), 1), row(when("10:00:35"), 0)]
    stored = samples(*old)
    raw = stored.where(F.col("checked_at") >= F.lit(when("00:00")))
    hourly, daily, errors, summary = recompute.normalize_kpi(
        raw, kpi.kpi_raw(stored, "hour"), kpi.kpi_raw(stored, "day"), kpi.daily_errors_raw(stored))
    assert [tuple(r) for r in daily.orderBy("period_start").select("probes", "up_probes").collect()] == [(1, 1), (1, 0)]
    assert tuple(summary.first()) == (1, 2, 2, 1)


def test_upsert_recomputed_keeps_other_rows(samples):
    old, new = samples(row("10:00", 0), row("10:01", 1)), samples(row("11:00", 0))
    stored = {"downtime_events": events.downtime_events(old)}
    merged = recompute.upsert_recomputed(stored, {"downtime_events": events.downtime_events(new)})
    assert merged["downtime_events"].count() == 2


@pytest.mark.parametrize("backlog", [None, 90])
def test_metrics_from_counts_equal_those_from_rows(spark, samples, backlog):
    from probewatch.operators import ingest as ops
    fetched, inserted = samples(row("10:00", 1), row("10:02", 0), row("10:02", 0)), samples(row("10:02", 0))
    now = F.lit(when("10:05"))
    want = ops.batch_metrics(fetched, inserted, now, backlog).collect()
    assert ops.metrics_row(spark, now, 3, F.lit(when("10:02")), 1, backlog).collect() == want
    nothing = fetched.limit(0)
    assert ops.metrics_row(spark, now, 0, F.lit(None).cast("timestamp"), 0, backlog).collect() == ops.batch_metrics(
        nothing, nothing, now, backlog).collect()
