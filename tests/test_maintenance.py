"""Repair, amended latencies, normalisation, compaction and vacuum of stored tables."""

import json
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probewatch.operators import events, kpi, repair
from probewatch.schemas import DAILY_KPI, DURATION_METRIC, HOURLY_KPI, SAMPLE, SUCCESS_METRIC
from probewatch.streaming import ingest as stream
from probewatch.streaming import maintenance
from probewatch.streaming.store import Store
from tests.conftest import row, rows_of, when
from tests.test_slices import random_rows
from tests.test_streaming import in_order

NOW = when("23:59")
EVENTS = {"status_events": events.status_events, "downtime_events": events.downtime_events, "latency_events": events.latency_events}


# ---------------------------------------------------------------- repair as a function

@pytest.mark.parametrize("seed, share", [(1, 0.02), (2, 0.2), (3, 0.6)])
def test_repaired_events_equal_a_recompute(samples, seed, share):
    rng = random.Random(seed)
    rows = random_rows(seed + 40, 500)
    late = [rng.random() < share for _ in rows]
    everything = samples(*rows)
    stored = samples(*[r for r, x in zip(rows, late) if not x])
    came = samples(*[r for r, x in zip(rows, late) if x])
    hourly = kpi.kpi_raw(everything, "hour")
    for name, compute in EVENTS.items():
        got = repair.repair_events(name, compute(stored), everything, repair.hours_of(came), hourly)
        want = compute(everything)
        assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


def test_repair_reads_only_around_late_hours(samples):
    """Two late samples in a day of hourly recoveries leave all other hours unread."""
    rows = [row(when("00:00") + timedelta(minutes=10 * k), 0 if k % 6 == 2 else 1, 10) for k in range(144)]
    late = [row("05:21", 0, 10), row("12:45", 1, 10)]
    everything = samples(*rows, *late)
    ranges = repair.affected_ranges(repair.hours_of(samples(*late)), kpi.kpi_raw(everything, "hour"), F.col("up_probes") > 0)
    assert [(r.from_hour.hour, r.until_hour.hour) for r in ranges.orderBy("from_hour").collect()] == [(4, 6), (11, 13)]
    exact, inside = repair.regions(everything, ranges, F.col("is_up") == 1)
    assert exact.count() == 2 and inside.count() < 20


def test_repair_without_late_rows_keeps_everything(samples):
    rows = samples(row("10:00", 0), row("10:01", 1))
    nothing = repair.hours_of(rows.limit(0))
    got = repair.repair_events("downtime_events", events.downtime_events(rows), rows, nothing, kpi.kpi_raw(rows, "hour"))
    assert got.count() == 1


def test_regions_before_the_kept_days_stay(samples):
    """An incident whose beginning is no longer among the samples is not cut."""
    raw = [row(when("01:00"), 0), row(when("02:00"), 1)]
    before = [row(when("23:00", day=9), 1), row(when("23:30", day=9), 0)]
    stored = events.downtime_events(samples(*before, *raw))
    late = samples(row("01:30", 0))
    hourly = kpi.kpi_raw(samples(*before, *raw, row("01:30", 0)), "hour")
    got = repair.repair_events("downtime_events", stored, samples(*raw, row("01:30", 0)), repair.hours_of(late), hourly,
                               first_day=when("00:00").date())
    assert [(r.down_start.day, r.down_samples) for r in got.collect()] == [(9, 2)]


# ---------------------------------------------------------------- jobs in the store

def fill(spark, path, rows, late):
    """Rows in two batches, then the late ones."""
    store = Store(spark, str(path))
    first = sorted((r for r, x in zip(rows, late) if not x), key=lambda r: r[0])
    half = len(first) // 2
    parts = [first[:half], first[half:], [r for r, x in zip(rows, late) if x]]
    for k, part in enumerate(parts):
        stream.ingest_batch(store, spark.createDataFrame(part, SAMPLE), k, NOW)
    return store


COMPARED = {
    "status_events": ["target_name", "event_at", "previous_is_up", "current_is_up"],
    "downtime_events": ["target_name", "down_start", "down_end", "last_down_at", "down_samples", "max_latency_ms", "last_error_text"],
    "latency_events": ["target_name", "slow_start", "slow_end", "last_slow_at", "slow_samples", "latency_ms_sum", "max_latency_ms"],
}


def test_batches_late_rows_and_repair_equal_a_recompute(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    rows = in_order(31, 200)
    late = [rng.random() < 0.1 for _ in rows]
    store = fill(spark, tmp_path / "s", rows, late)
    everything = spark.createDataFrame(rows, SAMPLE)

    def stored(name):
        return rows_of(stream.tables(Store(spark, str(tmp_path / "s")), NOW)[name], *COMPARED[name])

    stale = {name: stored(name) for name in COMPARED}
    assert any(stale[name] != rows_of(EVENTS[name](everything), *COMPARED[name]) for name in COMPARED)
    # a failure at any step leaves the version before it
    for step in ("stage_days", "stage_replace", "commit"):
        with monkeypatch.context() as m:
            m.setattr(Store, step, lambda *_, **__: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                maintenance.repair_late(store, NOW)
        assert {name: stored(name) for name in COMPARED} == stale
    assert maintenance.repair_late(store, NOW) > 0
    for name in COMPARED:
        assert stored(name) == rows_of(EVENTS[name](everything), *COMPARED[name])
    assert maintenance.repair_late(store, NOW) == 0
    # batches go on from the repaired state
    more = [row(NOW - timedelta(seconds=5), 0, 20, "e", "a"), row(NOW - timedelta(seconds=1), 1, 20, None, "a")]
    stream.ingest_batch(store, spark.createDataFrame(more, SAMPLE), 3, NOW)
    everything = spark.createDataFrame(rows + more, SAMPLE)
    assert stored("downtime_events") == rows_of(events.downtime_events(everything), *COMPARED["downtime_events"])


def test_normalisation_replaces_full_days_in_one_version(spark, tmp_path, monkeypatch):
    start = when("10:00")
    old = [row(start - timedelta(days=40) + timedelta(seconds=20 * k), k % 4 > 0, 10) for k in range(9)]
    new = [row(start + timedelta(seconds=20 * k), k % 4 > 0, 10, None if k % 4 else "e") for k in range(9)]
    rows = [r[:9] + (int(r[9]),) + r[10:] for r in old + new]
    store = Store(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="no raw samples"):
        maintenance.normalize(store, NOW)
    stream.ingest_batch(store, spark.createDataFrame(rows[:9], SAMPLE), 0, NOW - timedelta(days=40))
    stream.ingest_batch(store, spark.createDataFrame(rows[9:], SAMPLE), 1, NOW)
    everything = spark.createDataFrame(rows, SAMPLE)
    recent = everything.where(F.col("checked_at") > F.lit(start - timedelta(days=1)))
    by_samples = rows_of(kpi.kpi_raw(everything, "day"), "period_start", "probes", "up_probes")

    def daily(df):
        return rows_of(df, "period_start", "probes", "up_probes")

    for step in ("stage_replace", "stage_snapshot", "commit"):
        with monkeypatch.context() as m:
            m.setattr(Store, step, lambda *_, **__: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                maintenance.normalize(store, NOW)
        assert daily(Store(spark, str(tmp_path / "s")).replaced("daily_kpi", DAILY_KPI)) == by_samples
    summary = maintenance.normalize(store, NOW).first()
    old_days = kpi.kpi_raw(everything.where(F.col("checked_at") < F.lit(start - timedelta(days=1))), "day")
    expected = sorted(daily(old_days) + daily(kpi.kpi_norm(kpi.minute_samples(recent), "day")), key=str)
    assert daily(store.replaced("daily_kpi", DAILY_KPI)) == expected
    assert summary.normalized_minute_samples == 3 and summary.daily_kpi_rows == 2
    # the snapshot keeps what was there before the first run, through later runs and a vacuum
    maintenance.normalize(store, NOW)
    for k in range(3):
        stream.ingest_batch(store, spark.createDataFrame(rows[9:], SAMPLE), 2 + k, NOW)
    assert store.vacuum(keep_versions=0) > 0
    reader = Store(spark, str(tmp_path / "s"))
    assert daily(reader.snapshot(maintenance.BEFORE_MINUTES, "daily_kpi", DAILY_KPI)) == by_samples
    assert reader.snapshot(maintenance.BEFORE_MINUTES, "hourly_kpi", HOURLY_KPI).count() == 2
    assert daily(reader.replaced("daily_kpi", DAILY_KPI)) == expected


NUMBER = T.StructType([T.StructField("at", T.DateType()), T.StructField("n", T.LongType())])


def test_many_small_batches_leave_few_directories(spark, tmp_path, monkeypatch):
    root = tmp_path / "s"
    store = Store(spark, str(root))
    day = when("00:00").date()
    source = spark.range(1).coalesce(1)
    for k in range(47):
        store.begin(k)
        at = F.lit(day + timedelta(days=k // 15))
        store.stage_append("log", source.select(at.alias("at"), F.lit(k).cast("long").alias("n")), "at", k)
        store.stage_replace("state", source.select(at.alias("at"), F.lit(k).cast("long").alias("n")), k)
        store.commit(k)
        if k == 20:
            reader = Store(spark, str(root))
            assert reader.appended("log", NUMBER).count() == 21
        if k % 9 == 8:
            store.compact({"log": NUMBER}, day + timedelta(days=k // 15), open_dirs=5)
            store.vacuum(keep_versions=3)
    old = store.appended("log", NUMBER)
    with monkeypatch.context() as m:  # a compaction that fails before its commit changes nothing
        m.setattr(Store, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.compact({"log": NUMBER}, day + timedelta(days=9))
    assert store.compact({"log": NUMBER}, day + timedelta(days=9)) >= 1
    assert sorted(r.n for r in old.collect()) == list(range(47))  # a frame read before sees its own version
    store.vacuum(keep_versions=0)
    for reader in (Store(spark, str(root)), reader, store):
        assert sorted(r.n for r in reader.appended("log", NUMBER).collect()) == list(range(47))
        assert [r.n for r in reader.replaced("state", NUMBER).collect()] == [46]
        assert reader.appended("log", NUMBER, since=day + timedelta(days=2)).count() == 17
        assert {d: len(o) for d, o in reader.directories("log").items()} == {str(day + timedelta(days=k)): 1 for k in range(4)}
    directories = [d for t in ("log", "state") for d in os.listdir(root / t)]
    assert len(directories) <= 5
    assert len([n for n in os.listdir(root / "_commits") if not n.endswith(".crc")]) <= 45
    store.commit(47, {"log": day + timedelta(days=1)})
    store.vacuum(keep_versions=0)
    assert Store(spark, str(root)).appended("log", NUMBER).count() == 32


# ---------------------------------------------------------------- durations long after their samples

@pytest.mark.parametrize("cap, order", [(3, "success first"), (5, "shuffled")])
def test_stored_tables_do_not_depend_on_the_order_of_documents(spark, tmp_path, cap, order):
    """A backlog over two days, drained with a clock that leaves the waiting time behind in each batch."""
    source = tmp_path / "in"
    source.mkdir()
    labels = {"db_name": "a", "db_type": "mysql", "env": "prod", "job": "db-port-availability", "instance": "h:1"}
    windows, files, rows = 4, [], []
    for w in range(windows):
        base = int(when("00:00").timestamp()) - 86_400 + 40_000 * w
        points = [base + 60 * i for i in range(6)]
        states = [1 if (w + i) % 5 else 0 for i in range(6)]
        seconds = [4.5 if i % 3 else 0.5 for i in range(6)]
        rows += [row(when("00:00") + timedelta(seconds=t - int(when("00:00").timestamp())), up, 1000 * s, None if up else "blackbox probe failed", "a",
                     environment="prod", host="h", port=1, instance="h:1", criticality="", team="")
                 for t, up, s in zip(points, states, seconds)]
        for metric, values in ((SUCCESS_METRIC, [[t, str(u)] for t, u in zip(points, states)]), (DURATION_METRIC, [[t, str(s)] for t, s in zip(points, seconds)])):
            doc = {"status": "success", "data": {"result": [{"metric": {"__name__": metric, **labels}, "values": values}]}}
            (source / f"{metric}-{w}.json").write_text(json.dumps(doc))
            files.append((metric != (SUCCESS_METRIC if order == "success first" else DURATION_METRIC), w, source / f"{metric}-{w}.json"))
    files.sort() if order != "shuffled" else random.Random(3).shuffle(files)
    for k, (_, _, name) in enumerate(files):
        os.utime(name, (1_700_000_000 + k, 1_700_000_000 + k))
    ticks = iter(range(10_000))
    query = stream.start_ingest(spark, str(source), str(tmp_path / "s"), str(tmp_path / "cp"), max_files_per_trigger=cap,
                                clock=lambda: NOW + timedelta(seconds=200 * next(ticks)), once=True)
    query.awaitTermination(900)
    assert query.exception() is None
    tables = stream.tables(Store(spark, str(tmp_path / "s")), NOW)
    want = spark.createDataFrame(rows, SAMPLE)
    assert rows_of(tables["samples"], *SAMPLE.fieldNames()) == rows_of(want, *SAMPLE.fieldNames())
    for name, unit in (("daily_kpi", "day"), ("hourly_kpi", "hour")):
        fresh = kpi.kpi_raw(want, unit)
        assert rows_of(tables[name], *fresh.columns) == rows_of(fresh, *fresh.columns)
    for name, columns in COMPARED.items():
        assert rows_of(tables[name], *columns) == rows_of(EVENTS[name](want), *columns)
