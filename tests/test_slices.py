"""Sliced computations against brute force, at several slice widths."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from probewatch.operators import events, ingest, kpi, series, slices
from probewatch.operators.alerts import advance_alerts, alert_history, alert_states
from probewatch.plans import dashboards, reports
from tests.conftest import row, when

WIDTHS = [1, 60, 600, 86_400]


def random_rows(seed, n=400):
    """A hot target with a third of all rows, long and short runs, missing latency."""
    rng = random.Random(seed)
    rows, clock, state = [], {}, {}
    for _ in range(n):
        target = "hot" if rng.random() < 0.34 else rng.choice("abcdef")
        clock[target] = clock.get(target, when("00:00")) + timedelta(seconds=rng.choice([7, 30, 60, 300, 4000]))
        if rng.random() < 0.3:
            state[target] = rng.choice([0, 1, 1])
        up = state.get(target, 1)
        latency = rng.choice([None, 10, 4000, 4000, 5000])
        rows.append(row(clock[target], up, latency, rng.choice([None, "e1", "e2"]) if up == 0 else None, target))
    return rows


def by_target(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


@pytest.mark.parametrize("width", WIDTHS)
def test_previous(samples, width):
    rows = random_rows(1)
    want = {(t, r[0]): (hist[i - 1][9] if i else None)
            for t, hist in by_target(rows).items() for i, r in enumerate(hist)}
    got = slices.with_previous(samples(*rows), ["target_name"], "checked_at", "is_up", "p", slice_seconds=width)
    assert {(r.target_name, r.checked_at.astimezone(when("00:00").tzinfo)): r.p for r in got.collect()} == want
    changed = slices.with_previous(samples(*rows), ["target_name"], "checked_at", "is_up", "p",
                                   slice_seconds=width, changed_only=True)
    up = {(r[1], r[0]): r[9] for r in rows}
    assert changed.count() == sum(1 for k, p in want.items() if p != up[k])


def brute_runs(rows, state_of, wanted, closes):
    out = []
    for target, hist in by_target(rows).items():
        run = None
        for i, r in enumerate(hist):
            s = state_of(r)
            if i == 0 or s != state_of(hist[i - 1]):
                run = [target, r[0], r[0], None, 0] if s == wanted else None
                if run:
                    out.append(run)
            if run is not None:
                run[2], run[4] = r[0], run[4] + 1
        for run in [o for o in out if o[0] == target]:
            later = [r[0] for r in hist if r[0] > run[2] and closes(r)]
            run[3] = min(later) if later else None
    return sorted(map(str, out))


def utc(t):
    return t and t.astimezone(when("00:00").tzinfo)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed", [2, 3])
def test_downtime_runs(samples, width, seed):
    rows = random_rows(seed)
    got = events.downtime_events(samples(*rows), slice_seconds=width).collect()
    assert sorted(str([r.target_name, utc(r.down_start), utc(r.last_down_at), utc(r.down_end), r.down_samples])
                  for r in got) == brute_runs(rows, lambda r: r[9], 0, lambda r: r[9] == 1)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed", [4, 5])
def test_latency_runs(samples, width, seed):
    rows = random_rows(seed)

    def slow(r):
        return False if r[9] == 0 else None if r[10] is None else r[10] > 3000

    got = events.latency_events(samples(*rows), slice_seconds=width).collect()
    assert sorted(str([r.target_name, utc(r.slow_start), utc(r.last_slow_at), utc(r.slow_end), r.slow_samples])
                  for r in got) == brute_runs(rows, slow, True, lambda r: slow(r) is False)


@pytest.mark.parametrize("width", WIDTHS)
def test_changes(samples, width):
    rows = random_rows(6)
    after, end = when("00:30"), when("06:00")
    want = {}
    for t, hist in by_target(rows).items():
        inside = [r[9] for r in hist if after < r[0] <= end]
        if inside:
            want[t] = float(sum(a != b for a, b in zip(inside, inside[1:])))
    got = series.changes(series.success_series(samples(*rows)), after, end, slice_seconds=width)
    assert {r.target_name: r.value for r in got.collect()} == want


@pytest.mark.parametrize("points, step, lookback", [(1, 30, 300), (50, 60, 300), (1, 420, 100), (7, 50, 70)])
def test_instant_vector(samples, points, step, lookback):
    rows = random_rows(7)
    grid = series.Grid(when("00:10"), when("05:00"), step)
    want = {}
    for t, hist in by_target(rows).items():
        for k in range(grid.points):
            at = when("00:10") + timedelta(seconds=k * step)
            seen = [r for r in hist if at - timedelta(seconds=lookback) < r[0] <= at]
            if seen:
                want[t, at] = float(seen[-1][9])
    got = series.instant_vector(series.success_series(samples(*rows)), grid, lookback=lookback, points_per_slice=points)
    assert {(r.target_name, utc(r.eval_time)): r.value for r in got.collect()} == want


@pytest.mark.parametrize("window, step", [(60, 60), (300, 60), (90, 60), (60, 300), (100, 70)])
@pytest.mark.parametrize("fn, brute", [("min", min), ("sum", sum), ("count", len),
                                       ("avg", lambda v: sum(v) / len(v)), ("max", max)])
def test_over_time(samples, window, step, fn, brute):
    rows = random_rows(8, 150)
    grid = series.Grid(when("00:10"), when("02:00"), step)
    want = {}
    for t, hist in by_target(rows).items():
        for k in range(grid.points):
            at = when("00:10") + timedelta(seconds=k * step)
            seen = [float(r[9]) for r in hist if at - timedelta(seconds=window) < r[0] <= at]
            if seen:
                want[t, at] = float(brute(seen))
    got = series.over_time(series.success_series(samples(*rows)), fn, window, grid)
    assert {(r.target_name, utc(r.eval_time)): r.value for r in got.collect()} == pytest.approx(want)


def test_alert_runs_across_slices(spark):
    rng = random.Random(9)
    grid = series.Grid(when("00:00"), when("20:00"), 30)
    points = {}
    for name in "ab":
        points[name] = sorted({k for k in range(grid.points) if rng.random() < 0.6 or 200 < k < 1000})
    rows = [(n, when("00:00") + timedelta(seconds=30 * k)) for n, ks in points.items() for k in ks]
    condition = spark.createDataFrame(rows, "target_name string, eval_time timestamp")
    want = {}
    for n, ks in points.items():
        start = None
        for i, k in enumerate(ks):
            start = k if i == 0 or ks[i - 1] != k - 1 else start
            want[n, k] = (start, "firing" if (k - start) * 30 >= 180 else "pending")
    got = alert_states(condition, grid, 180, ["target_name"]).collect()
    base = when("00:00")
    index = lambda t: int((utc(t) - base).total_seconds()) // 30
    assert {(r.target_name, index(r.eval_time)): (index(r.active_at), r.state) for r in got} == want
    history = alert_history(condition, grid, 180, ["target_name"]).collect()
    assert len(history) == len({(n, s) for (n, _), (s, _) in want.items()})
    assert sum(r.fired_at is not None for r in history) == len(
        {(n, s) for (n, _), (s, st) in want.items() if st == "firing"})


@pytest.mark.parametrize("cuts", [[0, 1, 2, 3, 300], [0, 40, 150, 300], [0, 299, 300]])
@pytest.mark.parametrize("labels", [["target_name"], []])
def test_alerts_carried_over_any_cut(spark, cuts, labels):
    rng = random.Random(len(cuts))
    start, step = when("00:00"), 30
    whole = series.Grid(start, start + timedelta(seconds=step * 299), step)
    names = "abc" if labels else "a"
    rows = [(n, start + timedelta(seconds=step * k)) for n in names for k in range(300)
            if rng.random() < 0.6 or 30 < k < 60 or n == "b" and 140 < k < 299]
    condition = spark.createDataFrame(rows, "target_name string, eval_time timestamp")
    want = alert_history(condition, whole, 100, labels)
    opened, got = spark.createDataFrame([], want.schema), []
    for a, b in zip(cuts, cuts[1:]):
        part = series.Grid(start + timedelta(seconds=step * a), start + timedelta(seconds=step * (b - 1)), step)
        inside = condition.where(F.col("eval_time").between(F.lit(part.start), F.lit(part.end)))
        found = advance_alerts(opened, inside, part, 100, labels).collect()
        opened = spark.createDataFrame([r for r in found if r.resolved_at is None], want.schema)
        got += [r for r in found if r.resolved_at is not None]
    got += opened.collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_slice_width_follows_density(spark, samples):
    dense = spark.range(40_000).select(
        F.lit("hot").alias("target_name"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") / 12).alias("checked_at"))
    assert slices.slice_seconds_for(dense, ["target_name"], "checked_at", max_rows=50_000) == 3600
    narrow = slices.slice_seconds_for(dense, ["target_name"], "checked_at", max_rows=1_000)
    assert narrow < 100


def test_no_window_over_a_whole_target_of_raw_rows(spark, samples):
    """Raw rows are only ever sorted per (target, slice)."""
    plan = events.downtime_events(samples(*random_rows(1)))._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.split("\n") if "Window [lag(checked_at" in line]
    assert sorts and all("_slice" in line for line in sorts)


@pytest.mark.parametrize("fn", ["min", "max", "sum", "count", "avg"])
@pytest.mark.parametrize("window, step", [(600, 60), (3600, 420), (1000, 70), (7200, 7200 // 5), (86_400, 600)])
def test_sliding_windows(samples, fn, window, step):
    """Long windows are put together from two pieces, over gaps and before the first and after the last sample."""
    rows = random_rows(8)
    grid = series.Grid(when("00:07") - timedelta(hours=3), when("09:00"), step)
    brute = {"min": min, "max": max, "sum": sum, "count": len, "avg": lambda v: sum(v) / len(v)}[fn]
    want = {}
    for t, hist in by_target(rows).items():
        for k in range(grid.points):
            at = grid.start + timedelta(seconds=k * step)
            values = [float(r[10]) / 1000 for r in hist if r[10] is not None and at - timedelta(seconds=window) < r[0] <= at]
            if values:
                want[t, at] = round(brute(values), 9)
    got = series.over_time(series.duration_series(samples(*rows)), fn, window, grid)
    assert {(r.target_name, utc(r.eval_time)): round(r.value, 9) for r in got.collect()} == want


def test_sliding_windows_do_not_repeat_panes(samples):
    """A day's window each minute: at most two rows for each result."""
    grid = series.Grid(when("00:00"), when("23:59"), 60)
    rows = samples(*[row(when("00:00") + timedelta(minutes=k), int(k % 7 > 0)) for k in range(1440)])
    labels = list(series.SERIES_LABELS)
    source = series.success_series(rows)
    panes = source.groupBy(*labels, F.floor((F.unix_seconds("ts") - F.lit(grid.origin // 1_000_000)) / 60).alias("_p")).agg(F.min("value").alias("a"))
    assert series._two_pieces(panes, "min", labels, 1440, 1, grid).count() <= 2 * 1440


def test_subquery_on_a_step_grid(samples):
    """Each outer window averages the inner results in its left-open range."""
    rows = random_rows(9)
    outer = series.Grid(when("01:30"), when("06:00"), 900)
    got = dashboards.availability_trend(samples(*rows), outer, 3600, step=300)
    want = {}
    for t, hist in by_target(rows).items():
        inner = {}
        for k in range(-12, 73):
            at = when("00:00") + timedelta(seconds=300 * k)
            values = [r[9] for r in hist if at - timedelta(seconds=300) < r[0] <= at]
            if values:
                inner[at] = min(values)
        for k in range(outer.points):
            at = when("01:30") + timedelta(seconds=900 * k)
            values = [v for x, v in inner.items() if at - timedelta(hours=1) < x <= at]
            if values:
                want[t, at] = round(100 * sum(values) / len(values), 9)
    assert {(r.target_name, utc(r.eval_time)): round(r.value, 9) for r in got.collect()} == want


@pytest.mark.parametrize("unit", ["minute", "hour", "day"])
def test_stitched_periods_come_from_one_tier_each(samples, unit):
    now = when("13:30")
    times = [now - timedelta(hours=h, minutes=7) for h in (0, 5, 700, 719, 721, 735, 800, 9580, 9599, 9612, 9630, 12_000)]
    raw = samples(*[row(t, 1) for t in times])
    got = reports.tiered_report_stitched(
        ingest.keep_samples(raw, F.lit(now)), ingest.keep_hourly(kpi.kpi_raw(raw, "hour"), F.lit(now)), kpi.kpi_raw(raw, "day"),
        unit=unit, start=when("00:00") - timedelta(days=500), end=now, as_of=now).collect()
    kept = {"minute": now - timedelta(days=30), "hour": now - timedelta(days=400)}
    finest = {"minute": ["minute", "hour", "day"], "hour": ["hour", "day"], "day": ["day"]}[unit]
    edge = {g: (t + timedelta(days=1)).replace(hour=0, minute=0) for g, t in kept.items()}
    want = {}
    for t in times:
        grain = next(g for g in finest if g == "day" or t >= edge[g])
        cut = t.replace(second=0) if grain == "minute" else t.replace(minute=0, second=0) if grain == "hour" else t.replace(hour=0, minute=0, second=0)
        length = {"minute": timedelta(minutes=1), "hour": timedelta(hours=1), "day": timedelta(days=1)}[grain]
        if cut + length <= now:
            want[cut, grain] = want.get((cut, grain), 0) + 1
    assert {(utc(r.period_start), r.grain): r.probes for r in got} == want
