"""Dashboard panels as compositions of the time-series operators.

Every panel takes probe samples and a grid (``Grid.instant`` for a single
value) or a selected range.  Label patterns are passed on as keyword arguments
(``environment=``, ``db_type=``, ``target_name=``).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probewatch.functions.scalars import grade, state_text
from probewatch.operators.series import (
    Grid, aggregate, at, changes, compare, duration_series, instant_vector, merge_equal, over_time,
    scale, select_labels, subquery, subquery_over_time, success_series, vector_and,
)
from probewatch.schemas import GRID_STEP_SECONDS, LOOKBACK_SECONDS

SLOW_SECONDS = 3


def _success(samples, grid, lookback, labels):
    return instant_vector(success_series(select_labels(samples, **labels)), grid, lookback=lookback)


def _duration(samples, grid, lookback, labels):
    return instant_vector(duration_series(select_labels(samples, **labels)), grid, lookback=lookback)


def active_targets(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    return aggregate(_success(samples, grid, lookback, labels), "count")


def up_now(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    return aggregate(_success(samples, grid, lookback, labels), "sum")


def down_now(samples: DataFrame, grid: Grid, *, window: int = 60, **labels) -> DataFrame:
    """DOWN targets by the minimum of the last minute."""
    worst = over_time(success_series(select_labels(samples, **labels)), "min", window, grid)
    down = aggregate(compare(worst, "==", 0, as_bool=True), "sum")
    return down.withColumn("grade", grade(F.col("value"), "down_now"))


def _availability(samples, end: datetime, range_seconds: int, step: int, labels) -> DataFrame:
    inner = Grid.aligned(end - timedelta(seconds=range_seconds), end, step)
    worst = over_time(success_series(select_labels(samples, **labels)), "min", step, inner)
    return subquery(worst, "avg", at(end))


def availability_range(samples: DataFrame, end: datetime, range_seconds: int = 86_400, *,
                       step: int = GRID_STEP_SECONDS, **labels) -> DataFrame:
    """Percentage of grid points of the range on which each target was up."""
    return scale(_availability(samples, end, range_seconds, step, labels), 100)


def availability_trend(samples: DataFrame, grid: Grid, range_seconds: int = 86_400, *,
                       step: int = GRID_STEP_SECONDS, **labels) -> DataFrame:
    """``availability_range`` at each point of a grid, over the range before it."""
    inner = Grid.aligned(grid.start - timedelta(seconds=range_seconds), grid.end, step)
    worst = over_time(success_series(select_labels(samples, **labels)), "min", step, inner)
    return scale(subquery_over_time(worst, "avg", range_seconds, grid), 100)


def availability(samples: DataFrame, end: datetime, range_seconds: int = 86_400, *,
                 step: int = GRID_STEP_SECONDS, **labels) -> DataFrame:
    """Mean over targets of their availability."""
    mean = scale(aggregate(_availability(samples, end, range_seconds, step, labels), "avg"), 100)
    return mean.withColumn("grade", grade(F.col("value"), "availability"))


def avg_latency(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    """Mean latency in seconds over targets that are up."""
    up = compare(_success(samples, grid, lookback, labels), "==", 1)
    mean = aggregate(vector_and(_duration(samples, grid, lookback, labels), up), "avg")
    return mean.withColumn("grade", grade(F.col("value"), "latency_seconds"))


def slow_probes(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    slow = compare(_duration(samples, grid, lookback, labels), ">", SLOW_SECONDS, as_bool=True)
    up = compare(_success(samples, grid, lookback, labels), "==", 1)
    return aggregate(vector_and(slow, up), "sum").withColumn("grade", grade(F.col("value"), "slow_now"))


def down_by(samples: DataFrame, grid: Grid, by: str, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    """DOWN targets per environment or database type, by their newest sample."""
    down = compare(_success(samples, grid, lookback, labels), "==", 0, as_bool=True)
    return aggregate(down, "sum", [by]).withColumn("grade", grade(F.col("value"), "down_group"))


def availability_by_env_type(samples: DataFrame, end: datetime, range_seconds: int = 86_400, *,
                             step: int = GRID_STEP_SECONDS, **labels) -> DataFrame:
    mean = aggregate(_availability(samples, end, range_seconds, step, labels), "avg", ["environment", "db_type"])
    return scale(mean, 100).withColumn("grade", grade(F.col("value"), "availability"))


def down_trend(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    return aggregate(compare(_success(samples, grid, lookback, labels), "==", 0, as_bool=True), "sum")


def latency_trend(samples: DataFrame, grid: Grid, *, window: int = 60, **labels) -> DataFrame:
    """Mean latency per environment and database type over targets that were up."""
    chosen = select_labels(samples, **labels)
    latency = over_time(duration_series(chosen), "avg", window, grid)
    up = compare(over_time(success_series(chosen), "min", window, grid), "==", 1)
    return aggregate(vector_and(latency, up), "avg", ["environment", "db_type"])


def current_status(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    return _success(samples, grid, lookback, labels).withColumn("status", state_text(F.col("value")))


def worst_availability(samples: DataFrame, end: datetime, range_seconds: int = 86_400, *,
                       step: int = GRID_STEP_SECONDS, limit: int | None = None, **labels) -> DataFrame:
    """Targets by ascending availability; ``limit`` is the table's row count, if any."""
    ranked = availability_range(samples, end, range_seconds, step=step, **labels)
    ranked = ranked.withColumn("grade", grade(F.col("value"), "availability"))
    ranked = ranked.orderBy("value", "target_name", "instance")
    return ranked.limit(limit) if limit is not None else ranked


def last_latency(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    vector = _duration(samples, grid, lookback, labels)
    return vector.withColumn("grade", grade(F.col("value"), "latency_seconds"))


def status_changes(samples: DataFrame, after: datetime, end: datetime, **labels) -> DataFrame:
    return changes(success_series(select_labels(samples, **labels)), after, end)


def timeline(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    """UP/DOWN intervals: neighbouring equal grid values merged."""
    merged = merge_equal(_success(samples, grid, lookback, labels))
    return merged.withColumn("status", state_text(F.col("value")))


def latency_history(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    return _duration(samples, grid, lookback, labels)


def success_history(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    return _success(samples, grid, lookback, labels)


def down_minutes(samples: DataFrame, end: datetime, range_seconds: int = 86_400, *,
                 step: int = GRID_STEP_SECONDS, **labels) -> DataFrame:
    """Grid points of the range on which the target was down."""
    inner = Grid.aligned(end - timedelta(seconds=range_seconds), end, step)
    worst = over_time(success_series(select_labels(samples, **labels)), "min", step, inner)
    return subquery(compare(worst, "==", 0, as_bool=True), "sum", at(end))


def target_metadata(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    return _success(samples, grid, lookback, labels).drop("value")


def down_windows(samples: DataFrame, grid: Grid, *, lookback=LOOKBACK_SECONDS, **labels) -> DataFrame:
    """1 where the target was down at the grid point, 0 where it was up."""
    return compare(_success(samples, grid, lookback, labels), "==", 0, as_bool=True)
