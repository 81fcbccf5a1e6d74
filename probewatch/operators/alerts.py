"""Alert evaluation: a condition must hold on every grid point for a hold time.

A condition vector is evaluated on the rule grid.  Consecutive grid points of
one label set form an activation.  It is *pending* until it has held for the
rule's hold time, then *firing*, and *resolved* at the first grid point where
the label set is missing from the condition vector.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probewatch.operators.series import (
    MICRO, POINTS_PER_SLICE, Grid, absent_over_time, compare, duration_series, eval_time,
    instant_vector, seconds_since, success_series, vector_and,
)
from probewatch.schemas import LOOKBACK_SECONDS, SERIES_LABELS


def _segments(condition: DataFrame, grid: Grid, labels: Sequence[str]) -> DataFrame:
    """Stretches of consecutive grid points per slice, with the activation's first point.

    A slice holds at most ``POINTS_PER_SLICE`` points of one label set, so the
    collected array is bounded by construction.
    """
    labels = list(labels)
    k = ((F.unix_micros("eval_time") - F.lit(grid.origin)) / (grid.step * MICRO)).cast("long")
    slices = (
        condition.withColumn("_k", k)
        .groupBy(*labels, F.floor(F.col("_k") / POINTS_PER_SLICE).alias("_slice"))
        .agg(F.array_sort(F.collect_set("_k")).alias("p"))
        .withColumn("starts", F.expr("filter(p, (x, i) -> i = 0 OR x - p[i - 1] > 1)"))
        .withColumn("ends", F.expr("filter(p, (x, i) -> i = size(p) - 1 OR p[i + 1] - x > 1)"))
        .select(*labels, "_slice", "starts", "ends",
                F.element_at("starts", 1).alias("head"),
                F.element_at("starts", -1).alias("tail"),
                F.element_at("ends", -1).alias("last"))
    )
    per_series = Window.partitionBy(*labels).orderBy("_slice")
    before = per_series.rowsBetween(Window.unboundedPreceding, -1)
    linked = (
        slices.withColumn("_prev", F.lag("last").over(per_series))
        .withColumn("linked", F.coalesce(F.col("head") - F.col("_prev") == 1, F.lit(False)))
        .withColumn("_own", F.when((F.size("starts") > 1) | ~F.col("linked"), F.col("tail")))
        .withColumn("_origin", F.last("_own", ignorenulls=True).over(before))
    )
    return linked.select(
        *labels, "linked", "_origin", F.posexplode(F.arrays_zip("starts", "ends")).alias("i", "s")
    ).select(
        *labels, F.col("s.starts").alias("k0"), F.col("s.ends").alias("k1"),
        F.when((F.col("i") == 0) & F.col("linked"), F.col("_origin"))
        .otherwise(F.col("s.starts")).alias("origin"),
    )


def alert_states(condition: DataFrame, grid: Grid, hold_seconds: int,
                 labels: Sequence[str] = SERIES_LABELS) -> DataFrame:
    """State of every active label set at every grid point."""
    rows = _segments(condition, grid, labels).select(
        *labels, "origin", F.explode(F.sequence("k0", "k1")).alias("_k")
    )
    held = (F.col("_k") - F.col("origin")) * grid.step
    return rows.select(
        *labels, eval_time(F.col("_k"), grid).alias("eval_time"),
        eval_time(F.col("origin"), grid).alias("active_at"),
        F.when(held >= hold_seconds, F.lit("firing")).otherwise(F.lit("pending")).alias("state"),
    )


def alert_history(condition: DataFrame, grid: Grid, hold_seconds: int,
                  labels: Sequence[str] = SERIES_LABELS) -> DataFrame:
    """One row per activation: when it became active, fired and was resolved."""
    labels = list(labels)
    whole = _segments(condition, grid, labels).groupBy(*labels, "origin").agg(F.max("k1").alias("k1"))
    held = (F.col("k1") - F.col("origin")) * grid.step
    return whole.select(
        *labels,
        eval_time(F.col("origin"), grid).alias("active_at"),
        eval_time(F.col("k1"), grid).alias("last_active_at"),
        F.when(held >= hold_seconds,
               eval_time(F.col("origin") + -(-hold_seconds // grid.step), grid)).alias("fired_at"),
        F.when(F.col("k1") < grid.points - 1, eval_time(F.col("k1") + 1, grid)).alias("resolved_at"),
    )


def advance_alerts(opened: DataFrame, condition: DataFrame, grid: Grid, hold_seconds: int,
                   labels: Sequence[str] = SERIES_LABELS) -> DataFrame:
    """``alert_history`` carried over the next grid points: the activations open before, and the new ones.

    ``opened`` holds those rows of the call before that are not resolved, and ``grid`` starts
    one step after its grid's end.  Only the new points are evaluated; an activation that
    goes on keeps its start.  Rows without ``resolved_at`` are the next call's ``opened``,
    the others are final.
    """
    labels = list(labels)
    ends = _segments(condition, grid, labels).groupBy(*labels, "origin").agg(F.max("k1").alias("k1"))
    key = [*labels, "_one"]  # rules without labels have one activation at most
    ends, opened = ends.withColumn("_one", F.lit(1)), opened.withColumn("_one", F.lit(1))
    first = ends.where(F.col("origin") == 0).select(*key, F.col("k1").alias("_k1"))
    resolved = lambda k: F.when(k < grid.points - 1, eval_time(k + 1, grid))
    known = opened.join(first, key, "left").select(
        *labels, "active_at", F.coalesce(eval_time(F.col("_k1"), grid), "last_active_at").alias("last_active_at"),
        F.when(F.col("_k1").isNull(), eval_time(F.lit(0), grid)).otherwise(resolved(F.col("_k1"))).alias("resolved_at"))
    begun = ends.where(F.col("origin") > 0).unionByName(ends.where(F.col("origin") == 0).join(opened.select(*key), key, "left_anti"))
    fresh = begun.select(*labels, eval_time(F.col("origin"), grid).alias("active_at"),
                         eval_time(F.col("k1"), grid).alias("last_active_at"), resolved(F.col("k1")).alias("resolved_at"))
    wait = F.make_dt_interval(secs=F.lit(-(-hold_seconds // grid.step) * grid.step))
    fires = F.col("active_at") + wait
    return known.unionByName(fresh).select(
        *labels, "active_at", "last_active_at", F.when(fires <= F.col("last_active_at"), fires).alias("fired_at"), "resolved_at")


@dataclass(frozen=True)
class Rule:
    name: str
    hold_seconds: int
    severity: str
    category: str
    team: str = "dba"
    summary: str = ""
    summary_labels: tuple[str, ...] = ()
    description: str = ""
    description_labels: tuple[str, ...] = ()
    labels: tuple[str, ...] = field(default=tuple(SERIES_LABELS))


# Names, hold times, severities, categories and texts of the four probe rules,
# hold times and severities of the four writer rules; names and texts of the latter are our own.
PORT_DOWN = Rule("DBPortDown", 180, "critical", "database",
                 summary="DB port down: %s", summary_labels=("target_name",),
                 description="Target %s tidak reachable via TCP selama lebih dari 3 menit. DB Type=%s, Env=%s.",
                 description_labels=("instance", "db_type", "environment"))
PROBE_SLOW = Rule("DBPortProbeSlow", 300, "warning", "database",
                  summary="DB port probe slow: %s", summary_labels=("target_name",),
                  description="Target %s TCP probe latency lebih dari 3 detik selama 5 menit. DB Type=%s, Env=%s.",
                  description_labels=("instance", "db_type", "environment"))
SCRAPE_FAILED = Rule("DBPortProbeScrapeFailed", 120, "critical", "monitoring",
                     summary="DB port probe scrape failed: %s", summary_labels=("target_name",),
                     description="Prometheus gagal mengambil hasil Blackbox untuk %s selama lebih dari 2 menit.",
                     description_labels=("instance",))
METRICS_MISSING = Rule("DBPortMetricsMissing", 60, "critical", "monitoring",
                       summary="All DB port probe metrics are missing", labels=(),
                       description="Seluruh metric probe_success tidak tersedia selama lebih dari 3 menit.")
WRITER_DOWN = Rule("WriterDown", 60, "critical", "ingest",
                   summary="Ingest writer is down", labels=("instance",),
                   description="The ingest writer sent no metrics for more than 1 minute.")
CYCLE_FAILED = Rule("WriterCycleFailed", 60, "critical", "ingest",
                    summary="Ingest is failing", labels=("instance",),
                    description="Ingest cycles failed for more than 1 minute.")
INGEST_STALE = Rule("WriterIngestStale", 60, "critical", "ingest",
                    summary="Ingest is stale", labels=("instance",),
                    description="No ingest cycle succeeded for more than 3 minutes.")
BACKFILL_BEHIND = Rule("WriterBackfillBehind", 300, "warning", "ingest",
                       summary="Ingest has a backfill backlog", labels=("instance",),
                       description="The ingest backlog stayed above 5 minutes for at least 5 minutes.")
SLOW_SECONDS = 3
ABSENT_WINDOW_SECONDS = 180
STALE_SECONDS = 180
BACKLOG_SECONDS = 300


def annotate(alerts: DataFrame, rule: Rule) -> DataFrame:
    """Attach the rule's name, labels and text."""
    def text(pattern, names):
        return F.format_string(pattern, *[F.col(c) for c in names]) if names else F.lit(pattern)

    return alerts.select(
        F.lit(rule.name).alias("alert_name"), F.lit(rule.severity).alias("severity"),
        F.lit(rule.category).alias("category"), F.lit(rule.team).alias("alert_team"),
        *alerts.columns, text(rule.summary, rule.summary_labels).alias("summary"),
        text(rule.description, rule.description_labels).alias("description"),
    )


def evaluate(rule: Rule, condition: DataFrame, grid: Grid, hold_seconds: int | None = None) -> DataFrame:
    hold = rule.hold_seconds if hold_seconds is None else hold_seconds
    return annotate(alert_states(condition, grid, hold, rule.labels), rule)


def port_down(samples: DataFrame, grid: Grid, *, hold_seconds=None, lookback=LOOKBACK_SECONDS) -> DataFrame:
    vector = instant_vector(success_series(samples), grid, lookback=lookback)
    return evaluate(PORT_DOWN, compare(vector, "==", 0), grid, hold_seconds)


def probe_slow(samples: DataFrame, grid: Grid, *, hold_seconds=None, lookback=LOOKBACK_SECONDS) -> DataFrame:
    slow = compare(instant_vector(duration_series(samples), grid, lookback=lookback), ">", SLOW_SECONDS)
    up = compare(instant_vector(success_series(samples), grid, lookback=lookback), "==", 1)
    return evaluate(PROBE_SLOW, vector_and(slow, up), grid, hold_seconds)


def scrape_failed(up_series: DataFrame, grid: Grid, *, hold_seconds=None, lookback=LOOKBACK_SECONDS) -> DataFrame:
    """``up_series`` has the probe labels and value 0 where a scrape failed."""
    vector = instant_vector(up_series, grid, lookback=lookback)
    return evaluate(SCRAPE_FAILED, compare(vector, "==", 0), grid, hold_seconds)


def metrics_missing(samples: DataFrame, grid: Grid, *, hold_seconds=None,
                    window: int = ABSENT_WINDOW_SECONDS) -> DataFrame:
    return evaluate(METRICS_MISSING, absent_over_time(success_series(samples), window, grid), grid, hold_seconds)


def metric_series(metrics: DataFrame, column: str, instance: str = "writer") -> DataFrame:
    """One self-metric of the ingest batches as a series."""
    return metrics.select(
        F.lit(instance).alias("instance"), F.col("cycle_at").alias("ts"),
        F.col(column).cast("double").alias("value"),
    ).where(F.col("value").isNotNull())


def _writer(metrics: DataFrame, column: str, grid: Grid, lookback: int) -> DataFrame:
    return instant_vector(metric_series(metrics, column), grid, labels=["instance"], lookback=lookback)


def writer_down(up_series: DataFrame, grid: Grid, *, hold_seconds=None, lookback=LOOKBACK_SECONDS) -> DataFrame:
    vector = instant_vector(up_series, grid, labels=["instance"], lookback=lookback)
    return evaluate(WRITER_DOWN, compare(vector, "==", 0), grid, hold_seconds)


def cycle_failed(metrics: DataFrame, grid: Grid, *, hold_seconds=None, lookback=LOOKBACK_SECONDS) -> DataFrame:
    vector = _writer(metrics, "cycle_success", grid, lookback)
    return evaluate(CYCLE_FAILED, compare(vector, "==", 0), grid, hold_seconds)


def ingest_stale(metrics: DataFrame, grid: Grid, *, hold_seconds=None, lookback=LOOKBACK_SECONDS,
                 stale_seconds: int = STALE_SECONDS) -> DataFrame:
    last = _writer(metrics, "last_success_timestamp_seconds", grid, lookback)
    old = compare(seconds_since(last), ">", stale_seconds)
    return evaluate(INGEST_STALE, vector_and(old, compare(last, ">", 0), ["instance"]), grid, hold_seconds)


def backfill_behind(metrics: DataFrame, grid: Grid, *, hold_seconds=None, lookback=LOOKBACK_SECONDS,
                    backlog_seconds: int = BACKLOG_SECONDS) -> DataFrame:
    vector = _writer(metrics, "backfill_remaining_seconds", grid, lookback)
    return evaluate(BACKFILL_BEHIND, compare(vector, ">", backlog_seconds), grid, hold_seconds)
