"""Event tracking per micro-batch, with the semantics of arrival order.

Unlike the full recompute, a batch only looks at its new rows and the open
incident of each target (at most one):

* a DOWN row extends the open incident, whatever its time, or opens one; late
  rows never move a start, and count only when newer than the last DOWN row;
* the first UP row at or after the start closes it;
* an UP row without latency counts as not slow, so it closes a slow incident;
* ``first_error_text`` is the opening row's text, even when NULL.

Rows of a target are taken in time order inside a batch.  After the open
incident is closed, the rest of the batch is plain runs of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probewatch.functions.scalars import is_slow
from probewatch.operators.slices import state_runs, with_previous
from probewatch.schemas import DEC, DOWNTIME_EVENT, LABELS, LATENCY_EVENT, SLICE_SECONDS, SLOW_MS, STATUS_EVENT

BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after checking the row count; else a shuffle join
    whose skewed partitions adaptive execution splits."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def incremental_status_events(
    new_rows: DataFrame, context: DataFrame, *, slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Status changes of new rows against their predecessors.

    ``context`` (target_name, checked_at, is_up) holds stored rows that include
    the predecessor of every new row which has one in the store.
    """
    old = context.select("target_name", "checked_at", "is_up", F.lit(False).alias("_new"))
    both = new_rows.withColumn("_new", F.lit(True)).unionByName(old, allowMissingColumns=True)
    seen = with_previous(both, ["target_name"], "checked_at", "is_up", "previous_is_up",
                         slice_seconds=slice_seconds, changed_only=True)
    return seen.where("_new").select(
        *[F.col({"event_at": "checked_at", "current_is_up": "is_up"}.get(f.name, f.name)).alias(f.name)
          for f in STATUS_EVENT.fields]
    )


def _split_at_close(open_events: DataFrame, rows: DataFrame, start: str, last: str, closes: Column):
    """Tag rows with their target's open incident and the time that closes it.

    There is at most one open incident per target, so the closing times are at
    most as many as the open incidents: one size check decides both joins.
    """
    keys = open_events.select("target_name", F.col(start).alias("_start"), F.col(last).alias("_last"))
    known = keys.limit(BROADCAST_ROWS + 1).count()
    if known == 0:
        nothing = rows.select("target_name", F.lit(None).cast("timestamp").alias("_close")).where(F.lit(False))
        none = F.lit(None).cast("timestamp")
        return rows.withColumns({"_start": none, "_last": none, "_close": none}), nothing
    hint = F.broadcast if known <= BROADCAST_ROWS else (lambda df: df)
    tagged = rows.join(hint(keys), "target_name", "left")
    closing = (
        tagged.where(F.col("_start").isNotNull() & closes & (F.col("checked_at") >= F.col("_start")))
        .groupBy("target_name").agg(F.min("checked_at").alias("_close"))
    )
    return tagged.join(hint(closing), "target_name", "left"), closing


def split_open(events: DataFrame, end: str) -> tuple[DataFrame, DataFrame]:
    return events.where(F.col(end).isNull()), events.where(F.col(end).isNotNull())


def _cast(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


_before_close = "_start IS NOT NULL AND (_close IS NULL OR checked_at < _close)"
_after_close = "_start IS NULL OR checked_at > _close"


def _labels_or_own() -> list[Column]:
    own = F.struct(*LABELS)
    chosen = F.coalesce(F.col("_x.labels"), own)
    return [chosen[c].alias(c) for c in LABELS]


def advance_downtime(
    open_events: DataFrame, new_rows: DataFrame, *, slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Downtime incidents after one batch: the open ones, and those it closed."""
    at = F.col("checked_at")
    tagged, closing = _split_at_close(open_events, new_rows, "down_start", "last_down_at", F.col("is_up") == 1)
    error_at = F.when(F.col("error_text").isNotNull(), at)
    more = (
        tagged.where(_before_close).where(F.col("is_up") == 0).groupBy("target_name")
        .agg(F.struct(
            F.max(at).alias("last"), F.count_if(at > F.col("_last")).alias("n"),
            F.max_by(F.struct(*LABELS), at).alias("labels"),
            F.max_by("error_text", error_at).alias("error"), F.max("latency_ms").alias("peak"),
        ).alias("_x"))
    )
    known = open_events.join(more, "target_name", "left").join(closing, "target_name", "left").select(
        "target_name", "down_start", F.col("_close").alias("down_end"),
        F.greatest("last_down_at", "_x.last").alias("last_down_at"), *_labels_or_own(),
        (F.col("down_samples") + F.coalesce("_x.n", F.lit(0))).alias("down_samples"),
        "first_error_text", F.coalesce("_x.error", "last_error_text").alias("last_error_text"),
        F.greatest("max_latency_ms", "_x.peak").alias("max_latency_ms"),
    )
    state = F.col("_state")
    runs = state_runs(
        tagged.where(_after_close), ["target_name"], "checked_at",
        state=F.col("is_up"), wanted=state == 0, closes=state == 1, slice_seconds=slice_seconds,
        local={
            "labels": F.max_by(F.struct(*LABELS), "checked_at"), "labels_at": F.max("checked_at"),
            "n": F.count(F.lit(1)), "peak": F.max("latency_ms"),
            "e1": F.min_by(F.struct("error_text"), "checked_at"), "e1_at": F.min("checked_at"),
            "e2": F.max_by("error_text", error_at), "e2_at": F.max(error_at),
        },
        merged={
            "labels": F.max_by("labels", "labels_at"), "down_samples": F.sum("n"),
            "max_latency_ms": F.max("peak"), "first_error_text": F.min_by("e1", "e1_at")["error_text"],
            "last_error_text": F.max_by("e2", "e2_at"),
        },
    )
    fresh = runs.select(
        "target_name", F.col("run_start").alias("down_start"), F.col("run_end").alias("down_end"),
        F.col("run_last").alias("last_down_at"), "labels.*",
        "down_samples", "first_error_text", "last_error_text", "max_latency_ms",
    )
    return _cast(known, DOWNTIME_EVENT).unionByName(_cast(fresh, DOWNTIME_EVENT))


def advance_latency(
    open_events: DataFrame, new_rows: DataFrame, threshold_ms=SLOW_MS, *,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Slow-latency incidents after one batch: the open ones, and those it closed.

    Open incidents of another threshold are not extended, but a row that is
    not slow closes them as well.
    """
    at = F.col("checked_at")
    rows = new_rows.withColumn("_slow", F.coalesce(is_slow(threshold_ms), F.lit(False)))
    same = open_events.where(F.col("threshold_ms") == F.lit(threshold_ms).cast(DEC))
    other = open_events.where(F.col("threshold_ms") != F.lit(threshold_ms).cast(DEC))
    tagged, closing = _split_at_close(same, rows, "slow_start", "last_slow_at", ~F.col("_slow"))
    newer = F.when(at > F.col("_last"), F.col("latency_ms"))
    more = (
        tagged.where(_before_close).where("_slow").groupBy("target_name")
        .agg(F.struct(
            F.max(at).alias("last"), F.max_by(F.struct(*LABELS), at).alias("labels"),
            F.count(newer).alias("n"), F.sum(newer).alias("total"), F.max("latency_ms").alias("peak"),
        ).alias("_x"))
    )

    def plus(column, part):
        return (F.col(column) + F.coalesce(part, F.lit(0))).alias(column)

    known = same.join(more, "target_name", "left").join(closing, "target_name", "left").select(
        "target_name", "slow_start", F.col("_close").alias("slow_end"),
        F.greatest("last_slow_at", "_x.last").alias("last_slow_at"), "threshold_ms", *_labels_or_own(),
        plus("slow_samples", "_x.n"), plus("latency_ms_sum", "_x.total"),
        plus("latency_ms_count", "_x.n"), F.greatest("max_latency_ms", "_x.peak").alias("max_latency_ms"),
    )
    state = F.col("_state")
    runs = state_runs(
        tagged.where(_after_close), ["target_name"], "checked_at",
        state=F.col("_slow"), wanted=state, closes=~state, slice_seconds=slice_seconds,
        local={
            "labels": F.max_by(F.struct(*LABELS), "checked_at"), "labels_at": F.max("checked_at"),
            "n": F.count(F.lit(1)), "total": F.sum("latency_ms"), "peak": F.max("latency_ms"),
        },
        merged={
            "labels": F.max_by("labels", "labels_at"), "slow_samples": F.sum("n"),
            "latency_ms_sum": F.sum("total"), "max_latency_ms": F.max("peak"),
        },
    )
    fresh = runs.select(
        "target_name", F.col("run_start").alias("slow_start"), F.col("run_end").alias("slow_end"),
        F.col("run_last").alias("last_slow_at"), F.lit(threshold_ms).alias("threshold_ms"), "labels.*",
        "slow_samples", "latency_ms_sum", F.col("slow_samples").alias("latency_ms_count"),
        "max_latency_ms",
    )
    if other.isEmpty():
        return _cast(known, LATENCY_EVENT).unionByName(_cast(fresh, LATENCY_EVENT))
    ended = (
        rows.where(~F.col("_slow")).join(broadcast_if_small(
            other.select("target_name", "threshold_ms", "slow_start")), "target_name")
        .where(at >= F.col("slow_start"))
        .groupBy("target_name", "threshold_ms").agg(F.min(at).alias("_close"))
    )
    others = (
        other.join(ended, ["target_name", "threshold_ms"], "left")
        .withColumn("slow_end", F.col("_close")).drop("_close")
    )
    merged = _cast(known, LATENCY_EVENT).unionByName(_cast(others, LATENCY_EVENT))
    return merged.unionByName(_cast(fresh, LATENCY_EVENT))
