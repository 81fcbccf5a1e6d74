"""From flat metric samples to probe samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probewatch.functions.scalars import (
    default_error, host_of, latency_from_seconds, number_of, port_text_of, state_from_value,
    timestamp_from_ms,
)
from probewatch.schemas import SAMPLE


def rename_address(df: DataFrame) -> DataFrame:
    """The probed address is the ``instance`` label of every sample."""
    return df.withColumnRenamed("address", "instance")


def range_window(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """Rows of the left-open range ``(start, end]``; reaches the scan as a filter."""
    return df.where((F.col(ts) > start) & (F.col(ts) <= end))


def merge_success_duration(success: DataFrame, duration: DataFrame) -> DataFrame:
    """Left-join durations onto success samples; the last duration of a key wins.

    Rows without a name, an instance or a port are dropped.  Without any
    duration row every sample keeps a NULL latency.  A value that is no finite
    number gives a NULL state and keeps its text as the error, so that the row
    constraints set the sample aside; an unreadable duration counts as absent.
    """
    key = ["ts_ms", "target_name", "instance"]
    # numbers only in the buffer, so that the aggregation hashes where arrivals are numbers
    readable = duration.withColumn("value", number_of(F.col("value"))).where("value is not null")
    last = readable.groupBy(*key).agg(F.max_by("value", "arrival").alias("seconds"))
    named = success.where(
        (F.col("target_name") != "") & (F.col("instance") != "")
        & (port_text_of(F.col("instance")) != "")
    )
    state = state_from_value(F.col("value"))
    return named.join(last, key, "left").select(
        F.col("ts_ms").alias("checked_at_ms"), "target_name", "db_type", "environment",
        host_of(F.col("instance")).alias("host"),
        F.expr("try_cast(regexp_extract(instance, ':([0-9]+)$', 1) AS int)").alias("port"),
        "instance", "criticality", "team",
        state.alias("is_up"),
        latency_from_seconds(F.col("seconds").cast("string")).alias("latency_ms"),
        F.when(state.isNull(), F.concat(F.lit("unreadable value: "), F.coalesce("value", F.lit("none"))))
        .otherwise(default_error(state)).alias("error_text"),
    )


def stage_to_samples(stage: DataFrame) -> DataFrame:
    """Staged rows (millisecond time) to the probe-sample schema."""
    return stage.withColumn("checked_at", timestamp_from_ms(F.col("checked_at_ms"))).select(
        *[F.col(f.name).cast(f.dataType) for f in SAMPLE.fields]
    )
