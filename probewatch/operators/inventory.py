"""Target inventory and ingest health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probewatch.functions.scalars import whole_seconds_between
from probewatch.operators.ingest import upsert_replace
from probewatch.schemas import INACTIVE_AFTER_SECONDS, LABELS, RECENT_SECONDS, TARGET


def _before(as_of: Column, seconds: int) -> Column:
    return as_of - F.make_dt_interval(secs=F.lit(seconds))


def latest_per_target(samples: DataFrame) -> DataFrame:
    """Labels and time of the newest sample of each target.

    The first step keeps one row per label combination and combines on the map
    side; only these rows are compared by time.  Equal times are decided by the
    lowest instance.
    """
    seen = samples.groupBy("target_name", *LABELS).agg(F.max("checked_at").alias("checked_at"))
    newest = seen.groupBy("target_name").agg(F.max("checked_at").alias("checked_at"))
    tied = seen.join(newest, ["target_name", "checked_at"])
    rest = [c for c in LABELS if c != "instance"]
    best = tied.groupBy("target_name", "checked_at").agg(F.min(F.struct("instance", *rest)).alias("r"))
    return best.select("target_name", *[F.col(f"r.{c}").alias(c) for c in LABELS], "checked_at")


def target_inventory(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert the newest labels; ``first_seen_at`` keeps its first value."""
    latest = latest_per_target(batch)
    known = stored.select(
        "target_name", F.col("first_seen_at").alias("_first"), F.col("last_seen_at").alias("_last")
    )
    merged = latest.join(known, "target_name", "left").select(
        "target_name", *LABELS, F.lit(True).alias("is_active"),
        F.coalesce("_first", "checked_at").alias("first_seen_at"),
        F.greatest("_last", "checked_at").alias("last_seen_at"),
    )
    return upsert_replace(stored.select(*TARGET.fieldNames()), merged, ["target_name"])


def deactivate(targets: DataFrame, batch: DataFrame, as_of: Column,
               after_seconds: int = INACTIVE_AFTER_SECONDS) -> DataFrame:
    """Targets not seen for long and absent from the batch become inactive."""
    present = batch.select("target_name").distinct().withColumn("_present", F.lit(True))
    gone = (F.col("last_seen_at") < _before(as_of, after_seconds)) & F.col("_present").isNull()
    return (
        targets.join(present, "target_name", "left")
        .withColumn("is_active", F.col("is_active") & ~gone)
        .drop("_present")
    )


def missing_recent_targets(targets: DataFrame, samples: DataFrame, as_of: Column,
                           within_seconds: int = RECENT_SECONDS) -> DataFrame:
    """Active targets without a sample in the last minutes.

    ``samples`` may be a table of each target's last sample, which spares the raw scan.
    """
    last = samples.groupBy("target_name").agg(F.max("checked_at").alias("last_probe_at"))
    silent = F.col("last_probe_at").isNull() | (F.col("last_probe_at") < _before(as_of, within_seconds))
    return (
        targets.where("is_active").join(last, "target_name", "left").where(silent)
        .select(
            "target_name", "db_type", "environment", "instance", "criticality", "last_probe_at",
            whole_seconds_between(as_of, F.col("last_probe_at")).alias("seconds_since_last_probe"),
        )
    )


def ingest_health(targets: DataFrame, samples: DataFrame, as_of: Column,
                  within_seconds: int = RECENT_SECONDS) -> DataFrame:
    """Active, recent and missing target counts, and the ingest lag.

    ``samples`` may be a table of each target's last sample, which spares the raw scan.
    """
    active = targets.where("is_active").agg(F.count(F.lit(1)).alias("active_target_count"))
    per_target = samples.groupBy("target_name").agg(F.max("checked_at").alias("last"))
    seen = per_target.agg(
        F.count_if(F.col("last") >= _before(as_of, within_seconds)).alias("recent_target_count"),
        F.max("last").alias("latest_checked_at"),
    )
    return active.crossJoin(seen).select(
        "active_target_count", "recent_target_count",
        (F.col("active_target_count") - F.col("recent_target_count")).alias("missing_recent_target_count"),
        "latest_checked_at",
        whole_seconds_between(as_of, F.col("latest_checked_at")).alias("ingest_lag_seconds"),
    )
