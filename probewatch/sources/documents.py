"""Range-sample JSON documents: one file per fetched window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probewatch.functions.scalars import ms_from_epoch, timestamp_from_ms
from probewatch.schemas import DURATION_METRIC, POINT, PROBE_JOB, RANGE_DOCUMENT, RAW_RETENTION_DAYS, SUCCESS_METRIC
from probewatch.sources.samples import merge_success_duration, stage_to_samples


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document; a malformed file becomes a row with ``_corrupt_record``."""
    return (
        spark.read.schema(RANGE_DOCUMENT).option("multiLine", True).option("mode", "PERMISSIVE")
        .json(path).withColumn("source_file", F.col("_metadata.file_path"))
    )


def stream_documents(spark: SparkSession, path: str, max_files_per_trigger: int) -> DataFrame:
    """The same as a stream; every micro-batch takes a bounded number of windows."""
    return (
        spark.readStream.schema(RANGE_DOCUMENT).option("multiLine", True)
        .option("mode", "PERMISSIVE").option("maxFilesPerTrigger", max_files_per_trigger)
        .json(path).withColumn("source_file", F.col("_metadata.file_path"))
    )


def _accepted():
    good = (F.col("status") == "success") & F.col("data.result").isNotNull()
    return F.coalesce(good & F.col("_corrupt_record").isNull(), F.lit(False))


def rejected_documents(documents: DataFrame) -> DataFrame:
    """Documents that failed or carry no result array, for quarantine."""
    return documents.where(~_accepted()).select(
        "source_file", "status", F.col("_corrupt_record").alias("raw_text")
    )


def range_samples(documents: DataFrame) -> DataFrame:
    """Accepted documents to long samples: labels map, time, value, arrival order."""
    series = documents.where(_accepted()).select(
        "source_file", F.posexplode("data.result").alias("series_no", "series")
    )
    points = series.select(
        "source_file", "series_no", F.col("series.metric").alias("labels"),
        F.posexplode("series.values").alias("point_no", "point"),
    )
    return points.select(
        F.try_element_at("labels", F.lit("__name__")).alias("metric"),
        "labels",
        ms_from_epoch(F.get("point", F.lit(0))).alias("ts_ms"),
        F.get("point", F.lit(1)).alias("value"),
        F.struct("source_file", "series_no", "point_no").alias("arrival"),
    )


def label(name: str):
    return F.coalesce(F.try_element_at("labels", F.lit(name)), F.lit(""))


def flat_labels(samples: DataFrame) -> DataFrame:
    """Label map to columns; an absent label is the empty string."""
    return samples.select(
        "metric", "ts_ms",
        label("db_name").alias("target_name"), label("instance").alias("instance"),
        label("db_type").alias("db_type"), label("env").alias("environment"),
        label("criticality").alias("criticality"), label("team").alias("team"),
        label("job").alias("job"), "value", "arrival",
    )


def read_range_documents(spark: SparkSession, path: str, metric: str, job: str = PROBE_JOB) -> DataFrame:
    """Flat samples of one metric and job from a directory of documents."""
    flat = flat_labels(range_samples(read_documents(spark, path)))
    return flat.where((F.col("metric") == metric) & (F.col("job") == job))


def points_of(documents: DataFrame, as_of: Column, job: str = PROBE_JOB) -> DataFrame:
    """Flat samples of both metrics, as they arrived at ``as_of``.

    ``alone`` marks those whose document holds one metric only.
    """
    flat = flat_labels(range_samples(documents)).where(
        (F.col("job") == job) & F.col("metric").isin(SUCCESS_METRIC, DURATION_METRIC) & F.col("ts_ms").isNotNull())
    per_file = flat.groupBy(F.col("arrival.source_file").alias("_file")).agg(
        (F.min("metric") == F.max("metric")).alias("alone"))
    joined = flat.join(per_file, F.col("arrival.source_file") == F.col("_file"))
    return joined.withColumn("since", as_of).select(*POINT.fieldNames())


def pair_points(
    points: DataFrame, waiting: DataFrame, as_of: Column, wait_seconds: int, keep_days: int = RAW_RETENTION_DAYS,
) -> tuple[DataFrame, DataFrame]:
    """Probe samples that are complete, and the points that go on waiting.

    The documents of one window may arrive in different batches.  A success sample from a
    document without durations waits for its duration until ``wait_seconds`` after it
    arrived; then it is emitted without latency.  A duration without its sample waits while
    its time is within ``keep_days``: its sample may be stored already, or yet to come.
    """
    every = points.unionByName(waiting)
    key = ["ts_ms", "target_name", "instance"]
    sides = every.groupBy(*key).agg(
        F.count_if(F.col("metric") == SUCCESS_METRIC).alias("_up"), F.count_if(F.col("metric") == DURATION_METRIC).alias("_took"))
    known = every.join(sides, key)
    young = as_of < F.col("since") + F.make_dt_interval(secs=F.lit(wait_seconds))
    accepted = F.to_date(timestamp_from_ms(F.col("ts_ms"))) >= F.date_sub(as_of.cast("date"), keep_days)
    waits = F.when(F.col("metric") == SUCCESS_METRIC, young & F.col("alone") & (F.col("_took") == 0)).otherwise(
        accepted & (F.col("_up") == 0))
    kept = known.where(waits).select(*POINT.fieldNames())
    ready = known.where(~waits)
    samples = merge_success_duration(
        ready.where(F.col("metric") == SUCCESS_METRIC), ready.where(F.col("metric") == DURATION_METRIC))
    return stage_to_samples(samples), kept


def samples_from_documents(documents: DataFrame, job: str = PROBE_JOB) -> DataFrame:
    """Documents that hold both metrics of a window to probe samples."""
    flat = flat_labels(range_samples(documents)).where(F.col("job") == job)
    success = flat.where(F.col("metric") == SUCCESS_METRIC)
    duration = flat.where(F.col("metric") == DURATION_METRIC)
    return stage_to_samples(merge_success_duration(success, duration))
