"""Explicit schemas and the fixed values shared by every operator."""

from pyspark.sql import types as T

# Results depend on them being exactly these.
DEFAULT_ERROR_TEXT = "blackbox probe failed"
PROBE_JOB = "db-port-availability"
SUCCESS_METRIC = "probe_success"
DURATION_METRIC = "probe_duration_seconds"
SLOW_MS = 3000
RAW_RETENTION_DAYS = 30
HOURLY_RETENTION_DAYS = 400
REPORT_RETENTION_DAYS = 2192
INACTIVE_AFTER_SECONDS = 86_400
RECENT_SECONDS = 180
OVERLAP_SECONDS = 180
BACKFILL_CHUNK_SECONDS = 3600
BACKFILL_CHUNKS_PER_CYCLE = 6
BACKFILL_INITIAL_SECONDS = 3600
BACKFILL_MAX_SECONDS = 1_296_000
LOOKBACK_SECONDS = 300
RULE_INTERVAL_SECONDS = 30
GRID_STEP_SECONDS = 60

# Width of the time slices that split one target's history over many tasks.
SLICE_SECONDS = 900

DEC = T.DecimalType(20, 6)

LABELS = ["db_type", "environment", "host", "port", "instance", "criticality", "team"]
SERIES_LABELS = ["target_name", "instance", "db_type", "environment", "criticality", "team"]


def _label_fields():
    return [
        T.StructField("db_type", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("port", T.IntegerType()),
        T.StructField("instance", T.StringType()),
        T.StructField("criticality", T.StringType()),
        T.StructField("team", T.StringType()),
    ]


def _kpi_fields():
    return [
        T.StructField("target_name", T.StringType()),
        *_label_fields(),
        T.StructField("probes", T.LongType()),
        T.StructField("up_probes", T.LongType()),
        T.StructField("down_probes", T.LongType()),
        T.StructField("slow_probes", T.LongType()),
        T.StructField("latency_ms_sum", T.DecimalType(38, 10)),
        T.StructField("latency_ms_count", T.LongType()),
        T.StructField("max_latency_ms", DEC),
        T.StructField("first_probe_at", T.TimestampType()),
        T.StructField("last_probe_at", T.TimestampType()),
    ]


SAMPLE = T.StructType([
    T.StructField("checked_at", T.TimestampType()),
    T.StructField("target_name", T.StringType()),
    *_label_fields(),
    T.StructField("is_up", T.IntegerType()),
    T.StructField("latency_ms", DEC),
    T.StructField("error_text", T.StringType()),
])

TARGET = T.StructType([
    T.StructField("target_name", T.StringType()),
    *_label_fields(),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("first_seen_at", T.TimestampType()),
    T.StructField("last_seen_at", T.TimestampType()),
])

DAILY_KPI = T.StructType([T.StructField("period_start", T.DateType()), *_kpi_fields()])
HOURLY_KPI = T.StructType([T.StructField("period_hour", T.TimestampType()), *_kpi_fields()])

STATUS_EVENT = T.StructType([
    T.StructField("target_name", T.StringType()),
    T.StructField("event_at", T.TimestampType()),
    *_label_fields(),
    T.StructField("previous_is_up", T.IntegerType()),
    T.StructField("current_is_up", T.IntegerType()),
    T.StructField("latency_ms", DEC),
    T.StructField("error_text", T.StringType()),
])

DOWNTIME_EVENT = T.StructType([
    T.StructField("target_name", T.StringType()),
    T.StructField("down_start", T.TimestampType()),
    T.StructField("down_end", T.TimestampType()),
    T.StructField("last_down_at", T.TimestampType()),
    *_label_fields(),
    T.StructField("down_samples", T.LongType()),
    T.StructField("first_error_text", T.StringType()),
    T.StructField("last_error_text", T.StringType()),
    T.StructField("max_latency_ms", DEC),
])

LATENCY_EVENT = T.StructType([
    T.StructField("target_name", T.StringType()),
    T.StructField("slow_start", T.TimestampType()),
    T.StructField("slow_end", T.TimestampType()),
    T.StructField("last_slow_at", T.TimestampType()),
    T.StructField("threshold_ms", DEC),
    *_label_fields(),
    T.StructField("slow_samples", T.LongType()),
    T.StructField("latency_ms_sum", T.DecimalType(38, 6)),
    T.StructField("latency_ms_count", T.LongType()),
    T.StructField("max_latency_ms", DEC),
])

DAILY_ERROR = T.StructType([
    T.StructField("period_start", T.DateType()),
    T.StructField("target_name", T.StringType()),
    *_label_fields(),
    T.StructField("error_text", T.StringType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("first_seen_at", T.TimestampType()),
    T.StructField("last_seen_at", T.TimestampType()),
])

LAST_SAMPLE = T.StructType([
    T.StructField("target_name", T.StringType()),
    T.StructField("checked_at", T.TimestampType()),
    T.StructField("is_up", T.IntegerType()),
])

#: Hours whose events have to be looked at again.
TARGET_HOUR = T.StructType([T.StructField("target_name", T.StringType()), T.StructField("period_hour", T.TimestampType())])

INGEST_METRICS = T.StructType([
    T.StructField("cycle_at", T.TimestampType()),
    T.StructField("cycle_success", T.IntegerType()),
    T.StructField("last_success_timestamp_seconds", T.LongType()),
    T.StructField("samples_fetched_last_cycle", T.LongType()),
    T.StructField("rows_inserted_last_cycle", T.LongType()),
    T.StructField("backfill_remaining_seconds", T.LongType()),
])

# One range-vector response: label map plus [epoch seconds, value] pairs. The
# pair mixes a number and a string, so it is read as an array of strings.
RANGE_DOCUMENT = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("result", T.ArrayType(T.StructType([
            T.StructField("metric", T.MapType(T.StringType(), T.StringType())),
            T.StructField("values", T.ArrayType(T.ArrayType(T.StringType()))),
        ]))),
    ])),
    T.StructField("_corrupt_record", T.StringType()),
])

#: A flat sample of one metric, as it waits for its counterpart.
POINT = T.StructType([
    T.StructField("metric", T.StringType()), T.StructField("ts_ms", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in (
        "target_name", "instance", "db_type", "environment", "criticality", "team", "job", "value")],
    T.StructField("arrival", T.StructType([
        T.StructField("source_file", T.StringType()), T.StructField("series_no", T.IntegerType()),
        T.StructField("point_no", T.IntegerType()),
    ])),
    T.StructField("alone", T.BooleanType()), T.StructField("since", T.TimestampType()),
])

STAGE_ROW = T.StructType([
    T.StructField("checked_at_ms", T.LongType()),
    T.StructField("target_name", T.StringType()),
    T.StructField("db_type", T.StringType()),
    T.StructField("environment", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("port", T.IntegerType()),
    T.StructField("instance", T.StringType()),
    T.StructField("criticality", T.StringType()),
    T.StructField("team", T.StringType()),
    T.StructField("is_up", T.IntegerType()),
    T.StructField("latency_ms", DEC),
    T.StructField("error_text", T.StringType()),
])
