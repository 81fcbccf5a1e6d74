"""Row constraints: rows that break one are set aside with the reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_reason(samples: DataFrame) -> DataFrame:
    required = ["checked_at", "target_name", "db_type", "environment", "host", "port", "instance", "is_up"]
    reason = F.lit(None).cast("string")
    checks = [(F.col(c).isNull(), f"{c} is null") for c in required]
    checks += [
        (F.col("target_name") == "", "target_name is empty"),
        (~F.col("port").between(1, 65535), "port out of range"),
        (~F.col("is_up").isin(0, 1), "is_up not 0 or 1"),
        (F.col("latency_ms") < 0, "latency_ms negative"),
    ]
    for broken, text in reversed(checks):
        reason = F.when(broken, F.lit(text)).otherwise(reason)
    return samples.withColumn("reason", reason)


def violations(samples: DataFrame) -> DataFrame:
    """Rejected rows with the first broken constraint as ``reason``."""
    return _with_reason(samples).where(F.col("reason").isNotNull())


def split_valid(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    judged = _with_reason(samples)
    return (
        judged.where(F.col("reason").isNull()).drop("reason"),
        judged.where(F.col("reason").isNotNull()),
    )
