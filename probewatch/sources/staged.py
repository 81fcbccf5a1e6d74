r"""Tab-separated exchange files: twelve columns, NULL written as ``\N``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probewatch.schemas import STAGE_ROW

_TEXT = ["db_type", "environment", "criticality", "team"]


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Read staged rows; an empty label field is the empty string, not NULL."""
    rows = (
        spark.read.schema(STAGE_ROW).option("sep", "\t").option("nullValue", "\\N")
        .option("quote", "").csv(path)
    )
    return rows.withColumns({c: F.coalesce(c, F.lit("")) for c in _TEXT})


def write_stage(rows: DataFrame, path: str) -> None:
    (
        rows.select(*STAGE_ROW.fieldNames()).write.option("sep", "\t").option("nullValue", "\\N")
        .option("emptyValue", "").option("quote", "").csv(path)
    )
