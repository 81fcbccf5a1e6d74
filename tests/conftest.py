import os
import sys
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from probewatch.schemas import SAMPLE  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def when(text, day=10):
    """UTC time on a January day from ``HH:MM[:SS]``."""
    parts = [int(p) for p in text.split(":")]
    return datetime(2024, 1, day, tzinfo=timezone.utc) + timedelta(
        hours=parts[0], minutes=parts[1], seconds=parts[2] if len(parts) > 2 else 0)


def row(at, up, latency=None, error=None, target="a", **labels):
    at = when(at) if isinstance(at, str) else at
    base = {"db_type": "mysql", "environment": "production", "host": "h", "port": 3306,
            "instance": "h:3306", "criticality": "low", "team": "dba"} | labels
    dec = None if latency is None else Decimal(str(latency))
    return (at, target, *base.values(), up, dec, error)


@pytest.fixture
def samples(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SAMPLE)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def hm(t):
    return None if t is None else t.strftime("%H:%M:%S")
