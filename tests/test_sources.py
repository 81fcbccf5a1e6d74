import json

import pytest
from pyspark.sql import functions as F

from probewatch import sources
from probewatch.functions.scalars import grade, host_of, label_matches, port_text_of
from probewatch.schemas import DURATION_METRIC, STAGE_ROW, SUCCESS_METRIC
from tests.conftest import rows_of, when

LABELS = {"db_name": "pg", "db_type": "postgresql", "env": "production", "job": "db-port-availability",
          "instance": "10.0.0.1:5432", "criticality": "high"}


def document(path, results, status="success"):
    path.write_text(json.dumps({"status": status, "data": {"result": results}}, indent=1))


def result(metric, values, **labels):
    return {"metric": {"__name__": metric, **LABELS, **labels}, "values": values}


def test_documents_to_samples(spark, tmp_path):
    document(tmp_path / "w1.json", [
        result(SUCCESS_METRIC, [[1704880800.0004, "1"], [1704880860.5, "0"]]),
        result(DURATION_METRIC, [[1704880800.0004, "0.0123456789"]]),
        result(SUCCESS_METRIC, [[1704880800, "1"]], db_name="no-port", instance="10.0.0.9"),
        result(SUCCESS_METRIC, [[1704880800, "1"]], job="other"),
    ])
    docs = sources.read_documents(spark, str(tmp_path))
    got = sources.samples_from_documents(docs).orderBy("checked_at").collect()
    assert [(r.target_name, r.host, r.port, r.is_up, r.error_text, r.team) for r in got] == [
        ("pg", "10.0.0.1", 5432, 1, None, ""), ("pg", "10.0.0.1", 5432, 0, "blackbox probe failed", "")]
    assert str(got[0].latency_ms) == "12.345679" and got[1].latency_ms is None
    assert got[1].checked_at.microsecond == 500_000
    assert sources.read_range_documents(spark, str(tmp_path), SUCCESS_METRIC).count() == 3


def test_bad_documents_are_set_aside(spark, tmp_path):
    document(tmp_path / "ok.json", [result(SUCCESS_METRIC, [[1704880800, "1"]])])
    document(tmp_path / "failed.json", [], status="error")
    (tmp_path / "broken.json").write_text('{"status": "success", "data": {"resu')
    docs = sources.read_documents(spark, str(tmp_path)).cache()
    assert sources.samples_from_documents(docs).count() == 1
    names = {r.source_file.rsplit("/", 1)[1] for r in sources.rejected_documents(docs).collect()}
    assert names == {"failed.json", "broken.json"}


def test_success_without_any_duration(spark, tmp_path):
    document(tmp_path / "w.json", [result(SUCCESS_METRIC, [[1704880800, "1"]])])
    got = sources.samples_from_documents(sources.read_documents(spark, str(tmp_path))).collect()
    assert [r.latency_ms for r in got] == [None]


def test_last_duration_wins(spark, tmp_path):
    document(tmp_path / "w.json", [
        result(SUCCESS_METRIC, [[1704880800, "1"]]),
        result(DURATION_METRIC, [[1704880800, "9"]], team="x"),
        result(DURATION_METRIC, [[1704880800, "2"]], team="y"),
    ])
    got = sources.samples_from_documents(sources.read_documents(spark, str(tmp_path))).first()
    assert float(got.latency_ms) == 2000


def test_staged_rows_round_trip(spark, tmp_path):
    rows = [(1704880800000, "a", "mysql", "", "h", 3306, "h:3306", "", None, 1, None, None),
            (1704880860000, 'qu"ote', "mysql", "prod", "h", 3306, "h:3306", "low", "t", 0, None, "failed")]
    df = spark.createDataFrame(rows, STAGE_ROW)
    sources.write_stage(df, str(tmp_path / "stage"))
    got = rows_of(sources.read_stage(spark, str(tmp_path / "stage")), "target_name", "environment", "team", "error_text")
    assert got == [("a", "", "", None), ('qu"ote', "prod", "t", "failed")]
    assert rows_of(sources.stage_to_samples(df), "checked_at")[0][0].astimezone(when("10:00").tzinfo) == when("10:00")


def test_range_window_is_left_open_and_pushed_down(spark, tmp_path):
    spark.range(10).select(F.timestamp_seconds("id").alias("ts")).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    got = sources.range_window(df, "ts", F.timestamp_seconds(F.lit(3)), F.timestamp_seconds(F.lit(6)))
    assert got.count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def test_address_becomes_instance(spark):
    assert sources.rename_address(spark.sql("SELECT 'h:1' AS address")).columns == ["instance"]


@pytest.mark.parametrize("text, host, port", [
    ("h:5432", "h", "5432"), ("::1:99", "::1", "99"), ("plain", "plain", ""), ("h:", "h:", ""), ("a:b:7", "a:b", "7")])
def test_host_and_port(spark, text, host, port):
    df = spark.createDataFrame([(text,)], "i string")
    assert tuple(df.select(host_of(F.col("i")), port_text_of(F.col("i"))).first()) == (host, port)


@pytest.mark.parametrize("pattern, hits", [
    (".*", ["", "production", "prod"]), ("prod", ["prod"]), ("prod.*", ["production", "prod"]),
    ("prod|production", ["production", "prod"]), ("", [""])])
def test_label_patterns_are_anchored(spark, pattern, hits):
    df = spark.createDataFrame([(None,), ("production",), ("prod",)], "e string")
    got = df.where(label_matches(F.col("e"), pattern)).select(F.coalesce("e", F.lit(""))).collect()
    assert sorted(r[0] for r in got) == sorted(hits)


@pytest.mark.parametrize("value, kind, name", [
    (94.99, "availability", "red"), (95.0, "availability", "yellow"), (99.0, "availability", "green"),
    (0.5, "latency_seconds", "green"), (1.0, "latency_seconds", "yellow"), (3.0, "latency_seconds", "red"),
    (0.0, "down_now", "green"), (1.0, "down_now", "red"), (None, "availability", None)])
def test_grades(spark, value, kind, name):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(grade(F.col("v"), kind)).first()[0] == name
