from __future__ import annotations

import pytest

from strata.operators.lineage import LineageLog
from strata.operators.quality import (
    RECORD_SUITE,
    SILVER_SUITE,
    Expectation,
    QualityGateError,
    check_rows,
    enforce,
    gate_summary,
)

SCHEMA = "article_id string, views bigint, rating double"
BAD = [(None, -100, 99.0), ("ART-DUP", 50, 4.0), ("ART-DUP", 20, 3.0)]


def verdicts(df, suite=SILVER_SUITE) -> dict[str, bool]:
    return {r["check_name"]: r["passed"] for r in check_rows(df, suite).collect()}


def test_bad_rows_fail_each_of_three_checks(spark):
    suite = (
        Expectation("not_null", "article_id"),
        Expectation("unique", "article_id"),
        Expectation("between", "views", low=0),
    )
    summary = gate_summary(spark.createDataFrame(BAD, SCHEMA), suite)
    assert summary["failed_checks"] == 3 and summary["quality_gate_passed"] is False
    assert summary["details"] == "Data quality violations detected"


def test_good_rows_pass(spark):
    summary = enforce(spark.createDataFrame([("A", 0, 0.0), ("B", 5, 5.0)], SCHEMA))
    assert summary == {
        "dataset_row_count": 2,
        "total_checks": 5,
        "passed_checks": 5,
        "failed_checks": 0,
        "quality_gate_passed": True,
        "details": "All checks passed",
    }


def test_nulls_are_skipped_but_by_not_null(spark):
    df = spark.createDataFrame([("A", None, None), ("B", None, 1.0)], SCHEMA)
    assert all(verdicts(df).values())
    two_nulls = spark.createDataFrame([(None, 1, 1.0), (None, 1, 1.0)], SCHEMA)
    assert verdicts(two_nulls)["unique(article_id)"] is True
    assert verdicts(two_nulls)["not_null(article_id)"] is False


def test_unexpected_counts(spark):
    counts = {r["check_name"]: r["unexpected_count"] for r in check_rows(spark.createDataFrame(BAD, SCHEMA)).collect()}
    assert counts == {
        "not_null(article_id)": 1,
        "unique(article_id)": 1,
        "between(views)": 1,
        "between(rating)": 1,
        "row_count": 0,
    }


def test_nan_is_out_of_range(spark):
    df = spark.createDataFrame([("A", 1, float("nan"))], SCHEMA)
    assert verdicts(df)["between(rating)"] is False


def test_empty_dataset(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert gate_summary(empty) == {"quality_gate_passed": False, "dataset_row_count": 0, "status": "FAILED_EMPTY"}
    with pytest.raises(QualityGateError):
        enforce(empty)


def test_second_suite(spark):
    schema = "article_id string, word_count int, published_at string"
    good = [("a", 1, "2026-08-10T12:00:00Z"), ("b", 100000, "2026-08-10T12:00:00+03:00")]
    assert all(verdicts(spark.createDataFrame(good, schema), RECORD_SUITE).values())
    bad = spark.createDataFrame([("a", 0, "2026-08-10"), ("b", 100001, "x")], schema)
    failed = {name for name, passed in verdicts(bad, RECORD_SUITE).items() if not passed}
    assert failed == {"between(word_count)", "timestamp_format(published_at)"}


def test_lineage_event(spark, tmp_path):
    log = LineageLog(spark, str(tmp_path / "lineage"))
    event = log.emit("test_job", "start", "test-run-123", ["test_input"], ["test_output"])
    assert event["eventType"] == "START" and event["job"]["name"] == "test_job"
    assert event["inputs"] == [{"namespace": "strata", "name": "test_input"}]
    stored = log.read().first().asDict(recursive=True)
    assert stored == event
    log.emit("test_job", "COMPLETE", "test-run-123")
    assert sorted(r["eventType"] for r in log.read().collect()) == ["COMPLETE", "START"]


def test_unwritable_lineage_does_not_raise(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("x")
    event = LineageLog(spark, str(blocked / "sub")).emit("job", "FAIL")
    assert event["eventType"] == "FAIL" and event["run"]["runId"]
