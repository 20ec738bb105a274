"""The data-quality gate: declared expectations, one aggregate pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


class QualityGateError(RuntimeError):
    """A gate that did not pass; carries its summary."""

    def __init__(self, summary: dict):
        super().__init__(f"quality gate failed: {summary}")
        self.summary = summary


@dataclass(frozen=True)
class Expectation:
    """``kind`` is not_null, unique, between, row_count or timestamp_format.

    Nulls are skipped by every kind but not_null.
    """

    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    fmt: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})" if self.column else self.kind

    def _outside(self, value: Column) -> Column:
        broken = F.lit(False)
        if self.low is not None:
            broken = broken | (value < F.lit(self.low))
        if self.high is not None:
            broken = broken | (value > F.lit(self.high))
        return broken

    def unexpected(self) -> Column:
        """Aggregate: how many values break the expectation (surplus copies for unique)."""
        if self.kind == "row_count":
            return F.when(self._outside(F.count(F.lit(1))), 1).otherwise(0).cast("long")
        value = F.col(self.column)
        if self.kind == "not_null":
            return F.count_if(value.isNull())
        if self.kind == "unique":
            return F.count(value) - F.count_distinct(value)
        if self.kind == "between":
            return F.count_if(F.coalesce(self._outside(value), F.lit(False)))
        if self.kind == "timestamp_format":
            parsed = F.try_to_timestamp(value, F.lit(self.fmt))
            return F.count_if(value.isNotNull() & parsed.isNull())
        raise ValueError(f"unknown expectation kind {self.kind!r}")


SILVER_SUITE = (
    Expectation("not_null", "article_id"),
    Expectation("unique", "article_id"),
    Expectation("between", "views", low=0),
    Expectation("between", "rating", low=0.0, high=5.0),
    Expectation("row_count", low=1),
)

RECORD_SUITE = (
    Expectation("not_null", "article_id"),
    Expectation("unique", "article_id"),
    Expectation("between", "word_count", low=1, high=100000),
    Expectation("timestamp_format", "published_at", fmt="yyyy-MM-dd'T'HH:mm:ssXXX"),
)


def check_rows(df: DataFrame, suite: tuple[Expectation, ...] = SILVER_SUITE) -> DataFrame:
    """One row per expectation: its number, name, unexpected count and verdict."""
    counts = df.agg(
        F.count(F.lit(1)).alias("dataset_row_count"),
        *[e.unexpected().alias(f"_unexpected_{i}") for i, e in enumerate(suite)],
    )
    checks = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("check_number"),
                F.lit(e.name).alias("check_name"),
                F.col(f"_unexpected_{i}").alias("unexpected_count"),
                (F.col(f"_unexpected_{i}") == 0).alias("passed"),
            )
            for i, e in enumerate(suite)
        ]
    )
    return counts.select("dataset_row_count", F.inline(checks))


def summarize(checks: DataFrame) -> DataFrame:
    """The verdict of the whole suite in one row."""
    passed = F.count_if("passed")
    total = F.count(F.lit(1))
    rows = F.max("dataset_row_count")
    return checks.agg(
        rows.alias("dataset_row_count"),
        total.alias("total_checks"),
        passed.alias("passed_checks"),
        (total - passed).alias("failed_checks"),
        ((passed == total) & (rows > 0)).alias("quality_gate_passed"),
        F.when(rows == 0, "FAILED_EMPTY")
        .when(passed == total, "All checks passed")
        .otherwise("Data quality violations detected")
        .alias("details"),
    )


def gate_summary(df: DataFrame, suite: tuple[Expectation, ...] = SILVER_SUITE) -> dict:
    """The verdict as a dict; an empty dataset fails with its status alone."""
    row = summarize(check_rows(df, suite)).first().asDict()
    if row["dataset_row_count"] == 0:
        return {"quality_gate_passed": False, "dataset_row_count": 0, "status": "FAILED_EMPTY"}
    return row


def enforce(df: DataFrame, suite: tuple[Expectation, ...] = SILVER_SUITE) -> dict:
    """Summary of a passing gate; raises ``QualityGateError`` otherwise."""
    summary = gate_summary(df, suite)
    if not summary["quality_gate_passed"]:
        raise QualityGateError(summary)
    return summary
