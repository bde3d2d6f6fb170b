"""Data tests: each returns the offending rows or counts; an empty or all-zero result is a pass."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stopmetrics.operators.slices import REASONABLE_DELAY_MIN
from stopmetrics.schema import KNOWN_STATUSES

STOP_KEY = ("operating_day", "trip_id", "station_code")


def test_delay_reasonable(delays: DataFrame) -> DataFrame:
    low, high = REASONABLE_DELAY_MIN
    return delays.where((F.col("arrival_delay_min") < low) | (F.col("arrival_delay_min") > high))


def test_not_null(staged: DataFrame, columns: Iterable[str] = (*STOP_KEY, "scheduled_arrival_at")) -> DataFrame:
    """(column, failures), all columns counted in one pass."""
    names = list(columns)
    counts = staged.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])
    return counts.unpivot([], names, "column", "failures")


def test_unique(rows: DataFrame, columns: Iterable[str] = STOP_KEY) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def test_accepted_values(
    rows: DataFrame, column: str = "arrival_status", accepted: Iterable[str] = KNOWN_STATUSES
) -> DataFrame:
    """Values outside the accepted list with their counts; NULL is not a value."""
    return (
        rows.where(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


@dataclass(frozen=True)
class RowCheck:
    """A condition that a row of a table should not meet. A `strict` one fails the write at the first row that does."""

    name: str
    offends: Column
    strict: bool = False


def not_null(*columns: str, strict: bool = False) -> list[RowCheck]:
    return [RowCheck(f"not_null_{name}", F.col(name).isNull(), strict) for name in columns]


def accepted_values(column: str, accepted: Iterable[str], strict: bool = False) -> RowCheck:
    return RowCheck(f"accepted_{column}", F.col(column).isNotNull() & ~F.col(column).isin(*accepted), strict)


def within(name: str, value: Column, low: float, high: float, strict: bool = False) -> RowCheck:
    return RowCheck(f"within_{name}", (value < low) | (value > high), strict)


def guarded(rows: DataFrame, checks: Iterable[RowCheck], carrier: str) -> DataFrame:
    """`rows`, whose reading fails at a row that offends a strict check, so a write of them replaces nothing.

    The condition sits in the column `carrier`, which the write must use: Spark leaves out columns nobody reads.
    """
    kind = rows.schema[carrier].dataType
    for check in checks:
        if check.strict:
            failure = F.raise_error(F.lit(f"A row fails the check {check.name}.")).cast(kind)
            rows = rows.withColumn(carrier, F.when(check.offends, failure).otherwise(F.col(carrier)))
    return rows


def observed(rows: DataFrame, checks: Iterable[RowCheck], observation: Observation) -> DataFrame:
    """`rows`, counted into `observation` as they pass: rows in all, and offenders of each check.

    To be called last before a write: a stage above a shuffle could run again after an executor is lost, and count twice.
    """
    counts = [F.count_if(check.offends).alias(check.name) for check in checks]
    return rows.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)


# Names that start with test_ are the query names; they are operators, not pytest cases.
for _operator in (test_delay_reasonable, test_not_null, test_unique, test_accepted_values):
    _operator.__test__ = False
