"""Row filters over raw stop events, and over the daily fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopmetrics.functions.measures import delay_minutes
from stopmetrics.functions.typing_rules import has_delay_status, normalize_flag, parse_timestamp

# A delay outside these minutes is suspicious.
REASONABLE_DELAY_MIN = (-60, 180)
DEFAULT_RANGE_MIN = (-20, 60)


def _measured() -> Column:
    return has_delay_status(F.col("AN_PROGNOSE_STATUS"))


def _cancelled() -> Column:
    return normalize_flag(F.col("FAELLT_AUS_TF"))


def _nulls_last(columns: Iterable[str]) -> list[Column]:
    return [F.col(f"`{name}`").asc_nulls_last() for name in columns]


def with_delay(df: DataFrame) -> DataFrame:
    return df.withColumn("delay_min", delay_minutes())


def filter_delay_status(df: DataFrame) -> DataFrame:
    return df.where(_measured())


def is_computable() -> Column:
    """Measured, not cancelled, and both arrival times parse."""
    return (
        _measured()
        & ~_cancelled()
        & parse_timestamp(F.col("ANKUNFTSZEIT")).isNotNull()
        & parse_timestamp(F.col("AN_PROGNOSE")).isNotNull()
    )


def filter_computable(df: DataFrame) -> DataFrame:
    return df.where(is_computable())


def edge_null_arrivals(df: DataFrame) -> DataFrame:
    """Rows whose scheduled arrival is missing in the file; an unreadable text is not missing."""
    return df.where(F.col("ANKUNFTSZEIT").isNull())


def edge_non_delay_status(df: DataFrame) -> DataFrame:
    return df.where(~_measured())


def edge_cancelled(df: DataFrame) -> DataFrame:
    return df.where(_cancelled())


def edge_case_frames(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "null_arrivals": edge_null_arrivals(df),
        "non_delay_status": edge_non_delay_status(df),
        "cancelled": edge_cancelled(df),
    }


def edge_preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """First rows of each edge-case slice in column order; the limit is the feature.

    One scan: a row is repeated once per slice it belongs to. `row_number() <= rows` keeps that many rows per slice in
    each task before the shuffle.
    """
    belongs = {  # the slices of `edge_case_frames`
        "null_arrivals": F.col("ANKUNFTSZEIT").isNull(),
        "non_delay_status": ~_measured(),
        "cancelled": _cancelled(),
    }
    names = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in belongs.items()]))
    first = Window.partitionBy("slice").orderBy(*_nulls_last(df.columns))
    ranked = df.select("*", F.explode(names).alias("slice")).withColumn("place", F.row_number().over(first))
    return ranked.where(F.col("place") <= rows).drop("place")


def delay_outliers(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows with an unreasonable delay, whatever their status; with `limit`, a preview from the lowest up."""
    low, high = REASONABLE_DELAY_MIN
    found = _with_delay_where(df, lambda delay: (delay < low) | (delay > high))
    if limit is None:
        return found
    return found.orderBy(*_nulls_last(["delay_min", *df.columns])).limit(limit)


def _with_delay_where(df: DataFrame, condition: Callable[[Column], Column]) -> DataFrame:
    """`with_delay(df)` where the delay meets `condition`, each time parsed once per row.

    The delay goes through a one-element array that `explode_outer` takes apart, empty where the row does not qualify: a
    plain filter, also the one inferred from `explode`, would be pushed below and parse both times again.
    """
    kept = F.filter(F.array(delay_minutes()), condition)
    return df.select("*", F.explode_outer(kept).alias("delay_min")).where(F.col("delay_min").isNotNull())


def check_range(low: float, high: float) -> None:
    if low >= high:
        raise ValueError("The lowest delay must be less than the highest delay.")


def delay_rows(df: DataFrame) -> DataFrame:
    """Rows behind the histogram: measured, not cancelled, with a delay."""
    return _with_delay_where(df.where(_measured() & ~_cancelled()), Column.isNotNull)


def delay_range(df: DataFrame, low: float = DEFAULT_RANGE_MIN[0], high: float = DEFAULT_RANGE_MIN[1]) -> DataFrame:
    """`delay_rows` within [low, high], both ends included."""
    check_range(low, high)
    return _with_delay_where(df.where(_measured() & ~_cancelled()), lambda delay: delay.between(low, high))


def exclude_pass_through(df: DataFrame, flag: Column | None = None) -> DataFrame:
    """Drop vehicles passing without a stop; `flag` is a boolean column, by default the raw text typed."""
    return df.where(~(normalize_flag(F.col("DURCHFAHRT_TF")) if flag is None else flag))


def slice_dates_types(
    fact: DataFrame, first: dt.date, last: dt.date, transport_types: Iterable[str] | None = None
) -> DataFrame:
    """Rows of a fact between two days, both included, for chosen transport types (all when None).

    Both predicates sit on plain columns, so a stored fact is pruned by day and filtered in the scan.
    """
    chosen = fact.where(F.col("operating_day").between(F.lit(first), F.lit(last)))
    if transport_types is None:
        return chosen
    return chosen.where(F.col("transport_type").isin(*transport_types))
