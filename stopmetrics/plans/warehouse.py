"""Staging, delays, facts and dimensions, each a function from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopmetrics.functions.measures import (
    SIGNIFICANT_DELAY_MIN,
    is_delayed,
    is_significantly_delayed,
    percent,
    whole_minutes_between,
)
from stopmetrics.functions.typing_rules import normalize_flag, normalize_status, parse_operating_day, parse_timestamp
from stopmetrics.operators.slices import exclude_pass_through
from stopmetrics.schema import DELAY_STATUSES, STAGING_NAMES

_STAMPS = ("ANKUNFTSZEIT", "AN_PROGNOSE", "ABFAHRTSZEIT", "AB_PROGNOSE")
_FLAGS = ("ZUSATZFAHRT_TF", "FAELLT_AUS_TF", "DURCHFAHRT_TF")
_STATUSES = ("AN_PROGNOSE_STATUS", "AB_PROGNOSE_STATUS")
_NUMBERS = ("LINIEN_ID", "BPUIC")

_DEDUP_KEY = ("operating_day", "trip_id", "station_code")
# A real stop before a pass-through, then a fixed order so that the row kept never depends on the run. The last
# two are the remaining grouping keys of the facts.
_DEDUP_ORDER = (
    "is_pass_through",
    "scheduled_arrival_at",
    "scheduled_departure_at",
    "actual_arrival_at",
    "actual_departure_at",
    "arrival_status",
    "is_cancelled",
    "line_name",
    "transport_type",
    "operator_id",
)


def rename_snake_case(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(name).alias(new) for name, new in STAGING_NAMES.items()])


def typed_stops(raw: DataFrame) -> DataFrame:
    """All raw columns typed and renamed, in one projection.

    As whole-stage code, the typing of all columns is one method of more than 8000 bytes, which the JVM never compiles but
    interprets row by row. `exists` has no such code, so Spark generates the projection apart, in small methods.
    """

    def typed(name: str) -> Column:
        value = F.col(name)
        if name == "BETRIEBSTAG":
            return parse_operating_day(value)
        if name in _STAMPS:
            return parse_timestamp(value)
        if name in _FLAGS:
            return F.exists(F.array(value), normalize_flag)
        if name in _STATUSES:
            return F.upper(value)
        if name in _NUMBERS:
            return value.try_cast("int")
        return value

    return raw.select(*[typed(name).alias(new) for name, new in STAGING_NAMES.items()])


def dedup_stops(typed: DataFrame) -> DataFrame:
    """One row per operating day, trip and station; rows that lack a part of that key all stay.

    `row_number() = 1` lets Spark keep only the best row per key within each task before the shuffle, so a key
    that repeats without end sends one row per task. A row without a whole key is told from all others by a number of
    its own, which also deals such rows evenly.
    """
    order = [F.col(name).asc_nulls_last() for name in _DEDUP_ORDER]
    whole = reduce(Column.__and__, [F.col(name).isNotNull() for name in _DEDUP_KEY])
    typed = typed.withColumn("own", F.when(~whole, F.monotonically_increasing_id()))
    best = Window.partitionBy(*_DEDUP_KEY, "own").orderBy(*order)
    typed = typed.withColumn("stop_rank", F.row_number().over(best)).where("stop_rank = 1")
    return typed.drop("stop_rank", "own")


def stops_flagged(raw: DataFrame) -> DataFrame:
    """Typed stops without pass-throughs and repeats; cancelled stops stay, flagged, because the facts count them."""
    stopping = exclude_pass_through(typed_stops(raw), F.col("is_pass_through"))
    # Known to be false from here on: a constant needs no place in sort and shuffle.
    return dedup_stops(stopping.withColumn("is_pass_through", F.lit(False)))


def without_cancelled(flagged: DataFrame) -> DataFrame:
    return flagged.where(~F.col("is_cancelled"))


def stg_stop_events(raw: DataFrame) -> DataFrame:
    return without_cancelled(stops_flagged(raw))


def arrival_delay() -> Column:
    return whole_minutes_between(F.col("scheduled_arrival_at"), F.col("actual_arrival_at"))


def departure_delay() -> Column:
    return whole_minutes_between(F.col("scheduled_departure_at"), F.col("actual_departure_at"))


def has_measured_status() -> Column:
    return normalize_status(F.col("arrival_status")).isin(*DELAY_STATUSES)


def int_delays(staged: DataFrame) -> DataFrame:
    """Staged stops with a measured status, their whole-minute delay and its flags."""
    delay = F.col("arrival_delay_min")
    return (
        staged.where(has_measured_status())
        .withColumn("arrival_delay_min", arrival_delay())
        .withColumn("is_delayed", is_delayed(delay))
        .withColumn("is_significantly_delayed", is_significantly_delayed(delay))
    )


def delay_counts(flagged: DataFrame, keys: Iterable[str]) -> DataFrame:
    """(keys..., d, n, n_cancelled): the number of `stops_flagged` rows per whole-minute delay; `d` is NULL where none is
    measured.

    Counts of disjoint rows add up, so stored ones answer for any coarser key or period, exactly: see `delay_figures`.
    """
    measured = ~F.col("is_cancelled") & has_measured_status()
    return (
        flagged.select(*keys, "is_cancelled", F.when(measured, arrival_delay()).alias("d"))
        .groupBy(*keys, "d")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_cancelled").alias("n_cancelled"))
    )


def delay_figures(counts: DataFrame, keys: Iterable[str], on_time_max_min: int = 0) -> DataFrame:
    """Figures of `delay_counts` rows per `keys`, any columns of theirs or made from them.

    Counts of one delay that come from several days or finer keys are added up first, with map-side combining.
    """
    names = list(keys)
    counts = counts.groupBy(*names, "d").agg(F.sum("n").alias("n"), F.sum("n_cancelled").alias("n_cancelled"))
    delay, n = F.col("d"), F.col("n")

    def stops_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    n_measured = stops_where(delay.isNotNull())
    return counts.groupBy(*names).agg(
        F.sum("n").alias("total_stop_events"),
        (F.sum(delay * n) / F.nullif(n_measured, F.lit(0))).alias("avg_delay"),
        F.percentile("d", F.lit(0.5), F.col("n")).alias("median_delay"),
        F.percentile("d", F.lit(0.95), F.col("n")).alias("p95_delay"),
        F.max("d").alias("max_delay"),
        percent(stops_where(delay <= on_time_max_min), n_measured).alias("pct_on_time"),
        percent(stops_where(delay >= SIGNIFICANT_DELAY_MIN), n_measured).alias("pct_delayed_3min"),
        F.sum("n_cancelled").alias("total_cancelled"),
    )


STATE_KEYS = ("operating_day", "transport_type", "line_name", "operator_id", "station_code")


def delay_state(flagged: DataFrame) -> DataFrame:
    """The delay counts a warehouse keeps: the finest keys of both facts, from which every coarser figure follows."""
    return delay_counts(flagged, STATE_KEYS)


def monthly_line_delays(state: DataFrame) -> DataFrame:
    """Figures per month, transport type and line, from stored delay counts alone."""
    keys = ("month", "transport_type", "line_name")
    return delay_figures(state.withColumn("month", F.trunc("operating_day", "month")), keys)


def state_histogram(state: DataFrame, step: int = 5) -> DataFrame:
    """(transport_type, bin_start, count) of the measured whole-minute delays, from stored delay counts alone."""
    start = (F.floor(F.col("d") / step) * step).alias("bin_start")
    return state.where("d IS NOT NULL").groupBy("transport_type", start).agg(F.sum("n").alias("count"))


_DAILY_KEYS = ("operating_day", "transport_type", "line_name", "operator_id")
_STATION_KEYS = ("operating_day", "station_code", "transport_type")


def fct_daily_delays(flagged: DataFrame) -> DataFrame:
    return daily_from_state(delay_counts(flagged, _DAILY_KEYS))


def daily_from_state(counts: DataFrame) -> DataFrame:
    """The daily fact from `delay_counts` rows by its keys or finer ones."""
    return delay_figures(counts, _DAILY_KEYS).select(
        *_DAILY_KEYS,
        "total_stop_events",
        F.col("avg_delay").alias("avg_arrival_delay"),
        "median_delay",
        "pct_on_time",
        "pct_delayed_3min",
        "max_delay",
        "total_cancelled",
    )


def fct_station_delays(flagged: DataFrame) -> DataFrame:
    return station_from_state(delay_counts(flagged, _STATION_KEYS))


def station_from_state(counts: DataFrame) -> DataFrame:
    """The station fact from `delay_counts` rows by its keys or finer ones."""
    return delay_figures(counts, _STATION_KEYS).select(
        *_STATION_KEYS,
        "total_stop_events",
        F.col("avg_delay").alias("avg_arrival_delay_min"),
        F.col("median_delay").alias("median_arrival_delay"),
        "pct_on_time",
        "pct_delayed_3min",
        "total_cancelled",
    )


def _newest_attributes(flagged: DataFrame, key: str, attributes: Iterable[str]) -> DataFrame:
    """One row per non-NULL key with the attributes of its newest day, the greatest ones on that day.

    Distinct (key, attributes) come first, with map-side combining; choosing among them is then a small job.
    """
    names = list(attributes)
    seen = flagged.where(F.col(key).isNotNull()).groupBy(key, *names).agg(F.max("operating_day").alias("last_day"))
    newest = Window.partitionBy(key).orderBy(
        F.col("last_day").desc_nulls_last(), *[F.col(name).desc_nulls_last() for name in names]
    )
    return seen.withColumn("age", F.row_number().over(newest)).where("age = 1").select(key, *names)


#: Key and attributes of each dimension.
DIMENSIONS = {
    "dim_stations": ("station_code", ("station_name", "sloid")),
    "dim_operators": ("operator_id", ("operator_abbr", "operator_name")),
    "dim_transport_types": ("transport_type", ("product_id",)),
}


def attribute_log(flagged: DataFrame, dimension: str) -> DataFrame:
    """The distinct (operating_day, key, attributes) of a dimension, which it can be made from instead of the stops."""
    key, attributes = DIMENSIONS[dimension]
    return flagged.where(F.col(key).isNotNull()).select("operating_day", key, *attributes).distinct()


def dim_stations(flagged: DataFrame) -> DataFrame:
    """From `stops_flagged`, like the facts: a station with cancelled stops only has fact rows too."""
    return _newest_attributes(flagged, *DIMENSIONS["dim_stations"])


def dim_operators(flagged: DataFrame) -> DataFrame:
    return _newest_attributes(flagged, *DIMENSIONS["dim_operators"])


def dim_transport_types(flagged: DataFrame) -> DataFrame:
    code = F.col("transport_type")
    description = (
        F.when(code == "IC", "InterCity")
        .when(code == "IR", "InterRegio")
        .when(code == "RE", "RegioExpress")
        .when(code == "R", "Regional train")
        .when(code == "S", "Suburban train")
        .when(code == "Bus", "Bus service")
        .otherwise(F.concat(F.lit("Other: "), code))
    )
    return _newest_attributes(flagged, *DIMENSIONS["dim_transport_types"]).withColumn("description", description)


def star_join(fact: DataFrame, *dimensions: tuple[DataFrame, str]) -> DataFrame:
    """Every fact row with the attributes of its dimensions, given as (dimension, key).

    No broadcast is forced: Spark broadcasts a dimension whose measured size allows it.
    """
    for dimension, key in dimensions:
        fact = fact.join(dimension, key, "left")
    return fact
