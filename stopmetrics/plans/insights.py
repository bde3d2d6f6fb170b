"""Punctuality questions over `int_delays` or `stops_flagged` rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopmetrics.functions.measures import (
    SIGNIFICANT_DELAY_MIN,
    day_of_week,
    hour_of_day,
    percent,
    season,
)
from stopmetrics.plans.warehouse import arrival_delay, departure_delay, has_measured_status

_DELAY = "arrival_delay_min"


def _punctuality(delays: DataFrame, *keys: Column | str) -> DataFrame:
    measured = F.count(_DELAY)
    return delays.groupBy(*keys).agg(
        measured.alias("measured_stops"),
        F.avg(_DELAY).alias("avg_delay_min"),
        percent(F.count_if(F.col(_DELAY) <= 0), measured).alias("pct_on_time"),
        percent(F.count_if(F.col(_DELAY) >= SIGNIFICANT_DELAY_MIN), measured).alias("pct_delayed_3min"),
    )


def tile_delay_by_type(delays: DataFrame) -> DataFrame:
    return delays.groupBy("transport_type").agg(
        F.avg(_DELAY).alias("avg_delay_min"), F.count(_DELAY).alias("measured_stops")
    )


def tile_on_time_trend(delays: DataFrame) -> DataFrame:
    trend = delays.groupBy("operating_day", "transport_type").agg(
        percent(F.count_if(F.col(_DELAY) <= 0), F.count(_DELAY)).alias("pct_on_time"),
        F.count(_DELAY).alias("measured_stops"),
    )
    return trend.orderBy("operating_day", "transport_type")


def tile_hour_weekday(delays: DataFrame) -> DataFrame:
    """Heat map cells by hour of the scheduled arrival and weekday of the operating day (0 is Monday)."""
    return delays.groupBy(
        hour_of_day(F.col("scheduled_arrival_at")).alias("hour"), day_of_week(F.col("operating_day")).alias("weekday")
    ).agg(F.avg(_DELAY).alias("avg_delay_min"), F.count(_DELAY).alias("measured_stops"))


def _worst(delays: DataFrame, names: Iterable[str], min_events: int, k: int) -> DataFrame:
    keys = list(names)
    ranked = delays.groupBy(*keys).agg(
        F.count(_DELAY).alias("measured_stops"), F.avg(_DELAY).alias("avg_delay_min")
    )
    return (
        ranked.where(F.col("measured_stops") >= min_events)
        .orderBy(F.desc("avg_delay_min"), *[F.col(name).asc_nulls_last() for name in keys])
        .limit(k)
    )


def worst_lines(delays: DataFrame, min_events: int = 30, k: int = 10) -> DataFrame:
    return _worst(delays, ("line_name",), min_events, k)


def worst_stations(delays: DataFrame, min_events: int = 30, k: int = 10) -> DataFrame:
    return _worst(delays, ("station_name", "station_code"), min_events, k)


def season_profile(delays: DataFrame) -> DataFrame:
    return _punctuality(delays, season(F.col("operating_day")).alias("season"))


def commuter_vs_intercity(delays: DataFrame, commuter: str = "S", intercity: str = "IC") -> DataFrame:
    return _punctuality(delays.where(F.col("transport_type").isin(commuter, intercity)), "transport_type")


def cancellation_rate(flagged: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    cancelled = F.count_if("is_cancelled")
    return flagged.groupBy("transport_type").agg(
        total.alias("total_stop_events"),
        cancelled.alias("total_cancelled"),
        percent(cancelled, total).alias("pct_cancelled"),
    )


def unknown_status_count(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("transport_type").agg(
        F.count_if(F.col("arrival_status") == "UNKNOWN").alias("unknown_stops"),
        F.count(F.lit(1)).alias("total_stop_events"),
    )


def tiles(delays: DataFrame) -> DataFrame:
    """All tiles in one pass: per transport type, per day and type, per hour and weekday, and per season.

    `tile` names the grouping; columns that do not belong to it are NULL. Rows collapse to one count per day, type and hour
    with map-side combining before they are multiplied by the number of groupings.
    """
    day, late = F.col("operating_day"), F.col(_DELAY) >= SIGNIFICANT_DELAY_MIN
    hour = hour_of_day(F.col("scheduled_arrival_at")).alias("hour")
    cells = delays.groupBy("operating_day", "transport_type", hour).agg(
        F.count(_DELAY).alias("n"),
        F.sum(_DELAY).alias("total"),
        F.count_if(F.col(_DELAY) <= 0).alias("on_time"),
        F.count_if(late).alias("late"),
    )
    cells = cells.withColumns({"weekday": day_of_week(day), "season": season(day)})
    by_tile = {
        "delay_by_type": ["transport_type"],
        "on_time_trend": ["operating_day", "transport_type"],
        "hour_weekday": ["hour", "weekday"],
        "season_profile": ["season"],
    }
    columns = ["transport_type", "operating_day", "hour", "weekday", "season"]
    grouped = cells.groupingSets([[F.col(name) for name in names] for names in by_tile.values()], *columns).agg(
        F.grouping_id().alias("grouping"),
        F.sum("n").alias("measured_stops"),
        F.sum("total").alias("total"),
        F.sum("on_time").alias("on_time"),
        F.sum("late").alias("late"),
    )
    tile = F.lit(None).cast("string")
    for name, held in by_tile.items():
        number = sum(1 << place for place, column in enumerate(reversed(columns)) if column not in held)
        tile = F.when(F.col("grouping") == number, name).otherwise(tile)
    return grouped.select(
        tile.alias("tile"),
        *columns,
        "measured_stops",
        (F.col("total") / F.nullif("measured_stops", F.lit(0))).alias("avg_delay_min"),
        percent(F.col("on_time"), F.col("measured_stops")).alias("pct_on_time"),
        percent(F.col("late"), F.col("measured_stops")).alias("pct_delayed_3min"),
    )


def delay_chains(flagged: DataFrame) -> DataFrame:
    """(operating_day, trip_id, chain, station_code, first_delay, n_stops, max_delay): each run of late stops in a row.

    The station is the one where the run starts. Stops count that have a day, a trip, a station and a measured delay, by
    their time (stops without one last, as ordered by station). A trip holds one row per station at most, so a group of the
    window has no more rows than there are stations, whatever share of all rows a trip has; groups of chains keep the
    window's partitioning and need no shuffle of their own.
    """
    at = F.coalesce("scheduled_departure_at", "scheduled_arrival_at")
    stops = (
        flagged.where(~F.col("is_cancelled") & has_measured_status())
        .select("operating_day", "trip_id", "station_code", at.alias("at"), arrival_delay().alias("arr"))
        .dropna(subset=["operating_day", "trip_id", "station_code", "arr"])
    )
    order = [F.col("at").asc_nulls_last(), F.col("station_code")]
    along = Window.partitionBy("operating_day", "trip_id").orderBy(*order)
    late = F.col("arr") >= SIGNIFICANT_DELAY_MIN
    starts = late & ~F.coalesce(F.lag("arr").over(along) >= SIGNIFICANT_DELAY_MIN, F.lit(False))
    placed = stops.withColumns({"starts": starts.cast("int"), "place": F.row_number().over(along)})
    numbered = placed.withColumn("chain", F.sum("starts").over(along))
    first = F.min_by(F.struct("station_code", "arr"), "place")
    runs = numbered.where(late).groupBy("operating_day", "trip_id", "chain").agg(
        first.alias("first"), F.count(F.lit(1)).alias("n_stops"), F.max("arr").alias("max_delay")
    )
    return runs.select(
        "operating_day", "trip_id", "chain", "first.station_code", F.col("first.arr").alias("first_delay"), "n_stops", "max_delay"
    )


def chain_origins(flagged: DataFrame) -> DataFrame:
    """Per station: how many delay chains start there, over how many stops they run, and with what delay they start."""
    return delay_chains(flagged).groupBy("station_code").agg(
        F.count(F.lit(1)).alias("n_chains"),
        F.sum("n_stops").alias("late_stops"),
        F.avg("n_stops").alias("avg_length"),
        F.max("n_stops").alias("max_length"),
        F.avg("first_delay").alias("avg_first_delay"),
    )


def hub_propagation(flagged: DataFrame) -> DataFrame:
    """Per station: the delay added during its stops, and how often a late arrival is still late one stop on.

    The next stop of a trip is looked up in two levels. Each trip is cut into half hours, and stops whose
    follower is in the same half hour are summed per station at once. The last stop of a half hour stays a row
    and finds its follower at the head of the trip's next half hour. No window then spans a whole trip of stops:
    a trip that holds a large share of all rows is spread over its half hours, and holds at most one row per
    station to begin with.
    """
    at = F.coalesce("scheduled_departure_at", "scheduled_arrival_at")
    half_hour = F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date")) * 48 + F.floor(
        (F.hour(at) * 60 + F.minute(at)) / 30
    ).cast("int")
    late = F.col("arr") >= SIGNIFICANT_DELAY_MIN
    stops = (
        flagged.where(~F.col("is_cancelled") & has_measured_status())
        .select(
            "operating_day",
            "trip_id",
            "station_code",
            at.alias("at"),
            half_hour.alias("slot"),
            arrival_delay().alias("arr"),
            departure_delay().alias("dep"),
        )
        .where(F.col("arr").isNotNull())
    )
    within = Window.partitionBy("operating_day", "trip_id", "slot").orderBy(
        F.col("at").asc_nulls_last(), F.col("station_code").asc_nulls_last()
    )
    linked = stops.select(
        "*",
        F.lead("arr").over(within).alias("next_arr"),
        F.first("arr").over(within).alias("head"),
    ).withColumn("is_last", F.col("next_arr").isNull())
    linked = linked.select(
        "station_code",
        "is_last",
        *[F.when(F.col("is_last"), F.col(name)).alias(name) for name in ("operating_day", "trip_id", "slot", "head")],
        "arr",
        (F.col("dep") - F.col("arr")).alias("added"),
        (F.col("next_arr") >= SIGNIFICANT_DELAY_MIN).alias("next_late"),
    )
    partial = linked.groupBy("station_code", "is_last", "operating_day", "trip_id", "slot", "head").agg(
        F.count(F.lit(1)).alias("stops"),
        F.sum("added").alias("added"),
        F.count("added").alias("n_added"),
        F.count_if(late).alias("late"),
        F.count_if(late & F.col("next_late").isNotNull()).alias("followed"),
        F.count_if(late & F.col("next_late")).alias("passed"),
    )
    # Finished sums have no trip; the station keeps each of them in a group of its own.
    across = Window.partitionBy(
        "is_last", "operating_day", "trip_id", F.when(~F.col("is_last"), F.col("station_code"))
    ).orderBy("slot")
    carried = F.when(F.col("is_last") & (F.col("late") > 0), F.col("next_head"))
    per_station = (
        partial.withColumn("next_head", F.lead("head").over(across))
        .withColumn("next_head", carried)
        .groupBy("station_code")
        .agg(
            F.sum("stops").alias("n_stops"),
            F.sum("added").alias("added"),
            F.sum("n_added").alias("n_added"),
            F.sum("late").alias("n_late_in"),
            (F.sum("followed") + F.count("next_head")).alias("followed"),
            (F.sum("passed") + F.count_if(F.col("next_head") >= SIGNIFICANT_DELAY_MIN)).alias("passed"),
        )
    )
    return per_station.select(
        "station_code",
        "n_stops",
        (F.col("added") / F.nullif("n_added", F.lit(0))).alias("avg_added_min"),
        "n_late_in",
        percent(F.col("passed"), F.col("followed")).alias("pct_late_passed_on"),
    )
