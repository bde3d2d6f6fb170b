"""Build all warehouse tables from raw stop events, each stored once and read by the next."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stopmetrics.functions.typing_rules import normalize_flag, parse_operating_day
from stopmetrics.operators import quality
from stopmetrics.operators.quality import RowCheck
from stopmetrics.operators.slices import REASONABLE_DELAY_MIN, exclude_pass_through
from stopmetrics.plans import warehouse
from stopmetrics.plans.lake import bloom_options
from stopmetrics.schema import KNOWN_STATUSES
from stopmetrics.scratch import freed_shuffles


def stop_checks() -> list[RowCheck]:
    """The checks of the stop table that a row alone can fail, all of them counted only; it has no repeats by its making."""
    delay = F.when(~F.col("is_cancelled") & warehouse.has_measured_status(), warehouse.arrival_delay())
    return [
        *quality.not_null(*quality.STOP_KEY, "scheduled_arrival_at"),
        quality.accepted_values("arrival_status", KNOWN_STATUSES),
        quality.within("arrival_delay", delay, *REASONABLE_DELAY_MIN),
    ]


def store(
    df: DataFrame,
    path: str,
    cluster: str,
    by_day: bool = True,
    cleared: Iterable[dt.date] = (),
    checks: Sequence[RowCheck] = (),
    observation: Observation | None = None,
    looked_up: Sequence[str] = (),
) -> DataFrame:
    """Write `df` to `path`, partitioned by operating day and sorted by `cluster`, and return it read back.

    Only the days that `df` holds are replaced, and the `cleared` ones emptied. The rebalance splits a day that holds most
    of the rows and joins small days into one task. `checks` are counted into `observation` by the write itself; a strict
    one that a row fails ends the write with the old days in place. Row groups get Bloom filters on the columns `looked_up`.
    """
    if by_day:
        df = quality.guarded(df, checks, "operating_day")
        balanced = df.hint("rebalance", "operating_day").sortWithinPartitions("operating_day", cluster)
        passing = quality.observed(balanced, checks, observation) if observation else balanced
        writer = passing.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer = writer.options(**bloom_options(looked_up))
        with freed_shuffles(df.sparkSession):
            writer.partitionBy("operating_day").parquet(path)
        nothing = df.sparkSession.createDataFrame([], df.drop("operating_day").schema)
        for day in cleared:
            nothing.write.mode("overwrite").parquet(f"{path}/operating_day={day.isoformat()}")
    else:
        with freed_shuffles(df.sparkSession):
            df.sortWithinPartitions(cluster).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _set_aside(df: DataFrame, root: str) -> Iterator[DataFrame]:
    """`df`, stored under `root` for the time of this block; a folder without rows stays behind.

    Deduplicated and laid out by day in one write, all stops would be on disk as two shuffles of whole rows at once. In two
    writes they are there as one shuffle and as Parquet files, which take about a quarter of it.
    """
    spark, path = df.sparkSession, f"{root}/_aside/{uuid.uuid4().hex}"
    try:
        with freed_shuffles(spark):
            df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        df.limit(0).write.mode("overwrite").parquet(path)


STOP_LOOKUPS = ("trip_id", "station_code")

_MAKE = {
    "dim_stations": warehouse.dim_stations,
    "dim_operators": warehouse.dim_operators,
    "dim_transport_types": warehouse.dim_transport_types,
}


def _report(spark: SparkSession, checks: Sequence[RowCheck], observation: Observation) -> DataFrame:
    """(check, strict, row_count, failures), a row per check, from what the write counted."""
    counts = observation.get
    rows = [(check.name, check.strict, counts["rows"], counts[check.name]) for check in checks]
    return spark.createDataFrame(rows, "check string, strict boolean, row_count long, failures long")


def build_warehouse(
    raw: DataFrame,
    root: str,
    days: Iterable[str | dt.date] | None = None,
    checks: Sequence[RowCheck] | None = None,
) -> dict[str, DataFrame]:
    """Staging, facts and dimensions under `root`; raw rows are typed and deduplicated once for all of them.

    With `days`, only these days of `raw` are staged again and their facts replaced, or cleared where `raw` has no rows of
    them; the others keep their files. Stops and facts never cross days, so the result is that of a full build. Besides
    the facts there are `delay_state`, the delay counts from which figures of any coarser key or period follow, and a log
    of the distinct attributes per day and dimension. The facts come from the state, and dimensions are made anew from
    their logs: no stop of an untouched day is read.

    The write of the stops counts the offenders of `checks`, by default those of `stop_checks`, without another scan; the
    table `checks` reports them, for the rows that this build wrote. A strict check fails that write, the first of a table,
    so no table changes.
    """
    checks = stop_checks() if checks is None else list(checks)
    observation = Observation()
    chosen = None if days is None else sorted({dt.date.fromisoformat(str(day)) for day in days})
    rows = raw if chosen is None else raw.where(parse_operating_day(F.col("BETRIEBSTAG")).isin(chosen))
    empty: list[dt.date] = []
    if chosen is not None:  # one pass over the day column alone; a day of pass-throughs only is as empty as one without rows
        day = parse_operating_day(F.col("BETRIEBSTAG")).alias("day")
        stopping = exclude_pass_through(rows, normalize_flag(F.col("DURCHFAHRT_TF")))
        held = {row[0] for row in stopping.select(day).distinct().collect()}
        empty = [day for day in chosen if day not in held]
    with _set_aside(warehouse.stops_flagged(rows), root) as stops:
        flagged = store(stops, f"{root}/stops_flagged", "transport_type", True, empty, checks, observation, STOP_LOOKUPS)
    changed = flagged if chosen is None else flagged.where(F.col("operating_day").isin(chosen))
    state = store(warehouse.delay_state(changed), f"{root}/delay_state", "transport_type", cleared=empty)
    new = state if chosen is None else state.where(F.col("operating_day").isin(chosen))
    staged = warehouse.without_cancelled(flagged)
    tables = {
        "stops_flagged": flagged,
        "checks": _report(raw.sparkSession, checks, observation),
        "stg_stop_events": staged,
        "int_delays": warehouse.int_delays(staged),
        "delay_state": state,
        "fct_daily_delays": store(
            warehouse.daily_from_state(new), f"{root}/fct_daily_delays", "transport_type", cleared=empty
        ),
        "fct_station_delays": store(
            warehouse.station_from_state(new), f"{root}/fct_station_delays", "station_code", cleared=empty
        ),
    }
    for name, make in _MAKE.items():
        key = warehouse.DIMENSIONS[name][0]
        log = store(warehouse.attribute_log(changed, name), f"{root}/log_{name}", key, cleared=empty)
        tables[name] = store(make(log), f"{root}/{name}", key, False)
    return tables
