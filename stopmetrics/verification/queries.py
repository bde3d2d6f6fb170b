"""The registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopmetrics.functions import measures, typing_rules
from stopmetrics.operators import profile, quality, slices
from stopmetrics.plans import insights, lake, warehouse
from stopmetrics.plans.build import build_warehouse
from stopmetrics.scratch import freed_shuffles, new_folder, written
from stopmetrics.sources import archive, stop_files
from stopmetrics.streaming.ingest import incremental_ingest
from stopmetrics.streaming.ledger import load_changed
from stopmetrics.verification.stop_view import listing_pages, loaded_days, raw_stop_events

Query = Callable[[SparkSession, str], DataFrame]

BASE_URL = "https://data.example.org/en/dataset/listing"
KEYS = ("FAHRT_BEZEICHNER", "BPUIC")
RELOADED_DAY = "2026-01-05"
FIRST_DAY, LAST_DAY = dt.date(2026, 1, 10), dt.date(2026, 2, 20)
CHOSEN_TYPES = ("IC", "S")

# Blanks around a time belong to the value, so the CSV writer must not trim them.
_WRITE_OPTIONS = {
    "sep": ";",
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Daily files are as long as all their rows in text; Spark's readers tell a compressed file by its name.
_DAILY_OPTIONS = _WRITE_OPTIONS | {"compression": "gzip"}


def _write_csv(df: DataFrame, label: str) -> str:
    path = f"{new_folder(df.sparkSession, label)}/{label}.csv"
    df.write.options(**_WRITE_OPTIONS).csv(path)
    return path


def _write_parquet(df: DataFrame, label: str) -> str:
    path = f"{new_folder(df.sparkSession, label)}/{label}.parquet"
    df.write.parquet(path)
    return path


def _write_daily_csv(raw: DataFrame, label: str) -> str:
    """One folder per day, named like the daily file; a day with most of the rows is split over part files."""
    root = new_folder(raw.sparkSession, label)
    day = typing_rules.parse_operating_day(F.col("BETRIEBSTAG")).cast("string")
    named = raw.withColumn("file", F.concat(day, F.lit("_istdaten.csv")))
    with freed_shuffles(raw.sparkSession):
        named.hint("rebalance", "file").write.options(**_DAILY_OPTIONS).partitionBy("file").csv(root)
    return root


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def _stored(spark: SparkSession, table: str, location: str) -> DataFrame:
    """The rows of an external table by its files, after the table's name is dropped from the catalog."""
    schema = spark.table(table).schema
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(schema).parquet(location)


def _raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(raw_stop_events(spark, sf_dir))


def _typed(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _raw(lambda raw: operator(warehouse.typed_stops(raw)))


def _flagged(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _raw(lambda raw: operator(warehouse.stops_flagged(raw)))


def _staged(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _raw(lambda raw: operator(warehouse.stg_stop_events(raw)))


def _delays(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _staged(lambda staged: operator(warehouse.int_delays(staged)))


def _pages(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(listing_pages(spark, sf_dir))


# Sources and sinks


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stop_files.scan_csv(spark, _write_csv(raw_stop_events(spark, sf_dir), "scan_csv"))


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stop_files.scan_parquet(spark, _write_parquet(raw_stop_events(spark, sf_dir), "scan_parquet"))


def read_stop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written in ISO form come from CSV, the others from Parquet."""
    raw = raw_stop_events(spark, sf_dir)
    iso = F.col("BETRIEBSTAG").contains("-")
    paths = [_write_csv(raw.where(iso), "read_csv"), _write_parquet(raw.where(~iso), "read_parquet")]
    return stop_files.read_stop_events(spark, paths)


def scan_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _write_daily_csv(raw_stop_events(spark, sf_dir), "scan_latest")
    return stop_files.scan_latest(spark, root)


def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _write_csv(raw_stop_events(spark, sf_dir), "convert")
    return lake.csv_to_parquet(spark, source, new_folder(spark, "converted"))


def lake_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days laid out, then one of them again: the others stay. Rows without a readable day come with three loads of two
    files; the last one replaces those of the first."""
    root = new_folder(spark, "raw")
    raw = raw_stop_events(spark, sf_dir)
    lake.write_lake(raw, root)
    again = typing_rules.parse_operating_day(F.col("BETRIEBSTAG")) == F.lit(RELOADED_DAY).cast("date")
    lake.write_lake(raw.where(again), root, target_day=RELOADED_DAY)
    unreadable = raw.withColumn("BETRIEBSTAG", F.lit("?"))
    for source, ending in (("a.csv", "7"), ("b.csv", "3"), ("a.csv", "17")):
        lake.write_lake(unreadable.where(F.col("FAHRT_BEZEICHNER").endswith(ending)), root, source=source)
    return lake.read_lake(spark, root)


def create_day_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created, loaded, created again: the second create keeps the rows."""
    raw = raw_stop_events(spark, sf_dir)
    table, location = _table_name("created"), new_folder(spark, "created")
    lake.create_day_table(raw, table, location)
    lake.replace_days(raw, table)
    lake.create_day_table(raw, table, location)
    return _stored(spark, table, location)


def replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, then one day loaded again from corrected input: its cancelled stops are gone."""
    raw = raw_stop_events(spark, sf_dir)
    table = _table_name("replaced")
    location = new_folder(spark, "replaced")
    lake.load_table(raw, table, location)
    corrected = raw.where(~typing_rules.normalize_flag(F.col("FAELLT_AUS_TF")))
    lake.replace_day(corrected, table, RELOADED_DAY)
    return _stored(spark, table, location)


def add_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older files hold the days in ISO form and no day column; the newer ones are a table that got its SLOID late."""
    raw = raw_stop_events(spark, sf_dir)
    iso = F.col("BETRIEBSTAG").contains("-")
    older = _write_parquet(raw.where(iso), "older")
    table, location = _table_name("newer"), new_folder(spark, "newer")
    lake.create_day_table(raw.drop("SLOID"), table, location)
    lake.replace_days(raw.where(~iso), table)
    spark.sql(f"DROP TABLE {table}")
    return lake.read_days(spark, older, location)


def target_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    available = archive.available_days(listing_pages(spark, sf_dir))
    return archive.target_days(available, mode="date", run_date="2026-02-10", backfill_days=7)


def pending_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.pending_days(
        archive.available_days(listing_pages(spark, sf_dir)), loaded_days(spark, sf_dir)
    )


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _write_daily_csv(raw_stop_events(spark, sf_dir), "arriving")
    table, location = _table_name("ingested"), new_folder(spark, "ingested")
    incremental_ingest(
        spark,
        f"{root}/file=*",
        table,
        checkpoint=new_folder(spark, "ingest-state"),
        location=location,
        files_per_batch=None,
    ).awaitTermination()
    return _stored(spark, table, location)


def ingest_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, one file corrected under its name and loaded again, then a third load that finds nothing new."""
    raw = raw_stop_events(spark, sf_dir)
    root = _write_daily_csv(raw, "corrected")
    table, location, ledger = _table_name("corrected"), new_folder(spark, "corrected-days"), new_folder(spark, "ledger")
    load_changed(spark, root, table, ledger, location)
    of_day = typing_rules.parse_operating_day(F.col("BETRIEBSTAG")) == F.lit(RELOADED_DAY).cast("date")
    corrected = raw.where(of_day & ~typing_rules.normalize_flag(F.col("FAELLT_AUS_TF")))
    with freed_shuffles(spark):
        corrected.write.mode("overwrite").options(**_DAILY_OPTIONS).csv(f"{root}/file={RELOADED_DAY}_istdaten.csv")
    for expected in ([RELOADED_DAY], []):
        days = load_changed(spark, root, table, ledger, location)
        if days != expected:
            raise ValueError(f"Loaded {days}, not {expected}.")
    return _stored(spark, table, location)


def _refreshed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A whole warehouse, of which one day is then refreshed from corrected input."""
    raw = raw_stop_events(spark, sf_dir)
    root = new_folder(spark, "refreshed")
    build_warehouse(raw, root)
    corrected = raw.where(~typing_rules.normalize_flag(F.col("FAELLT_AUS_TF")))
    return build_warehouse(corrected, root, days=[RELOADED_DAY])


# Typing


def _with(name: str, value) -> Query:
    return _raw(lambda raw: raw.select(*KEYS, value().alias(name)))


def parse_timestamp(raw: DataFrame) -> DataFrame:
    stamps = ("ANKUNFTSZEIT", "AN_PROGNOSE", "ABFAHRTSZEIT", "AB_PROGNOSE")
    parsed = [typing_rules.parse_timestamp(F.col(name)).alias(name.lower()) for name in stamps]
    return raw.select(*KEYS, *parsed)


def _with_whole_delay(raw: DataFrame) -> DataFrame:
    return warehouse.typed_stops(raw).select(
        "trip_id", "station_code", warehouse.arrival_delay().alias("arrival_delay_min")
    )


def delay_flags(raw: DataFrame) -> DataFrame:
    delay = F.col("arrival_delay_min")
    return _with_whole_delay(raw).select(
        "*",
        measures.is_delayed(delay).alias("is_delayed"),
        measures.is_significantly_delayed(delay).alias("is_significantly_delayed"),
    )


def calendar_parts(typed: DataFrame) -> DataFrame:
    day = F.col("operating_day")
    return typed.select(
        "trip_id",
        "station_code",
        measures.hour_of_day(F.col("scheduled_arrival_at")).alias("arrival_hour"),
        measures.day_of_week(day).alias("weekday"),
        measures.season(day).alias("season"),
    )


def int_delays(staged: DataFrame) -> DataFrame:
    return warehouse.int_delays(staged).select(
        "operating_day",
        "trip_id",
        "station_code",
        "transport_type",
        "arrival_status",
        "arrival_delay_min",
        "is_delayed",
        "is_significantly_delayed",
    )


def _star(raw: DataFrame, station: bool) -> DataFrame:
    """Fact and dimensions share one written staging table instead of each deriving it."""
    flagged = written(warehouse.stops_flagged(raw), "flagged")
    types = (warehouse.dim_transport_types(flagged), "transport_type")
    if station:
        return warehouse.star_join(
            warehouse.fct_station_delays(flagged), (warehouse.dim_stations(flagged), "station_code"), types
        )
    return warehouse.star_join(
        warehouse.fct_daily_delays(flagged), (warehouse.dim_operators(flagged), "operator_id"), types
    )


def _state(flagged: DataFrame) -> DataFrame:
    return written(warehouse.delay_state(flagged), "state")


def queries() -> dict[str, Query]:
    return {
        "scan_csv": scan_csv,
        "scan_parquet": scan_parquet,
        "read_stop_events": read_stop_events,
        "scan_latest": scan_latest,
        "require_columns": _raw(stop_files.require_columns),
        "require_rows": _raw(stop_files.require_rows),
        "csv_to_parquet": csv_to_parquet,
        "lake_layout": lake_layout,
        "create_day_table": create_day_table,
        "replace_day": replace_day,
        "add_missing_column": add_missing_column,
        "load_check": _raw(lambda raw: lake.load_check(lake.with_day(raw))),
        "archive_index": _pages(lambda pages: archive.archive_index(pages, BASE_URL)),
        "archive_latest_n": _pages(lambda pages: archive.archive_latest_n(pages, BASE_URL, 5)),
        "available_days": _pages(archive.available_days),
        "target_days": target_days,
        "pending_days": pending_days,
        "parse_timestamp": _raw(parse_timestamp),
        "parse_operating_day": _with(
            "operating_day", lambda: typing_rules.parse_operating_day(F.col("BETRIEBSTAG"))
        ),
        "normalize_status": _with("status", lambda: typing_rules.normalize_status(F.col("AN_PROGNOSE_STATUS"))),
        "normalize_flag": _with("is_cancelled", lambda: typing_rules.normalize_flag(F.col("FAELLT_AUS_TF"))),
        "delay_minutes": _with("delay_min", measures.delay_minutes),
        "null_label": _with("label", lambda: typing_rules.null_label(F.col("AN_PROGNOSE_STATUS"))),
        "whole_minute_delay": _raw(_with_whole_delay),
        "delay_flags": _raw(delay_flags),
        "calendar_parts": _typed(calendar_parts),
        "rename_snake_case": _raw(warehouse.rename_snake_case),
        "filter_delay_status": _raw(slices.filter_delay_status),
        "filter_computable": _raw(slices.filter_computable),
        "edge_null_arrivals": _raw(slices.edge_null_arrivals),
        "edge_non_delay_status": _raw(slices.edge_non_delay_status),
        "edge_cancelled": _raw(slices.edge_cancelled),
        "edge_preview": _raw(slices.edge_preview),
        "delay_outliers": _raw(slices.delay_outliers),
        "delay_outliers_preview": _raw(lambda raw: slices.delay_outliers(raw, limit=20)),
        "delay_range": _raw(lambda raw: slices.delay_range(raw).select(*KEYS, "delay_min")),
        "exclude_pass_through": _raw(slices.exclude_pass_through),
        "slice_dates_types": _flagged(
            lambda flagged: slices.slice_dates_types(
                warehouse.fct_daily_delays(flagged), FIRST_DAY, LAST_DAY, CHOSEN_TYPES
            )
        ),
        "profile_overview": _raw(profile.profile_overview),
        "column_types": _raw(profile.column_types),
        "null_rates": _raw(profile.null_rates),
        "column_profile": _raw(profile.column_profile),
        "value_distribution": _raw(lambda raw: profile.value_distribution(raw, "VERKEHRSMITTEL_TEXT")),
        "top_values": _raw(lambda raw: profile.top_values(raw, "HALTESTELLEN_NAME", 12)),
        "delay_summary": _raw(profile.delay_summary),
        "delay_summary_filtered": _raw(lambda raw: profile.delay_summary(raw, filtered=True)),
        "kpi_table": _raw(profile.kpi_table),
        "formula_validation": _raw(profile.formula_validation),
        "delay_histogram": _raw(profile.delay_histogram),
        "range_coverage": _raw(profile.range_coverage),
        "executive_summary": _raw(profile.executive_summary),
        "status_breakdown": _raw(profile.status_breakdown),
        "stg_stop_events": _raw(warehouse.stg_stop_events),
        "dedup_stops": _typed(warehouse.dedup_stops),
        "int_delays": _staged(int_delays),
        "fct_daily_delays": _flagged(warehouse.fct_daily_delays),
        "fct_station_delays": _flagged(warehouse.fct_station_delays),
        "dim_stations": _flagged(warehouse.dim_stations),
        "dim_operators": _flagged(warehouse.dim_operators),
        "dim_transport_types": _flagged(warehouse.dim_transport_types),
        "star_join": _raw(lambda raw: _star(raw, station=True)),
        "star_join_daily": _raw(lambda raw: _star(raw, station=False)),
        "test_delay_reasonable": _staged(lambda staged: quality.test_delay_reasonable(int_delays(staged))),
        "test_not_null": _staged(quality.test_not_null),
        "test_unique": _typed(quality.test_unique),
        "test_accepted_values": _typed(quality.test_accepted_values),
        "tile_delay_by_type": _delays(insights.tile_delay_by_type),
        "tile_on_time_trend": _delays(insights.tile_on_time_trend),
        "tile_hour_weekday": _delays(insights.tile_hour_weekday),
        "worst_lines": _delays(insights.worst_lines),
        "worst_stations": _delays(insights.worst_stations),
        "season_profile": _delays(insights.season_profile),
        "commuter_vs_intercity": _delays(insights.commuter_vs_intercity),
        "hub_propagation": _flagged(insights.hub_propagation),
        "cancellation_rate": _flagged(insights.cancellation_rate),
        "unknown_status_count": _flagged(insights.unknown_status_count),
        "incremental_ingest": stream_ingest,
        "ingest_corrected": ingest_corrected,
        "refresh_daily_fact": lambda spark, sf_dir: _refreshed(spark, sf_dir)["fct_daily_delays"],
        "build_checks": _raw(lambda raw: build_warehouse(raw, new_folder(raw.sparkSession, "checked"))["checks"]),
        "refresh_stations": lambda spark, sf_dir: _refreshed(spark, sf_dir)["dim_stations"],
        "monthly_line_delays": _flagged(lambda flagged: warehouse.monthly_line_delays(_state(flagged))),
        "state_histogram": _flagged(lambda flagged: warehouse.state_histogram(_state(flagged))),
        "insight_tiles": _delays(insights.tiles),
        "delay_chains": _flagged(insights.delay_chains),
        "chain_origins": _flagged(insights.chain_origins),
    }
