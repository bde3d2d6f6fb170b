"""Incremental load: each new daily file replaces its day in the day table, exactly once in effect."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stopmetrics.functions.typing_rules import parse_operating_day
from stopmetrics.plans.lake import create_day_table, replace_day, replace_days
from stopmetrics.schema import RAW_COLUMNS, RAW_SCHEMA
from stopmetrics.sources.stop_files import (
    CSV_OPTIONS,
    DAILY_NAME,
    UNPARSED,
    blank_na,
    read_stop_events,
    require_columns,
    require_rows,
    surplus_options,
    without_surplus,
)

_SOURCE = rf"^(.*{DAILY_NAME})"
_ADDED = ("file", "source_day", "is_header")


def _check_files(spark: SparkSession, seen: list, single_files: bool) -> None:
    """Refuse a batch unless each day comes from one whole source with a header and rows. `seen` has a row per file."""
    sources: dict[str, list] = {}
    for row in seen:
        if not row.source_day:
            raise ValueError(f"{row.file} is not named YYYY-MM-DD_istdaten.csv.")
        if row.headers != 1:
            raise ValueError(f"{row.file} does not start with the expected header.")
        sources.setdefault(row.source, []).append(row)
    days = [files[0].source_day for files in sources.values()]
    if len(days) != len(set(days)):
        raise ValueError("A batch holds two sources for one day.")
    for source, files in sources.items():
        if not sum(row.n for row in files):
            raise ValueError(f"No stop events in {source}.")
        parts = {row.file for row in files} - {source}
        if parts and single_files:
            raise ValueError(f"{source} is a day split over files; load it with files_per_batch=None.")
        if parts:
            listing = spark.read.format("binaryFile").load(source).inputFiles()
            if {name.rpartition("/")[2] for name in listing} != {name.rpartition("/")[2] for name in parts}:
                raise ValueError(f"Parts of {source} were loaded before; load the whole day with reload_day.")


def _load_batch(caller: SparkSession, batch: DataFrame, table: str, single_files: bool) -> None:
    """Replace the days whose files arrived in this batch. A replayed batch gives the same table.

    One pass counts each file's headers, rows, and rows of its own day; a second one writes. Rows of another day than
    their file's are dropped, as in any day load.
    """
    own_day = parse_operating_day(F.col("BETRIEBSTAG")).cast("string") == F.col("source_day")
    counts = batch.groupBy("file", "source_day").agg(
        F.count_if("is_header").alias("headers"),
        F.count_if(~F.col("is_header")).alias("n"),
        F.count_if(~F.col("is_header") & own_day).alias("n_own"),
    )
    seen = counts.withColumn("source", F.regexp_extract("file", _SOURCE, 1)).collect()
    if not seen:
        return
    _check_files(caller, seen, single_files)
    rows = blank_na(batch.where(~F.col("is_header") & own_day).drop(*_ADDED))
    replace_days(rows, table, {row.source_day for row in seen}, {row.source_day for row in seen if row.n_own})
    # The batch runs in a session of its own; the caller's may hold the file names of the days replaced.
    caller.catalog.refreshTable(table)


def incremental_ingest(
    spark: SparkSession,
    input_glob: str,
    table: str,
    checkpoint: str,
    location: str | None = None,
    files_per_batch: int | None = 1,
    columns: Iterable[str] = RAW_COLUMNS,
) -> StreamingQuery:
    """Load all daily CSV files that arrived since the last run, then stop; returns the started query.

    With `files_per_batch=1` days load one after another, each file holding a whole day; the order is that in which the
    files were last changed, which need not be that of the days. With None everything new loads as one batch, all
    days in parallel; a day may then be a folder of part files, as Spark writes them, that appears as a whole.
    `columns` names the files' columns in order, for files of an older layout; the required ones must be among them. A
    file with another header, without rows, or with a row of more fields, and a day of which only parts are new, stop
    the load, and the next run tries them again.

    A file that changes under the same name is not loaded again: the source knows it by its name. `reload_day` takes it.
    """
    if files_per_batch not in (1, None):
        raise ValueError("files_per_batch is 1 or None: parts of a day must not be spread over batches.")
    layout = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    names = layout.fieldNames()
    require_columns(spark.createDataFrame([], layout))
    create_day_table(spark.createDataFrame([], RAW_SCHEMA), table, location)
    # Headers are read as rows, so that a file that holds nothing else is seen too.
    options = CSV_OPTIONS | surplus_options() | {"header": "false", "enforceSchema": "true"}
    reader = spark.readStream.schema(layout.add(UNPARSED, "string")).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = F.col("_metadata.file_path")
    header = F.lit(True)
    for name in names:
        header = header & F.col(f"`{name}`").eqNullSafe(F.lit(name))
    files = reader.csv(input_glob).select(
        "*",
        path.alias("file"),
        F.regexp_extract(path, _SOURCE, 2).alias("source_day"),
    )
    marked = without_surplus(files, len(names)).withColumn("is_header", header)
    return (
        marked.writeStream.foreachBatch(lambda batch, _: _load_batch(spark, batch, table, files_per_batch == 1))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def reload_day(spark: SparkSession, paths: str | Iterable[str], table: str, day: str, multiline: bool = False) -> None:
    """Load a day again from a corrected file, under the same name too, or from all part files of it."""
    raw = require_rows(require_columns(read_stop_events(spark, paths, multiline)), str(paths))
    replace_day(raw, table, day)
    spark.catalog.refreshTable(table)
