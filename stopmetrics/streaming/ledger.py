"""Loads that also take files corrected under the same name: a ledger tells what was loaded from which file."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stopmetrics.functions.typing_rules import parse_operating_day
from stopmetrics.plans.lake import create_day_table, replace_days
from stopmetrics.schema import RAW_SCHEMA
from stopmetrics.sources.stop_files import DAILY_NAME, conform, require_columns, scan_csv

_SOURCE = rf"^(.*{DAILY_NAME})"
_LEDGER = "source string, source_day string, files long, bytes long, state long, batch timestamp"


def listed_sources(spark: SparkSession, root: str) -> DataFrame:
    """(source, source_day, files, bytes, state) of the daily files, or folders of part files, under `root`.

    `state` changes with the path, length or modification time of any file. Only the listing is read, no content.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listing = reader.option("pathGlobFilter", "{*_istdaten.csv,part-*}").load(root).select("path", "length", "modificationTime")
    path = F.url_decode(F.regexp_replace("path", r"\+", "%2B"))
    named = listing.select(
        F.regexp_extract(path, _SOURCE, 1).alias("source"),
        F.regexp_extract(path, _SOURCE, 2).alias("source_day"),
        "length",
        F.xxhash64("path", "length", "modificationTime").alias("state"),
    )
    return named.where("source <> ''").groupBy("source", "source_day").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor("state").alias("state")
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries of the ledger; none where nothing was loaded yet."""
    try:
        return spark.read.schema(_LEDGER).parquet(ledger)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


def changed_sources(listing: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows of `listing` whose source is not in the ledger, or not in its present state."""
    latest = entries.groupBy("source").agg(F.max_by("state", "batch").alias("known"))
    return listing.join(latest, "source", "left").where("known IS NULL OR known <> state").drop("known")


def load_changed(
    spark: SparkSession, root: str, table: str, ledger: str, location: str | None = None, multiline: bool = False
) -> list[str]:
    """Load every daily CSV file under `root` that is new or changed since the last load; returns their days.

    Each file replaces its day in `table`; rows of another day than the file's are dropped. The one pass that writes also
    notes whose rows it met: a file without rows of its day fails the load, and clears nothing. The ledger gets its
    entries after the table is written, so a load that was stopped between them is done again, with the same result, and
    a load with nothing new writes nothing. Two files for one day fail before anything is read. The driver holds one
    entry per changed file. All changed files must share one header. Days whose file disappeared stay.
    """
    changed = changed_sources(listed_sources(spark, root), read_ledger(spark, ledger)).collect()
    create_day_table(spark.createDataFrame([], RAW_SCHEMA), table, location)
    if not changed:
        return []
    days = sorted(row.source_day for row in changed)
    if len(set(days)) < len(days):
        raise ValueError("Two changed files hold one day.")
    rows = require_columns(scan_csv(spark, [_literal(row.source) for row in changed], multiline))
    file_day = F.regexp_extract("_metadata.file_path", _SOURCE, 2).alias("source_day")
    rows = rows.select("*", file_day)
    own = parse_operating_day(F.col("BETRIEBSTAG")) == F.col("source_day").cast("date")
    kept = conform(rows.where(own))
    counts = Observation()
    counted = kept.observe(counts, F.collect_set("source_day").alias("held"))  # a value per changed file at most
    days_held = set()
    if not kept.isEmpty():  # ends at the first row; adaptive execution would drop the metrics of a plan without any
        replace_days(counted.drop("source_day"), table, days, filled=days)
        days_held = set(counts.get["held"])
    if days_held < set(days):
        raise ValueError(f"No stop events of their day in the files of {', '.join(sorted(set(days) - days_held))}.")
    batch = dt.datetime.now(dt.timezone.utc)
    entries = [(row.source, row.source_day, row.files, row.bytes, row.state, batch) for row in changed]
    spark.createDataFrame(entries, _LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    spark.catalog.refreshTable(table)
    return days


def _literal(path: str) -> str:
    """The path as a pattern that matches nothing else."""
    return "".join(f"\\{letter}" if letter in "\\{}[]*?" else letter for letter in path)
