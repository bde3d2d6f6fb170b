"""Daily stop-event files: CSV and Parquet readers, and the gates a file has to pass."""

from __future__ import annotations

import re
from collections.abc import Iterable
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopmetrics.schema import NA_TOKENS, RAW_COLUMNS, REQUIRED_COLUMNS

# Fixed value: how a daily file, or the folder a Spark job wrote for that day, is named; leftovers such as `.csv.part` are not.
DAILY_NAME = r"(\d{4}-\d{2}-\d{2})_istdaten\.csv(?=$|/)"

CSV_OPTIONS = {
    "sep": ";",
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    # Check each file's header against the names in use: a file with another column order is an error, never
    # silently read by position.
    "enforceSchema": "false",
}


def blank_na(df: DataFrame) -> DataFrame:
    """NULL for the texts a pandas reader takes for missing; one projection, no trimming."""
    return df.select(
        *[
            F.when(~F.col(f"`{name}`").isin(*NA_TOKENS), F.col(f"`{name}`")).alias(name)
            if kind == "string"
            else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def scan_csv(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Semicolon CSV with a header; every column is text, named by the header.

    All files behind `path` must share one header. A row of too few fields ends in NULLs; one with more fields than the
    header fails the job that reads it. `multiline` allows line breaks within quotes, at the price of one task per file.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multiline)
    layout = reader.csv(path).schema
    checked = reader.options(**surplus_options()).schema(layout.add(UNPARSED, "string")).csv(path)
    return blank_na(without_surplus(checked, len(layout) - 1))


UNPARSED = "_unparsed"
_MESSAGE = "A CSV row has more fields than its header: "


def surplus_options() -> dict[str, str]:
    """Reader options that keep the text of rows with another number of fields in the column UNPARSED."""
    return {"columnNameOfCorruptRecord": UNPARSED, "columnPruning": "false"}


def without_surplus(df: DataFrame, columns: int) -> DataFrame:
    """`df` without its column UNPARSED; fails on a row with more fields than `columns`."""
    # Possessive: Java would recurse per character otherwise. A doubled quote ends one quoted run and starts the next.
    fields = F.size(F.split(F.regexp_replace(UNPARSED, r'"[^"]*+"', ""), ";"))
    # Spark refuses to read that column alone, as a count would: the message names a column of the file too.
    first = F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit(""))
    surplus = F.raise_error(F.concat(F.lit(_MESSAGE), first, F.lit(", ... in "), F.col(UNPARSED))).cast("boolean")
    fits = F.when(F.col(UNPARSED).isNotNull() & (fields > columns), surplus).otherwise(F.lit(True))
    return df.where(fits).drop(UNPARSED)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_stop_events(spark: SparkSession, paths: str | Iterable[str], multiline: bool = False) -> DataFrame:
    """Read CSV and Parquet paths or globs into one DataFrame, matched by column name.

    The reader follows the suffix. Several paths are united as text, columns absent from one of them being NULL.
    `multiline` is for CSV files with line breaks within quotes.
    """
    names = [paths] if isinstance(paths, str) else list(paths)
    readers = {".csv": lambda session, name: scan_csv(session, name, multiline), ".parquet": scan_parquet}
    suffixes = [PurePosixPath(name).suffix.lower() for name in names]
    for suffix in suffixes:
        if suffix not in readers:
            raise ValueError(f"Unsupported file extension: {suffix}. Use .csv or .parquet.")
    if not names:
        raise ValueError("No paths given.")
    frames = [readers[suffix](spark, name) for suffix, name in zip(suffixes, names)]
    if len(frames) == 1:
        return frames[0]
    united = as_text(frames[0])
    for frame in frames[1:]:
        united = united.unionByName(as_text(frame), allowMissingColumns=True)
    return united


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])


def conform(df: DataFrame) -> DataFrame:
    """All raw columns as text in file order, absent ones NULL; further columns follow as text."""
    extra = [name for name in df.columns if name not in RAW_COLUMNS]
    known = [F.col(name) if name in df.columns else F.lit(None).alias(name) for name in RAW_COLUMNS]
    return as_text(df.select(*known, *[F.col(f"`{name}`") for name in extra]))


def daily_files(spark: SparkSession, root: str, limit: int | None = None) -> list[tuple[str, str]]:
    """(day, path) of the daily files under `root`, newest first. Lists names only, reads no file.

    Names and part files that do not belong to a daily file or folder are left out by a glob while listing; the driver
    holds one entry per daily file.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listing = reader.option("pathGlobFilter", "{*_istdaten.csv,part-*}").load(root)
    found = {}
    for uri in listing.inputFiles():
        match = re.search(rf"^.*?{DAILY_NAME}", unquote(uri))
        if match:
            found.setdefault(match.group(0), match.group(1))
    newest = sorted(((day, path) for path, day in found.items()), reverse=True)
    return newest[:limit]


def scan_latest(spark: SparkSession, root: str, multiline: bool = False) -> DataFrame:
    """Rows of the newest daily file only; no other file is opened."""
    newest = daily_files(spark, root, limit=1)
    if not newest:
        raise ValueError(f"No daily files found under {root}.")
    escaped = re.sub(r"([\\{}\[\]*?])", r"\\\1", newest[0][1])  # the name is a path, not a pattern
    return read_stop_events(spark, escaped, multiline)


def require_columns(
    df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS, in_name_order: bool = False
) -> DataFrame:
    """Return `df`, or fail naming the missing columns. Looks at the schema only."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        listed = sorted(missing) if in_name_order else missing
        raise ValueError(f"Missing required columns: {', '.join(listed)}")
    return df


def require_rows(df: DataFrame, label: str = "input") -> DataFrame:
    """Return `df`, or fail when it has no rows. Stops at the first row found."""
    if df.isEmpty():
        raise ValueError(f"No stop events in {label}.")
    return df
