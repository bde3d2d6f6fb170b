"""The raw lake: Parquet files laid out by day, and a day table whose days are replaced as a whole."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopmetrics.functions.typing_rules import parse_operating_day
from stopmetrics.schema import CLUSTER_COLUMN, DAY_COLUMN
from stopmetrics.sources.stop_files import conform, require_columns, require_rows, scan_csv

LOOKUP_COLUMNS = ("FAHRT_BEZEICHNER", "BPUIC")
_DATE_PARTS = {"year": "yyyy", "month": "MM", "day": "dd"}
_UNDATED = "_undated"  # Spark's listings of the days leave out names that start like this


def with_day(raw: DataFrame) -> DataFrame:
    return raw.withColumn(DAY_COLUMN, parse_operating_day(F.col("BETRIEBSTAG")))


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, multiline: bool = False) -> DataFrame:
    """Convert daily CSV to Parquet; fails on missing columns or no rows. Returns the files read back."""
    raw = require_columns(scan_csv(spark, csv_path, multiline), in_name_order=True)
    require_rows(raw, csv_path).write.mode("overwrite").parquet(parquet_path)
    return spark.read.schema(raw.schema).parquet(parquet_path)


def write_lake(raw: DataFrame, root: str, target_day: str | None = None, source: str | None = None) -> None:
    """Lay raw rows out as `root/year=YYYY/month=MM/day=DD`, replacing the days written and no others.

    All rows go to `target_day` (`YYYY-MM-DD`), whose folder alone is written, with no rows too; or each to its own
    parsed day when that is not given. The rebalance lets Spark split a day that holds most of the rows over several
    tasks, and join small days into one. Rows without a readable day are kept apart, by the name of the load's `source`:
    they replace those of the same source, those of all other loads stay. A load without a source has a name of its own.
    """
    if target_day:
        folder = dt.date.fromisoformat(target_day).strftime("year=%Y/month=%m/day=%d")
        balanced = raw.hint("rebalance", CLUSTER_COLUMN).sortWithinPartitions(CLUSTER_COLUMN)
        balanced.write.mode("overwrite").parquet(f"{root}/{folder}")
        return
    day = parse_operating_day(F.col("BETRIEBSTAG"))
    parts = list(_DATE_PARTS)
    dated = raw.select("*", *[F.date_format(day, pattern).alias(part) for part, pattern in _DATE_PARTS.items()])
    # A folder per source, overwritten as a whole: a corrected file without such rows clears its own.
    name = quote(source, safe="") if source else uuid.uuid4().hex
    raw.where(day.isNull()).write.mode("overwrite").parquet(f"{root}/{_UNDATED}/{name}")
    balanced = dated.where(day.isNotNull()).hint("rebalance", *parts).sortWithinPartitions(*parts, CLUSTER_COLUMN)
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(root)


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """All rows with year, month and day, which are NULL for rows without a readable day."""
    frames = [frame for frame in (_stored(spark, root), _undated(spark, root)) if frame is not None]
    if not frames:
        raise ValueError(f"No stop events in {root}.")
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)


def _undated(spark: SparkSession, root: str) -> DataFrame | None:
    rows = _stored(spark, f"{root}/{_UNDATED}/*")
    return rows and rows.withColumns({part: F.lit(None).cast("int") for part in _DATE_PARTS})


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def bloom_options(columns: Iterable[str]) -> dict[str, str]:
    """Parquet writer options for a Bloom filter on each of `columns`, sized by the distinct values of a row group."""
    switches = {f"parquet.bloom.filter.enabled#{name}": "true" for name in columns}
    return switches | {"parquet.bloom.filter.adaptive.enabled": "true"} if switches else {}


def create_day_table(raw: DataFrame, table: str, location: str | None = None) -> None:
    """Create `table` with the columns of `raw` plus the day, no rows, partitioned by day; keep an existing one.

    Its files carry Bloom filters on trip and station, which no sort by another column can serve.
    """
    columns = ", ".join(f"`{name}` {kind}" for name, kind in raw.dtypes if name != DAY_COLUMN)
    place = f"LOCATION '{location}'" if location else ""
    options = ", ".join(f"'{name}' '{value}'" for name, value in bloom_options(set(LOOKUP_COLUMNS) & set(raw.columns)).items())
    raw.sparkSession.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {DAY_COLUMN} DATE) "
        f"USING parquet {f'OPTIONS ({options})' if options else ''} PARTITIONED BY ({DAY_COLUMN}) {place}"
    )


def add_new_columns(raw: DataFrame, table: str) -> list[str]:
    """Add to the table the columns of `raw` that it lacks, NULL in the rows it holds; returns their names."""
    spark = raw.sparkSession
    known = {name.lower() for name in spark.table(table).columns}
    new = {name: kind for name, kind in raw.dtypes if name.lower() not in known}
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{name}` {kind}' for name, kind in new.items())})")
    return list(new)


def _as_table_rows(raw: DataFrame, table: str) -> DataFrame:
    """Rows in the table's column order, matched by name: a column new to one side never shifts the others, and one
    that is new to the table is added to it."""
    spark = raw.sparkSession
    add_new_columns(raw, table)
    wanted = [name for name in spark.table(table).columns if name != DAY_COLUMN]
    columns = [F.col(f"`{name}`") if name in raw.columns else F.lit(None).alias(name) for name in wanted]
    return with_day(raw).select(*columns, DAY_COLUMN)


def _overwrite_day(rows: DataFrame, table: str, day: dt.date) -> None:
    # A static partition: with no input rows it still clears the day, which a dynamic overwrite does not.
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({DAY_COLUMN} = DATE'{day.isoformat()}') SELECT * FROM {{rows}}",
        rows=rows,
    )


def replace_day(raw: DataFrame, table: str, day: str | dt.date) -> None:
    """Make `day` of the table hold exactly the rows of `raw` whose parsed day is `day`; running it twice is safe."""
    target = dt.date.fromisoformat(str(day))
    rows = _as_table_rows(raw, table).where(F.col(DAY_COLUMN) == F.lit(target)).drop(DAY_COLUMN)
    balanced = rows.hint("rebalance", CLUSTER_COLUMN).sortWithinPartitions(CLUSTER_COLUMN)
    _overwrite_day(balanced, table, target)


def replace_days(
    raw: DataFrame,
    table: str,
    days: Iterable[str | dt.date] | None = None,
    filled: Iterable[str | dt.date] | None = None,
) -> None:
    """`replace_day` for several days, or for every day `raw` holds, in one write.

    With `days`, those without rows are cleared one by one; there are at most as many as the caller named. `filled`
    tells which days have rows; without it, one pass over the day column alone finds them.
    """
    rows = _as_table_rows(raw, table)
    if days is None:
        _overwrite_days_present(rows.where(F.col(DAY_COLUMN).isNotNull()), table)
        return
    targets = {dt.date.fromisoformat(str(day)) for day in days}
    wanted = rows.where(F.col(DAY_COLUMN).isin(sorted(targets)))
    if filled is None:
        present = {row[0] for row in wanted.select(DAY_COLUMN).distinct().collect()}
    else:
        present = {dt.date.fromisoformat(str(day)) for day in filled}
    if present:
        _overwrite_days_present(wanted, table)
    for day in sorted(targets - present):
        _overwrite_day(rows.where(F.lit(False)).drop(DAY_COLUMN), table, day)


def _overwrite_days_present(rows: DataFrame, table: str) -> None:
    # The rebalance lets Spark split a day that holds most of the rows, and join small days into one task.
    balanced = rows.hint("rebalance", DAY_COLUMN).sortWithinPartitions(DAY_COLUMN, CLUSTER_COLUMN)
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} WITH ('partitionOverwriteMode' = 'dynamic') SELECT * FROM {{rows}}",
        rows=balanced,
    )


def read_days(spark: SparkSession, *roots: str) -> DataFrame:
    """Raw rows of lake folders written before and after the day column existed; older rows have a NULL day."""
    frames = [spark.read.option("mergeSchema", "true").parquet(root) for root in roots]
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=True)
    return add_missing_column(united)


def add_missing_column(raw: DataFrame) -> DataFrame:
    """`raw` with a DATE day column, NULL where it did not exist."""
    if DAY_COLUMN in raw.columns:
        return raw
    return raw.withColumn(DAY_COLUMN, F.lit(None).cast("date"))


def load_check(loaded: DataFrame, newest: int = 10) -> DataFrame:
    """(betriebstag_date, row_count) of the newest loaded days; the limit is the feature."""
    counts = loaded.groupBy(DAY_COLUMN).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.col(DAY_COLUMN).desc_nulls_last()).limit(newest)


def load_table(raw: DataFrame, table: str, location: str | None = None) -> DataFrame:
    """Create the day table if need be, replace every day `raw` holds, and return the table."""
    conformed = conform(raw)
    create_day_table(conformed, table, location)
    replace_days(conformed, table)
    return raw.sparkSession.table(table)
