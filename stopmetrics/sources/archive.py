"""Listing pages: which daily files are published, and which days a load run has to take."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopmetrics.functions.links import absolute_url

# Fixed value: a link to a daily file on a listing page, any letter case.
LINK_PATTERN = r'(?i)href="([^"]*/download/\d{4}-\d{2}-\d{2}_istdaten\.csv)"'
_LINK_DAY = r"(?i)/download/(\d{4}-\d{2}-\d{2})_istdaten\.csv$"

# Fixed value: most days one load run may take.
MAX_BACKFILL_DAYS = 7


def archive_index(pages: DataFrame, base_url: str) -> DataFrame:
    """(day, url) per published day from pages (page_id, html); the last link of the last page wins."""
    links = pages.select(
        "page_id",
        F.posexplode(F.regexp_extract_all("html", F.lit(LINK_PATTERN), F.lit(1))).alias("pos", "link"),
    )
    last = Window.partitionBy("day").orderBy(F.desc("page_id"), F.desc("pos"))
    return (
        links.withColumn("day", F.regexp_extract("link", _LINK_DAY, 1))
        .withColumn("rank", F.row_number().over(last))
        .where("rank = 1")
        .select("day", absolute_url(F.col("link"), base_url).alias("url"))
    )


def _or_fail(days: DataFrame, fails: Column, message: str) -> DataFrame:
    """`days`, none of which comes out when `fails`, a condition over columns of `days`, holds for it."""
    checked = F.when(fails, F.raise_error(F.lit(message)).cast("string")).otherwise(F.col("day"))
    return days.withColumn("day", checked)


def archive_latest_n(pages: DataFrame, base_url: str, days: int) -> DataFrame:
    """The newest `days` published days, newest first; reading the result fails when no page announces any.

    One pass over the pages: an extra row without a day comes out first only if there is no other.
    """
    if days < 1:
        raise ValueError("days must be >= 1")
    nothing = pages.sparkSession.range(1).select(F.lit(None).cast("string").alias("day"), F.lit("").alias("url"))
    newest = archive_index(pages, base_url).unionByName(nothing).orderBy(F.desc_nulls_last("day")).limit(days)
    position = F.row_number().over(Window.orderBy(F.desc_nulls_last("day")))
    failing = F.col("day").isNull() & (F.col("position") == 1)
    checked = _or_fail(newest.withColumn("position", position), failing, "The listing pages announce no daily file.")
    return checked.where("day IS NOT NULL").select("day", "url").orderBy(F.desc("day"))


def available_days(pages: DataFrame) -> DataFrame:
    """Distinct published days, ascending."""
    links = pages.select(F.explode(F.regexp_extract_all("html", F.lit(LINK_PATTERN), F.lit(1))).alias("link"))
    return links.select(F.regexp_extract("link", _LINK_DAY, 1).alias("day")).distinct().orderBy("day")


@dataclass(frozen=True)
class DayRequest:
    """Which days a load run asks for: `count` days that end at `anchor`, or at the newest day when that is None."""

    count: int = 1
    anchor: str | None = None

    def __post_init__(self) -> None:
        if type(self.count) is not int or self.count not in range(1, MAX_BACKFILL_DAYS + 1):
            raise ValueError(f"A run loads 1 to {MAX_BACKFILL_DAYS} days, not {self.count!r}.")
        if self.anchor is not None:
            try:
                normal = dt.datetime.strptime(self.anchor, "%Y-%m-%d").date().isoformat()
            except (TypeError, ValueError) as exc:
                raise ValueError(f"{self.anchor!r} is no calendar day written as YYYY-MM-DD.") from exc
            if normal != self.anchor:
                raise ValueError(f"{self.anchor!r} is no calendar day written as YYYY-MM-DD.")

    @classmethod
    def of(cls, mode: str, run_date: str | None, backfill_days: int) -> DayRequest:
        """From a run's parameters: mode `latest` ignores the date, mode `date` needs one."""
        kinds = {"latest": None, "date": run_date or ""}
        kind = mode.strip().lower() if isinstance(mode, str) else mode
        if kind not in kinds:
            raise ValueError(f"Unknown mode {mode!r}; choose from {', '.join(kinds)}.")
        if run_date:
            cls(1, run_date)
        return cls(backfill_days, kinds[kind])


def target_days(
    available: DataFrame, mode: str = "latest", run_date: str | None = None, backfill_days: int = 1
) -> DataFrame:
    """The anchor day and the available days before it, `backfill_days` in all, ascending.

    `available` holds distinct days. The anchor is the newest day, or `run_date` when mode is `date`. Whether it is
    published is checked by the same pass: reading the result fails where it is not.
    """
    request = DayRequest.of(mode, run_date, backfill_days)
    wanted = available.select("day")
    if request.anchor is not None:
        wanted = wanted.where(F.col("day") <= request.anchor)
    nothing = available.sparkSession.range(1).select(F.lit(None).cast("string").alias("day"))
    newest = wanted.unionByName(nothing).orderBy(F.desc_nulls_last("day")).limit(request.count)
    first = F.first("day").over(Window.orderBy(F.desc_nulls_last("day")))
    missing = F.col("first").isNull() if request.anchor is None else ~F.col("first").eqNullSafe(F.lit(request.anchor))
    what = "No day" if request.anchor is None else f"The day {request.anchor}"
    checked = _or_fail(newest.withColumn("first", first), missing, f"{what} is not among the published ones.")
    return checked.where("day IS NOT NULL").select("day").orderBy("day")


def pending_days(available: DataFrame, loaded: DataFrame) -> DataFrame:
    """Available days that are not loaded yet."""
    return available.join(loaded, "day", "left_anti")
