"""From raw text to typed values. No rule throws on bad text, and none depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopmetrics.schema import DELAY_STATUSES, TRUE_TEXTS

_SWISS_STAMP = r"^\s*(\d{1,2})\.(\d{1,2})\.(\d{4})\s+(\d{1,2}:\d{1,2}(?::\d{1,2})?)\s*$"
_FULL_STAMP = r"^\d\d\.\d\d\.\d{4} \d\d:\d\d(?::\d\d)?$"
_FULL_SWISS_DAY = r"^\d\d\.\d\d\.\d{4}\z"
_FULL_ISO_DAY = r"^\d{4}-\d\d-\d\d\z"
# Groups 3-2-1 of a Swiss day or 4-5-6 of an ISO day; any other text matches the last branch and loses all digits.
_DAY = r"(?s)^\s*(?:(\d{1,2})\.(\d{1,2})\.(\d{4})|(\d{4})-(\d{1,2})-(\d{1,2}))\s*$|^.*$"


def swiss_day_to_iso(text: Column) -> Column:
    """`YYYY-MM-DD` of a text that starts with `DD.MM.YYYY`."""
    dash = F.lit("-")
    return F.concat(F.substring(text, 7, 4), dash, F.substring(text, 4, 2), dash, F.substring(text, 1, 2))


def parse_timestamp(text: Column) -> Column:
    """`DD.MM.YYYY HH:MM[:SS]`, else ISO, as a wall-clock time; NULL for anything else.

    Only the order of the date parts is rewritten. Spark's own cast then checks the calendar, without the
    exception per bad row that a pattern-driven parser pays. Texts of full length are cut at fixed places, which
    costs less than a replacement; all that this does not type is rewritten.
    """
    text = text.cast("string")
    cut = F.when(text.rlike(_FULL_STAMP), F.concat(swiss_day_to_iso(text), F.substring(text, 11, 9)))
    iso = F.regexp_replace(text, _SWISS_STAMP, "$3-$2-$1 $4")
    return F.coalesce(cut.try_cast("timestamp_ntz"), iso.try_cast("timestamp_ntz"))


def parse_operating_day(text: Column) -> Column:
    """`YYYY-MM-DD` or `DD.MM.YYYY` as a date; NULL for anything else, also for a date with a time.

    Texts of full length are cut at fixed places, as in `parse_timestamp`; only others pay for a replacement.
    """
    text = text.cast("string")
    iso = F.when(text.rlike(_FULL_ISO_DAY), text).when(text.rlike(_FULL_SWISS_DAY), swiss_day_to_iso(text))
    return iso.otherwise(F.regexp_replace(text, _DAY, "$3$4-$2$5-$1$6")).try_cast("date")


def normalize_status(status: Column) -> Column:
    return F.upper(F.coalesce(status.cast("string"), F.lit("")))


def has_delay_status(status: Column) -> Column:
    """Never NULL, so it can be negated safely."""
    return normalize_status(status).isin(*DELAY_STATUSES)


def normalize_flag(flag: Column) -> Column:
    """True for the known spellings only; NULL and any other text are false."""
    return F.coalesce(F.lower(flag.cast("string")).isin(*TRUE_TEXTS), F.lit(False))


def null_label(value: Column) -> Column:
    """Text of a value, NULL shown as the text `NULL`."""
    return F.coalesce(value.cast("string"), F.lit("NULL"))
