"""Profiles of raw stop events: counts, types, null rates, distributions, delay figures.

Each profile reads its input once and aggregates per task before any shuffle. Exact percentiles come from a
histogram of the distinct delays: the hash aggregate that builds it spreads even one hot key over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopmetrics.functions.measures import delay_minutes, delay_minutes_by_parts
from stopmetrics.functions.typing_rules import has_delay_status, normalize_flag, null_label
from stopmetrics.operators.slices import DEFAULT_RANGE_MIN, check_range, delay_range, is_computable, with_delay

_INTEGER = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(?:(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
_BOOLEAN = r"^(?i:true|false)$"
_TYPED_START = r"^(?:\s*[+-]?(?:[\d.]|(?i:inf))|(?i:true|false)$)"  # what none of the above can do without


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def _long_form(row: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    return row.unpivot([_column(i) for i in ids], [_column(v) for v in values], name, value)


def profile_overview(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(df.columns)).cast("bigint"))


def _value_class(name: str) -> Column:
    """Of one text: 1 integer, 2 decimal, 4 boolean, 8 other, 0 NULL. Most texts are other, told by one pattern."""
    value = _column(name)
    return (
        F.when(value.isNull(), 0)
        .when(~value.rlike(_TYPED_START), 8)
        .when(value.rlike(_INTEGER), 1)
        .when(value.rlike(_NUMBER), 2)
        .when(value.rlike(_BOOLEAN), 4)
        .otherwise(8)
    )


def _seen_classes(name: str, kind: str) -> Column:
    """Classes of all texts of a column, or-ed together; NULL for a column that is no text."""
    seen = F.coalesce(F.bit_or(_value_class(name)), F.lit(0)) if kind == "string" else F.lit(None).cast("int")
    return seen.alias(f"seen_{name}")


def _narrowest(seen: Column, column: Column, kinds: dict[str, str]) -> Column:
    """The narrowest type that holds all classes of `seen`; a column that is no text keeps its type."""
    inferred = (
        F.when(seen == 1, "bigint").when(seen.isin(2, 3), "double").when(seen == 4, "boolean").otherwise("string")
    )
    typed = [F.lit(text) for pair in kinds.items() if pair[1] != "string" for text in pair]
    return F.coalesce(F.element_at(F.create_map(*typed), column), inferred) if typed else inferred


def column_types(df: DataFrame) -> DataFrame:
    """(column, dtype) by column name; a text column gets the narrowest type all its values fit.

    One aggregate without keys: each task sends one integer per column.
    """
    kinds = dict(df.dtypes)
    classes = df.agg(*[_seen_classes(name, kind) for name, kind in kinds.items()]).toDF(*kinds)
    seen = _long_form(classes, [], list(kinds), "column", "seen")
    return seen.select("column", _narrowest(F.col("seen"), F.col("column"), kinds).alias("dtype")).orderBy("column")


def _missing(name: str, kind: str) -> Column:
    value = _column(name)
    return value.isNull() | F.isnan(value) if kind in ("float", "double") else value.isNull()


def _null_share() -> Column:
    return F.round(F.lit(100.0) * F.col("null_count") / F.greatest(F.col("__rows"), F.lit(1)), 3).alias("null_rate_pct")


def null_rates(df: DataFrame) -> DataFrame:
    """(column, null_count, null_rate_pct), highest rate first; a NaN counts as missing."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(_missing(name, kind)).alias(name) for name, kind in df.dtypes]
    )
    return (
        _long_form(counts, ["__rows"], df.columns, "column", "null_count")
        .select("column", "null_count", _null_share())
        .orderBy(F.desc("null_rate_pct"), F.asc("column"))
    )


def column_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, row_count, null_count, null_rate_pct) by column name: overview, types and null rates from one scan.

    No rows give a line per column with zeros, the texts among them as strings.
    """
    kinds = dict(df.dtypes)
    figures = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(_missing(name, kind)).alias(f"nulls_{name}") for name, kind in kinds.items()],
        *[_seen_classes(name, kind) for name, kind in kinds.items()],
    )
    columns = [
        F.struct(
            F.lit(name).alias("column"),
            _column(f"seen_{name}").alias("seen"),
            _column(f"nulls_{name}").alias("null_count"),
        )
        for name in kinds
    ]
    lines = figures.select("__rows", F.inline(F.array(*columns)))
    dtype = _narrowest(F.col("seen"), F.col("column"), kinds).alias("dtype")
    return lines.select("column", dtype, F.col("__rows").alias("row_count"), "null_count", _null_share()).orderBy("column")


def value_distribution(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, count, share_pct), most frequent first; the share is over the whole table, also with `top`.

    The total is a scalar subquery over the same counts, and Spark reuses their exchange: one scan.
    """
    counts = df.select(null_label(_column(column)).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    shares = counts.select(
        "value", "count", F.round(F.lit(100.0) * F.col("count") / F.greatest(total, F.lit(1)), 3).alias("share_pct")
    ).orderBy(F.desc("count"), F.asc("value"))
    return shares if top is None else shares.limit(top)


def top_values(df: DataFrame, column: str, k: int = 12) -> DataFrame:
    return value_distribution(df, column, top=k)


def status_breakdown(df: DataFrame) -> DataFrame:
    return value_distribution(df, "AN_PROGNOSE_STATUS")


def delay_summary(df: DataFrame, filtered: bool = False) -> DataFrame:
    """(metric, value): count, mean, median, p95, min, max of the delays; over all rows unless `filtered`.

    Rows without a delay stay in the histogram as one NULL group that no figure counts: a filter would make
    Spark parse every time twice.
    """
    delay = F.when(is_computable(), delay_minutes()) if filtered else delay_minutes()
    histogram = df.select(delay.alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    measured = F.coalesce(F.sum(F.when(F.col("d").isNotNull(), F.col("n"))), F.lit(0))
    figures = histogram.agg(
        measured.cast("double").alias("count"),
        F.sum(F.col("d") * F.col("n")).alias("total"),
        F.percentile("d", F.array(F.lit(0.5), F.lit(0.95)), F.col("n")).alias("p"),
        F.min("d").alias("min"),
        F.max("d").alias("max"),
    ).select(
        "count",
        F.round(F.col("total") / F.nullif(F.col("count"), F.lit(0.0)), 3).alias("mean"),
        F.round(F.get("p", F.lit(0)), 3).alias("median"),
        F.round(F.get("p", F.lit(1)), 3).alias("p95"),
        F.round("min", 3).alias("min"),
        F.round("max", 3).alias("max"),
    )
    return _long_form(figures, [], figures.columns, "metric", "value")


def kpi_table(df: DataFrame) -> DataFrame:
    """(metric, value): the seven headline counts, in one pass."""
    measured = has_delay_status(F.col("AN_PROGNOSE_STATUS"))
    row = df.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(measured).alias("rows_real_or_estimated"),
        F.count_if(normalize_flag(F.col("FAELLT_AUS_TF"))).alias("rows_cancelled"),
        F.count_if(is_computable()).alias("rows_with_computable_arrival_delay"),
        F.count_if(F.col("ANKUNFTSZEIT").isNull()).alias("rows_null_ankunftszeit"),
        F.count_if(~measured).alias("rows_non_delay_status"),
    )
    ordered = row.select(
        "rows_total",
        F.lit(len(df.columns)).cast("bigint").alias("columns_total"),
        "rows_real_or_estimated",
        "rows_cancelled",
        "rows_with_computable_arrival_delay",
        "rows_null_ankunftszeit",
        "rows_non_delay_status",
    )
    return _long_form(ordered, [], ordered.columns, "metric", "value")


def formula_validation(df: DataFrame) -> DataFrame:
    """(check, value): largest difference between the two delay formulas, and the rows compared."""
    compared = has_delay_status(F.col("AN_PROGNOSE_STATUS")) & ~normalize_flag(F.col("FAELLT_AUS_TF"))
    delays = df.select(compared.alias("ok"), delay_minutes().alias("a"), delay_minutes_by_parts().alias("b"))
    row = delays.agg(
        F.coalesce(F.max(F.when(F.col("ok"), F.abs(F.col("a") - F.col("b")))), F.lit(0.0)).alias(
            "formula_match_max_abs_diff_min"
        ),
        F.count_if(F.col("ok") & F.col("b").isNotNull()).cast("double").alias("validated_rows"),
    )
    return _long_form(row, [], row.columns, "check", "value")


def delay_histogram(
    df: DataFrame, low: float = DEFAULT_RANGE_MIN[0], high: float = DEFAULT_RANGE_MIN[1], width: int = 2
) -> DataFrame:
    """(bin_start, count) of the delays within [low, high]; bins are [k*width, (k+1)*width)."""
    if not 1 <= width <= 20:
        raise ValueError("Bin width must be between 1 and 20 minutes.")
    start = (F.floor(F.col("delay_min") / F.lit(float(width))) * width).cast("bigint")
    counts = delay_range(df, low, high).groupBy(start.alias("bin_start")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy("bin_start")


def range_coverage(
    df: DataFrame, low: float = DEFAULT_RANGE_MIN[0], high: float = DEFAULT_RANGE_MIN[1]
) -> DataFrame:
    """(rows_in_range, rows_total) over the rows that carry a delay."""
    check_range(low, high)
    kept = has_delay_status(F.col("AN_PROGNOSE_STATUS")) & ~normalize_flag(F.col("FAELLT_AUS_TF"))
    delay = with_delay(df.where(kept)).select("delay_min")
    return delay.agg(
        F.count_if(F.col("delay_min").between(low, high)).alias("rows_in_range"),
        F.count("delay_min").alias("rows_total"),
    )


def executive_summary(df: DataFrame) -> DataFrame:
    """One row of headline figures. Mean and p95 cover every row with a delay, as the report they head does.

    One scan: rows collapse to (transport type, delay) counts, and the rest works on those.
    """
    measured = has_delay_status(F.col("AN_PROGNOSE_STATUS"))
    cancelled = normalize_flag(F.col("FAELLT_AUS_TF"))
    rows = df.select(
        null_label(F.col("VERKEHRSMITTEL_TEXT")).alias("type"),
        measured.alias("measured"),
        cancelled.alias("cancelled"),
        delay_minutes().alias("d"),
        delay_minutes_by_parts().alias("d2"),
    )
    comparable = F.col("measured") & ~F.col("cancelled")
    histogram = rows.groupBy("type", "d").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(comparable & F.col("d").isNotNull()).alias("n_ready"),
        F.count_if("cancelled").alias("n_cancelled"),
        F.count_if(~F.col("measured")).alias("n_other"),
        F.max(F.when(comparable, F.abs(F.col("d") - F.col("d2")))).alias("diff"),
    )
    by_type = histogram.withColumn("n_type", F.sum("n").over(Window.partitionBy("type")))
    top = F.min_by(F.struct("type", "n_type"), F.struct(-F.col("n_type"), F.col("type")))
    with_value = F.sum(F.when(F.col("d").isNotNull(), F.col("n")))
    figures = by_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_total"),
        F.coalesce(F.sum("n_ready"), F.lit(0)).alias("delay_ready_rows"),
        F.coalesce(F.sum("n_cancelled"), F.lit(0)).alias("cancelled_rows"),
        F.coalesce(F.sum("n_other"), F.lit(0)).alias("non_delay_status_rows"),
        F.round(F.sum(F.col("d") * F.col("n")) / with_value, 3).alias("mean_delay"),
        F.round(F.percentile("d", F.lit(0.95), F.col("n")), 3).alias("p95_delay"),
        F.coalesce(F.max("diff"), F.lit(0.0)).alias("formula_max_abs_diff_min"),
        top.alias("top"),
    )
    return figures.select(
        *[name for name in figures.columns if name != "top"],
        F.col("top.type").alias("top_transport_type"),
        F.round(F.lit(100.0) * F.col("top.n_type") / F.greatest("rows_total", F.lit(1)), 3).alias(
            "top_transport_share_pct"
        ),
    )
