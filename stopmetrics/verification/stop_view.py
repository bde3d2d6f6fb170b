"""Raw stop events derived from the given order tables: one row per lineitem, with every quirk a daily file has."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopmetrics.schema import RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FIRST_DAY = dt.date(2026, 1, 1)
_DAY_SECONDS = 86400
_READY_DAYS = 100  # on both sides of the first day


def _constant_array(texts: list[str | None]) -> Column:
    return F.array(*[F.lit(text).cast("string") for text in texts])


def _constant_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(text) for pair in pairs.items() for text in pair])


def _swiss_day(iso: Column) -> Column:
    """`DD.MM.YYYY` of a text that starts with `YYYY-MM-DD`."""
    dot = F.lit(".")
    return F.concat(F.substring(iso, 9, 2), dot, F.substring(iso, 6, 2), dot, F.substring(iso, 1, 4))


def _constant_texts(texts: list[str]) -> Column:
    """As `_constant_array`, one literal that Spark splits once per query."""
    return F.split(F.lit(",".join(texts)), ",")


def _day_text(number: Column, swiss: bool) -> Column:
    """Text of the day so many days after the first one, as `DD.MM.YYYY` or `YYYY-MM-DD`.

    Looked up, as the date formatter is what the view spent most of its time in; days far off are formatted.
    """
    near = range(-_READY_DAYS, _READY_DAYS + 1)
    pattern = "%d.%m.%Y" if swiss else "%Y-%m-%d"
    ready = _constant_texts([(_FIRST_DAY + dt.timedelta(n)).strftime(pattern) for n in near])
    iso = F.date_add(F.lit(_FIRST_DAY), number).cast("string")
    # `transform` keeps the projection out of whole-stage code: with what a query does to the columns, that is one
    # method too long for the JVM to compile.
    far = F.get(F.transform(F.array(iso), _swiss_day), F.lit(0)) if swiss else iso
    return F.coalesce(F.get(ready, number + _READY_DAYS), far)


def raw_stop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner joins on keys, no hints: Spark picks broadcast or sort-merge from measured sizes.

    Orders meet their customers first: where nothing can be broadcast, the far more line items are shuffled once less.
    """
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    ordered = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    joined = lineitem.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).join(
        table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    outlier = F.when(part % 211 == 0, 12000).when(part % 223 == 0, -4000).otherwise(0)
    derived = joined.select(
        "*",
        (F.col("l_orderkey") % 90).cast("int").alias("op_day"),
        F.when(part % 19 == 0, " ").otherwise("").alias("pad"),
        ((300 + (F.col("l_orderkey") * 7) % 1080 + 6 * (line - 1)) * 60).cast("int").alias("arrival"),
        ((part * 37 + F.col("l_suppkey") * 11 + line * 53) % 1500 - 240 + outlier).cast("int").alias("delay"),
        ((F.col("l_suppkey") % 5) * 30 + 60).cast("int").alias("stay"),
    )
    seconds = {
        "arrives": F.col("arrival"),
        "arrived": F.col("arrival") + F.col("delay"),
        "departs": F.col("arrival") + F.lit(60),
        "departed": F.col("arrival") + F.col("delay") + F.col("stay"),
    }
    since_midnight = F.col("op_day").cast("long") * _DAY_SECONDS
    clocked = derived.select("*", *[(since_midnight + after).alias(name) for name, after in seconds.items()])
    timed = clocked.select("*", *[F.pmod(name, F.lit(_DAY_SECONDS)).cast("int").alias(f"{name}_clock") for name in seconds])
    minutes = _constant_texts([f" {minute // 60:02}:{minute % 60:02}" for minute in range(1440)])
    ends = _constant_texts([f":{second:02}" for second in range(60)])

    def stamp(name: str, with_second: bool, swiss: bool = True) -> Column:
        clock = F.col(f"{name}_clock")
        day = ((F.col(name) - clock) / _DAY_SECONDS).cast("int")
        texts = [_day_text(day, swiss), F.get(minutes, F.floor(clock / 60).cast("int"))]
        return F.concat(*texts, *([F.get(ends, clock % 60)] if with_second else []))

    # Lookups in constant arrays instead of long CASE chains keep the generated code small enough to be compiled.
    flags = _constant_array(["true", "TRUE", "1", "yes", None, "t", "1.0"])
    arrivals = ["REAL"] * 11 + ["ESTIMATED"] * 4 + ["real", "FORECAST", "UNKNOWN", None, "NULL"]
    departures = ["REAL"] * 11 + ["ESTIMATED"] * 4 + ["UNKNOWN"] * 5
    types = {"1-URGENT": "IC", "2-HIGH": "IR", "3-MEDIUM": "S", "4-NOT SPECIFIED": "Bus"}
    quantity = F.col("l_quantity").cast("int")
    twentieth = (part % 20).cast("int")
    priority = F.col("o_orderpriority")
    op_day = F.col("op_day")
    line_id = (F.col("o_custkey") % 12 + 1).cast("string")
    values = {
        "BETRIEBSTAG": F.when(F.col("l_orderkey") % 2 == 0, _day_text(op_day, True)).otherwise(_day_text(op_day, False)),
        "FAHRT_BEZEICHNER": F.col("l_orderkey").cast("string"),
        "BETREIBER_ID": F.concat(F.lit("85:"), F.col("n_nationkey").cast("string")),
        "BETREIBER_ABK": F.concat(F.lit("OP"), F.col("n_nationkey").cast("string")),
        "BETREIBER_NAME": F.col("n_name"),
        "PRODUKT_ID": F.when(priority == "4-NOT SPECIFIED", "Bus").otherwise("Zug"),
        "LINIEN_ID": line_id,
        "LINIEN_TEXT": F.concat(F.lit("L"), line_id),
        "UMLAUF_ID": F.lit(None).cast("string"),
        "VERKEHRSMITTEL_TEXT": F.when(
            F.col("l_orderkey") % 97 != 0, F.coalesce(F.element_at(_constant_map(types), priority), F.lit("RE"))
        ),
        "ZUSATZFAHRT_TF": F.when(F.col("l_orderkey") % 41 == 0, "true").otherwise("false"),
        "FAELLT_AUS_TF": F.when(quantity.between(1, 7), F.get(flags, quantity - 1)).otherwise("false"),
        "BPUIC": (F.lit(8500000) + F.col("l_suppkey")).cast("string"),
        "HALTESTELLEN_NAME": F.col("s_name"),
        "ANKUNFTSZEIT": F.when(line != 1, stamp("arrives", False)),
        "AN_PROGNOSE": F.when(
            line != 1,
            F.when(part % 101 == 0, "n/a")
            .when(part % 17 == 0, stamp("arrived", True, swiss=False))
            .otherwise(F.concat("pad", stamp("arrived", True), "pad")),
        ),
        "AN_PROGNOSE_STATUS": F.get(_constant_array(arrivals), twentieth),
        "ABFAHRTSZEIT": F.when(line != 7, stamp("departs", False)),
        "AB_PROGNOSE": F.when(line != 7, stamp("departed", True)),
        "AB_PROGNOSE_STATUS": F.get(_constant_array(departures), twentieth),
        "DURCHFAHRT_TF": F.when((F.col("l_returnflag") == "R") & (part % 5 == 0), "true").otherwise("false"),
        "SLOID": F.concat(F.lit("ch:1:sloid:"), F.col("l_suppkey").cast("string")),
    }
    return timed.select(*[values[name].alias(name) for name in RAW_COLUMNS])


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled pages, each with one link to a daily file in varying spelling."""
    page = F.col("page_id")
    day = F.date_add(F.lit("2026-01-01").cast("date"), (page % 60).cast("int")).cast("string")
    link = F.concat(
        F.when(page % 5 == 0, "https://h.example.org").otherwise(""),
        F.lit("/dataset/"),
        page.cast("string"),
        F.lit("/download/"),
        day,
        F.lit("_istdaten.csv"),
    )
    anchor = F.concat(
        F.lit("<a "), F.when(page % 7 == 0, "HREF").otherwise("href"), F.lit('="'), link, F.lit('">')
    )
    return table(spark, sf_dir, "pages").select("page_id", F.concat("html", anchor).alias("html"))


def loaded_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    day = F.date_add(F.lit("2026-01-01").cast("date"), (page % 60).cast("int")).cast("string")
    return table(spark, sf_dir, "pages").where(page % 3 == 0).select(day.alias("day")).distinct()
