from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stopmetrics.functions import links, measures, typing_rules
from stopmetrics.verification.stop_view import _day_text, raw_stop_events


def value(spark, text, rule):
    return spark.createDataFrame([(text,)], "x string").select(rule(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("01.02.2026 10:05:07", dt.datetime(2026, 2, 1, 10, 5, 7)),
        ("01.02.2026 10:05", dt.datetime(2026, 2, 1, 10, 5)),
        ("1.2.2026 5:07", dt.datetime(2026, 2, 1, 5, 7)),
        (" 01.02.2026 10:05:07 ", dt.datetime(2026, 2, 1, 10, 5, 7)),
        ("2026-02-01 10:05:07", dt.datetime(2026, 2, 1, 10, 5, 7)),
        ("2026-02-01T10:05:07.5", dt.datetime(2026, 2, 1, 10, 5, 7, 500000)),
        ("2026-02-01 10:05:07+02:00", dt.datetime(2026, 2, 1, 10, 5, 7)),
        ("31.02.2026 10:00", None),
        ("01.02.2026 25:00", None),
        ("01.02.2026", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, expected):
    assert value(spark, text, typing_rules.parse_timestamp) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("01.03.2026", dt.date(2026, 3, 1)),
        ("2026-03-01", dt.date(2026, 3, 1)),
        (" 1.3.2026 ", dt.date(2026, 3, 1)),
        ("2026-3-1", dt.date(2026, 3, 1)),
        ("31.02.2026", None),
        ("2026-03-01 10:00", None),
        ("2026", None),
        ("01.03.2026\n2026-03-01", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_operating_day(spark, text, expected):
    assert value(spark, text, typing_rules.parse_operating_day) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("true", True), ("TRUE", True), ("1", True), ("t", True), ("Yes", True)]
    + [("1.0", False), (" true", False), ("false", False), ("", False), (None, False)],
)
def test_normalize_flag(spark, text, expected):
    assert value(spark, text, typing_rules.normalize_flag) is expected


def test_texts_cut_at_fixed_places_type_like_the_pattern(spark):
    """Odd texts, most of the length and shape that is cut at fixed places, by the pattern alone and by the whole rule."""
    pieces = ["01.02.2026 10:00:05", "01.02.2026 10:00", " 1.02.2026 10:00", "31.02.2026 10:00", "01.02.2026 1:2:3"]
    texts = {text[:at] + letter + text[at + 1 :] for text in pieces for at in range(len(text)) for letter in " 9:.Z+\x01\n"}
    df = spark.createDataFrame([(text,) for text in sorted(texts | set(pieces))], "x string")
    by_pattern = F.regexp_replace("x", typing_rules._SWISS_STAMP, "$3-$2-$1 $4").try_cast("timestamp_ntz")
    assert df.where(by_pattern.isNotNull()).count() > 50
    assert df.where(~by_pattern.eqNullSafe(typing_rules.parse_timestamp(F.col("x")))).collect() == []


def test_normalize_status_and_label(spark):
    assert value(spark, "real", typing_rules.normalize_status) == "REAL"
    assert value(spark, None, typing_rules.normalize_status) == ""
    assert value(spark, None, typing_rules.null_label) == "NULL"
    assert value(spark, None, typing_rules.has_delay_status) is False


def test_delays_ignore_clock_changes_and_session_zone(spark, raw):
    """29 March 2026 lacks the hour after 02:00 in this zone; wall-clock differences must not notice."""
    events = raw({"ANKUNFTSZEIT": "29.03.2026 01:50", "AN_PROGNOSE": "29.03.2026 02:30:30"})
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    try:
        row = events.select(measures.delay_minutes(), measures.delay_minutes_by_parts()).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (40.5, 40.5)


def test_whole_minutes_truncate_toward_zero(spark):
    frame = spark.sql(
        "SELECT timestamp_ntz'2026-03-01 10:00:00' AS a, timestamp_ntz'2026-03-01 10:00:59' AS b, "
        "timestamp_ntz'2026-03-01 09:57:01' AS c"
    )
    row = frame.select(
        measures.whole_minutes_between(F.col("a"), F.col("b")), measures.whole_minutes_between(F.col("a"), F.col("c"))
    ).first()
    assert tuple(row) == (0, -2)


@pytest.mark.parametrize(
    ("link", "expected"),
    [
        ("https://x.example.org/a", "https://x.example.org/a"),
        ("//x.example.org/a", "https://x.example.org/a"),
        ("/a/b", "https://h.example.org/a/b"),
        ("a/b", "https://h.example.org/en/set/a/b"),
        ("./a", "https://h.example.org/en/set/a"),
        ("../a", "https://h.example.org/en/a"),
        ("../../../a", "https://h.example.org/a"),
    ],
)
def test_absolute_url(spark, link, expected):
    base = "https://h.example.org/en/set/page"
    assert value(spark, link, lambda x: links.absolute_url(x, base)) == expected


def test_view_looks_its_times_up(spark, tmp_path):
    """The date formatter is for days far from the first one only; it types no time of day."""
    tables = {
        "lineitem": "SELECT 32L l_orderkey, 17L l_partkey, 3L l_suppkey, 2 l_linenumber, 9.0D l_quantity, 'N' l_returnflag",
        "orders": "SELECT 32L o_orderkey, 5L o_custkey, '2-HIGH' o_orderpriority",
        "customer": "SELECT 5L c_custkey, 4L c_nationkey",
        "nation": "SELECT 4L n_nationkey, 'EGYPT' n_name",
        "supplier": "SELECT 3L s_suppkey, 'S3' s_name",
    }
    for name, query in tables.items():
        spark.sql(query).write.parquet(f"{tmp_path}/{name}.parquet")
    view = raw_stop_events(spark, str(tmp_path))
    assert "timestampadd" not in view._jdf.queryExecution().optimizedPlan().toString().lower()
    # 32 days on at 8:50, and (17 * 37 + 3 * 11 + 2 * 53) % 1500 - 240 seconds later; then a stay of 150 seconds
    row = view.select("BETRIEBSTAG", "ANKUNFTSZEIT", "AN_PROGNOSE", "ABFAHRTSZEIT", "AB_PROGNOSE").first()
    assert tuple(row) == (
        "02.02.2026", "02.02.2026 08:50", "2026-02-02 08:58:48", "02.02.2026 08:51", "02.02.2026 09:01:18"
    )


@pytest.mark.parametrize("number", [-36890, -101, -100, -1, 0, 59, 100, 101, 40000, None])
def test_day_texts_near_and_far(spark, number):
    rows = spark.createDataFrame([(number,)], "n int").select(
        _day_text(F.col("n"), True).alias("swiss"), _day_text(F.col("n"), False).alias("iso")
    )
    day = None if number is None else dt.date(2026, 1, 1) + dt.timedelta(number)
    assert tuple(rows.first()) == ((day.strftime("%d.%m.%Y"), day.isoformat()) if day else (None, None))
