from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stopmetrics.plans import lake
from stopmetrics.schema import NA_TOKENS, RAW_COLUMNS, REQUIRED_COLUMNS
from stopmetrics.sources import archive, stop_files

HEADER = ";".join(REQUIRED_COLUMNS)


def write(folder, name, *lines):
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_nulls_exactly_the_na_tokens(spark, tmp_path):
    texts = [*NA_TOKENS, " NA ", "Na", "Zürich HB"]
    lines = [f"{i};{text};x;x;x;x" for i, text in enumerate(texts)]
    path = write(tmp_path, "2026-03-01_istdaten.csv", HEADER, *lines)
    found = {int(row[0]): row[1] for row in stop_files.scan_csv(spark, path).collect()}
    assert [found[i] for i in range(len(texts))] == [None] * len(NA_TOKENS) + [" NA ", "Na", "Zürich HB"]


def test_csv_quotes_and_types_stay_text(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER, '01.03.2026;"a;b";"say ""x""";007;1.0;true')
    frame = stop_files.scan_csv(spark, path)
    assert set(dict(frame.dtypes).values()) == {"string"}
    assert tuple(frame.first()) == ("01.03.2026", "a;b", 'say "x"', "007", "1.0", "true")


def test_csv_with_another_column_order_is_never_read_by_position(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER, "1;2;3;4;5;6")
    write(tmp_path, "b.csv", ";".join(reversed(REQUIRED_COLUMNS)), "6;5;4;3;2;1")
    with pytest.raises(Exception, match="CSV header|header"):
        stop_files.scan_csv(spark, str(tmp_path / "*.csv")).collect()
    united = stop_files.read_stop_events(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert united.distinct().count() == 1


def test_read_unites_csv_and_parquet_by_name(spark, raw, tmp_path):
    raw({"BETRIEBSTAG": "2026-03-02", "SLOID": "s"}).write.parquet(str(tmp_path / "b.parquet"))
    csv = write(tmp_path, "a.CSV", HEADER, "2026-03-01;S;REAL;;;false")
    both = stop_files.read_stop_events(spark, [csv, str(tmp_path / "b.parquet")])
    assert {tuple(row) for row in both.select("BETRIEBSTAG", "SLOID").collect()} == {
        ("2026-03-01", None),
        ("2026-03-02", "s"),
    }


def test_unknown_suffix(spark):
    with pytest.raises(ValueError, match=r"Unsupported file extension: \.json\. Use \.csv or \.parquet\."):
        stop_files.read_stop_events(spark, "x.json")


def test_missing_columns_and_rows(spark, raw, tmp_path):
    lacking = raw().drop("FAELLT_AUS_TF", "AN_PROGNOSE")
    with pytest.raises(ValueError, match="Missing required columns: AN_PROGNOSE, FAELLT_AUS_TF"):
        stop_files.require_columns(lacking)
    with pytest.raises(ValueError, match="Missing required columns: AN_PROGNOSE, BETRIEBSTAG"):
        stop_files.require_columns(raw().drop("BETRIEBSTAG", "AN_PROGNOSE"), in_name_order=True)
    empty = write(tmp_path, "e_empty.csv", HEADER)
    with pytest.raises(ValueError, match="No stop events in"):
        stop_files.require_rows(stop_files.scan_csv(spark, empty))


def test_latest_file_by_name(spark, tmp_path):
    for day in ("2026-03-02", "2026-03-10", "2026-02-28"):
        write(tmp_path, f"{day}_istdaten.csv", HEADER, f"{day};S;REAL;;;false")
    write(tmp_path, "notes.csv", HEADER, "x;S;REAL;;;false")
    days = [day for day, _ in stop_files.daily_files(spark, str(tmp_path), limit=2)]
    assert days == ["2026-03-10", "2026-03-02"]
    assert [row[0] for row in stop_files.scan_latest(spark, str(tmp_path)).collect()] == ["2026-03-10"]
    with pytest.raises(ValueError, match="No daily files"):
        (tmp_path / "none").mkdir()
        write(tmp_path / "none", "notes.txt", "x")
        stop_files.scan_latest(spark, str(tmp_path / "none"))


def test_conform_fills_and_keeps(spark):
    frame = spark.createDataFrame([("x", 1)], "BETRIEBSTAG string, EXTRA int")
    conformed = stop_files.conform(frame)
    assert conformed.columns == [*RAW_COLUMNS, "EXTRA"]
    assert set(dict(conformed.dtypes).values()) == {"string"}


def days(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "day string")


def test_target_days_take_available_days(spark):
    available = days(spark, "2026-03-01", "2026-03-05", "2026-03-03")
    assert [r[0] for r in archive.target_days(available, backfill_days=2).collect()] == ["2026-03-03", "2026-03-05"]
    chosen = archive.target_days(available, mode=" DATE ", run_date="2026-03-03", backfill_days=7)
    assert [r[0] for r in chosen.collect()] == ["2026-03-01", "2026-03-03"]


@pytest.mark.parametrize(
    ("arguments", "message"),
    [
        ({"mode": "all"}, "Unknown mode 'all'"),
        ({"mode": 1}, "Unknown mode 1"),
        ({"run_date": "1.3.2026"}, "no calendar day"),
        ({"run_date": "2026-3-01", "mode": "date"}, "no calendar day"),
        ({"run_date": "2026-02-30"}, "no calendar day"),
        ({"backfill_days": "1"}, "loads 1 to 7 days"),
        ({"backfill_days": True}, "loads 1 to 7 days"),
        ({"backfill_days": 8}, "loads 1 to 7 days"),
        ({"mode": "date"}, "no calendar day"),
    ],
)
def test_target_days_refuses_requests(spark, arguments, message):
    with pytest.raises(ValueError, match=message):
        archive.target_days(days(spark, "2026-03-01"), **arguments)


def test_target_days_fails_where_nothing_fits(spark):
    with pytest.raises(Exception, match="The day 2026-03-02 is not among the published ones"):
        archive.target_days(days(spark, "2026-03-01"), mode="date", run_date="2026-03-02").collect()
    with pytest.raises(Exception, match="No day is not among the published ones"):
        archive.target_days(days(spark)).collect()


def test_days_are_found_in_one_pass(spark):
    pages = spark.createDataFrame([(1, '<a href="/x/download/2026-03-01_istdaten.csv">')], "page_id long, html string")
    for frame in (archive.archive_latest_n(pages, "https://h/x", 2), archive.target_days(archive.available_days(pages))):
        assert frame.count() == 1
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_nothing_published(spark):
    pages = spark.createDataFrame([(1, "<a href='x'>")], "page_id long, html string")
    with pytest.raises(Exception, match="announce no daily file"):
        archive.archive_latest_n(pages, "https://h.example.org/p", 3).collect()
    with pytest.raises(Exception, match="not among the published"):
        archive.target_days(archive.available_days(pages)).collect()


def test_last_link_of_a_day_wins(spark):
    html = '<a href="/a/download/2026-03-01_istdaten.csv"><a HREF="/b/download/2026-03-01_istdaten.CSV">'
    pages = spark.createDataFrame([(1, html), (0, html.replace("/b/", "/c/"))], "page_id long, html string")
    row = archive.archive_index(pages, "https://h.example.org/p").collect()
    assert [tuple(r) for r in row] == [
        ("2026-03-01", "https://h.example.org/b/download/2026-03-01_istdaten.CSV")
    ]


def test_pending_days(spark):
    left = archive.pending_days(days(spark, "a", "b"), days(spark, "b").where(F.col("day").isNotNull()))
    assert [r[0] for r in left.collect()] == ["a"]


def test_csv_with_byte_order_mark_and_windows_line_ends(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_bytes(("﻿" + HEADER + "\r\n2026-03-01;S;REAL;;;false\r\n").encode())
    frame = stop_files.require_columns(stop_files.scan_csv(spark, str(path)))
    assert tuple(frame.first()) == ("2026-03-01", "S", "REAL", None, None, "false")


def test_csv_rows_with_too_few_and_too_many_fields(spark, tmp_path):
    path = write(tmp_path, "f.csv", HEADER, "a;b", "1;2;3;4;5;6")
    rows = [tuple(row) for row in stop_files.scan_csv(spark, path).collect()]
    assert rows == [("a", "b", None, None, None, None), ("1", "2", "3", "4", "5", "6")]


def test_rows_with_more_fields_fail_and_shorter_ones_end_in_nulls(spark, tmp_path):
    short = write(tmp_path, "short.csv", HEADER, "1;2;3")
    assert tuple(stop_files.scan_csv(spark, short).first()) == ("1", "2", "3", None, None, None)
    longer = write(tmp_path, "long.csv", HEADER, "1;2;3;4;5;6;7")
    for read in (stop_files.scan_csv, stop_files.read_stop_events):
        with pytest.raises(Exception, match="more fields than its header"):
            read(spark, longer).collect()
        with pytest.raises(Exception, match="more fields than its header"):
            read(spark, longer).count()
    quoted = write(tmp_path, "quoted.csv", HEADER, '1;"a;b";3')
    assert stop_files.scan_csv(spark, quoted).first()[1] == "a;b"


def test_line_breaks_in_quotes_through_all_readers(spark, tmp_path):
    path = write(tmp_path, "2026-03-01_istdaten.csv", HEADER, '1;"two\nlines";3;4;5;6')
    frames = [
        stop_files.scan_csv(spark, path, multiline=True),
        stop_files.read_stop_events(spark, path, multiline=True),
        stop_files.scan_latest(spark, str(tmp_path), multiline=True),
        lake.csv_to_parquet(spark, path, str(tmp_path / "out"), multiline=True),
    ]
    for frame in frames:
        assert [row[1] for row in frame.collect()] == ["two\nlines"]


def test_leftover_names_are_no_daily_files(spark, tmp_path):
    folder = tmp_path / "a[1]{b}"
    folder.mkdir()
    for name in ("2026-03-01_istdaten.csv", "2026-03-02_istdaten.csv.part", "2026-03-03_istdaten.csvx"):
        write(folder, name, HEADER, "1;2;3;4;5;6")
    found = stop_files.daily_files(spark, str(tmp_path))
    assert [day for day, _ in found] == ["2026-03-01"]
    assert stop_files.scan_latest(spark, str(tmp_path)).count() == 1
    for day in range(1, 41):
        write(tmp_path, f"2025-01-01_{day}".replace("_", "-") + "_x.csv", HEADER)
        write(tmp_path, f"19{day + 10}-01-01_istdaten.csv", HEADER)
    assert len(stop_files.daily_files(spark, str(tmp_path))) == 41


def test_long_quoted_text_in_a_short_row(spark, tmp_path):
    """A megabyte of quoted text, with doubled quotes and separators, in a row of too few or too many fields."""
    text = 'x;""y' * 200_000
    short = write(tmp_path, "short.csv", HEADER, f'1;"{text}";3')
    assert spark.range(1).count() == 1
    row = stop_files.scan_csv(spark.newSession(), short).first()
    assert len(row[1]) <= 1_000_000 and row[2:] == ("3", None, None, None)
    longer = write(tmp_path, "long.csv", HEADER, f'1;"{text}";3;4;5;6;7')
    with pytest.raises(Exception, match="more fields than its header"):
        stop_files.scan_csv(spark, longer).collect()
    assert spark.range(1).count() == 1
