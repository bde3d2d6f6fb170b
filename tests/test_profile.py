from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import stop
from stopmetrics.operators import profile, slices


def pairs(df):
    return {row[0]: row[1] for row in df.collect()}


def test_empty_input(spark, raw):
    empty = raw()
    assert pairs(profile.delay_summary(empty)) == {
        "count": 0.0, "mean": None, "median": None, "p95": None, "min": None, "max": None
    }
    rates = profile.null_rates(empty).collect()
    assert [row["column"] for row in rates] == sorted(empty.columns)
    assert {(row.null_count, row.null_rate_pct) for row in rates} == {(0, 0.0)}
    assert set(pairs(profile.column_types(empty)).values()) == {"string"}
    assert profile.value_distribution(empty, "VERKEHRSMITTEL_TEXT").count() == 0
    assert pairs(profile.formula_validation(empty)) == {"formula_match_max_abs_diff_min": 0.0, "validated_rows": 0.0}
    assert profile.executive_summary(empty).first().rows_total == 0


def test_metric_order(raw):
    assert [row.metric for row in profile.delay_summary(raw(stop())).collect()] == [
        "count", "mean", "median", "p95", "min", "max"
    ]


def test_column_types(spark):
    frame = spark.createDataFrame(
        [("1", "1", "true", "1", None, "1e3", 1.5), ("-2", ".5", "False", "x", None, "Inf", 2.5), (None,) * 7],
        "i string, d string, b string, s string, n string, e string, f double",
    )
    assert pairs(profile.column_types(frame)) == {
        "i": "bigint", "d": "double", "b": "boolean", "s": "string", "n": "string", "e": "double", "f": "double"
    }


def test_nan_counts_as_missing(spark):
    frame = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert profile.null_rates(frame).first().null_count == 2


def test_null_merges_with_its_text(raw):
    events = raw(
        stop(VERKEHRSMITTEL_TEXT=None), stop(VERKEHRSMITTEL_TEXT="NULL"), stop(VERKEHRSMITTEL_TEXT="S"), stop()
    )
    rows = [tuple(row) for row in profile.value_distribution(events, "VERKEHRSMITTEL_TEXT").collect()]
    assert rows == [("NULL", 2, 50.0), ("S", 2, 50.0)]
    assert [tuple(row) for row in profile.top_values(events, "VERKEHRSMITTEL_TEXT", 1).collect()] == rows[:1]


def test_edge_cases(raw):
    events = raw(
        stop(ANKUNFTSZEIT=None),
        stop(ANKUNFTSZEIT="never"),
        stop(AN_PROGNOSE_STATUS=None),
        stop(AN_PROGNOSE_STATUS="estimated"),
        stop(FAELLT_AUS_TF="YES"),
    )
    frames = slices.edge_case_frames(events)
    assert {name: frame.count() for name, frame in frames.items()} == {
        "null_arrivals": 1, "non_delay_status": 1, "cancelled": 1
    }
    assert slices.edge_preview(events, rows=1).count() == 3
    assert slices.filter_computable(events).count() == 1


def test_range_and_histogram(raw):
    actual = [f"01.03.2026 10:{minute:02d}:00" for minute in (0, 1, 2, 3, 59)] + ["01.03.2026 09:59:00"]
    events = raw(*[stop(actual=text) for text in actual])
    bins = {row.bin_start: row["count"] for row in profile.delay_histogram(events, -1, 3, 2).collect()}
    assert bins == {-2: 1, 0: 2, 2: 2}
    assert tuple(profile.range_coverage(events, -1, 3).first()) == (5, 6)
    assert slices.delay_range(events, -1, 3).count() == 5
    for call in (slices.delay_range, profile.range_coverage):
        with pytest.raises(ValueError, match="lowest delay"):
            call(events, 5, 5)
    with pytest.raises(ValueError, match="Bin width"):
        profile.delay_histogram(events, width=21)


def test_outliers(raw):
    events = raw(
        stop(actual="01.03.2026 13:00:01"), stop(actual="01.03.2026 13:00:00"), stop(actual="01.03.2026 08:59:59")
    )
    assert sorted(row.delay_min for row in slices.delay_outliers(events).collect()) == [-60.017, 180.017]
    assert slices.delay_outliers(events, limit=1).first().delay_min == -60.017


def test_times_are_parsed_once_and_files_scanned_once(spark, raw, tmp_path):
    raw(stop()).write.parquet(str(tmp_path / "x"))
    stored = spark.read.parquet(str(tmp_path / "x"))
    once = slices.with_delay(stored)._jdf.queryExecution().optimizedPlan().toString().count("regexp")
    for frame in (profile.delay_histogram(stored), slices.delay_range(stored), slices.delay_outliers(stored)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("regexp") == once
    assert slices.edge_preview(stored)._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_column_profile_equals_the_single_ones(spark):
    frame = spark.createDataFrame(
        [("1", " 2 ", "true", "1", None, float("nan"), 1), ("-2", ".5", "False", "true", "", 2.5, None), (None,) * 7],
        "i string, d string, b string, `s t` string, n string, f double, l long",
    )
    found = {row["column"]: row for row in profile.column_profile(frame).collect()}
    assert list(found) == sorted(frame.columns)
    assert {name: row.dtype for name, row in found.items()} == pairs(profile.column_types(frame))
    rates = {row["column"]: tuple(row[1:]) for row in profile.null_rates(frame).collect()}
    assert {name: (row.null_count, row.null_rate_pct) for name, row in found.items()} == rates
    nothing = profile.column_profile(frame.where("false")).collect()
    assert [(row.row_count, row.null_count, row.null_rate_pct) for row in nothing] == [(0, 0, 0.0)] * 7
    assert {row["column"]: row.dtype for row in nothing} == {
        "i": "string", "d": "string", "b": "string", "s t": "string", "n": "string", "f": "double", "l": "bigint"
    }


def test_texts_of_no_type_meet_one_pattern(spark):
    """The class of a text by the three patterns alone; a text that none can match is told by the first one tried."""
    texts = ["", " ", "7", " +7 ", "-7.5e3", ".5", ".", "1e", "inf", " -Infinity", "infer", "true", "True", " true", "trues", "x7", "7x", "\n7", "é"]
    df = spark.createDataFrame([(text,) for text in texts], "x string")
    value = F.col("x")
    by_patterns = (
        F.when(value.rlike(profile._INTEGER), 1)
        .when(value.rlike(profile._NUMBER), 2)
        .when(value.rlike(profile._BOOLEAN), 4)
        .otherwise(8)
    )
    assert df.where(by_patterns != profile._value_class("x")).collect() == []
    assert "_TYPED_START" in dir(profile) and df.where(~value.rlike(profile._TYPED_START)).count() >= 5
