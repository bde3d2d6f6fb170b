from __future__ import annotations

import datetime as dt
from collections import defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F

from conftest import stop
from test_lake import left_over, shuffle_files
from stopmetrics.operators import quality
from stopmetrics.operators.profile import column_profile
from stopmetrics.operators.slices import slice_dates_types
from stopmetrics.plans import build, insights, lake, warehouse
from stopmetrics.scratch import new_folder
from stopmetrics.verification.stop_view import raw_stop_events


def clock(minutes, form="%d.%m.%Y %H:%M:%S"):
    return (dt.datetime(2026, 3, 1) + dt.timedelta(minutes=minutes)).strftime(form)


@pytest.fixture
def skewed(raw):
    """Two thirds of the rows in one trip, with repeats, cancellations and equal times; the rest in small trips."""
    events = []
    for i in range(900):
        trip = "hot" if i % 3 else f"t{i % 50}"
        station = str(8500000 + i % 211)
        at = 300 + (i * 7) % 900 // 3
        events.append(
            stop(
                trip,
                station,
                arrival=clock(at),
                actual=clock(at + i % 9 - 2),
                ABFAHRTSZEIT=clock(at + 1),
                AB_PROGNOSE=clock(at + 1 + i % 4) if i % 5 else None,
                FAELLT_AUS_TF="true" if i % 17 == 0 else "false",
                DURCHFAHRT_TF="true" if i % 13 == 0 else "false",
                AN_PROGNOSE_STATUS=("REAL", "ESTIMATED", "FORECAST", "UNKNOWN", None)[i % 11 % 5],
                VERKEHRSMITTEL_TEXT=("S", "IC", None)[i % 3],
            )
        )
    return raw(*events).repartition(4)


def minutes(start, end):
    return None if start is None or end is None else int((end - start).total_seconds() / 60)


def measured(row):
    if row.is_cancelled or row.arrival_status not in ("REAL", "ESTIMATED"):
        return None
    return minutes(row.scheduled_arrival_at, row.actual_arrival_at)


def test_hub_propagation_by_brute_force(skewed):
    flagged = warehouse.stops_flagged(skewed).cache()
    trips = defaultdict(list)
    for row in flagged.collect():
        if measured(row) is not None:
            trips[row.operating_day, row.trip_id].append(row)
    expected = defaultdict(lambda: [0, [], 0, 0, 0])
    for rows in trips.values():
        rows.sort(key=lambda r: (r.scheduled_departure_at or r.scheduled_arrival_at, r.station_code))
        for row, after in zip(rows, [*rows[1:], None]):
            entry = expected[row.station_code]
            late = measured(row) >= 3
            leaving = minutes(row.scheduled_departure_at, row.actual_departure_at)
            entry[0] += 1
            entry[1] += [] if leaving is None else [leaving - measured(row)]
            entry[2] += late
            entry[3] += late and after is not None
            entry[4] += late and after is not None and measured(after) >= 3
    found = {row.station_code: row for row in insights.hub_propagation(flagged).collect()}
    assert found.keys() == expected.keys()
    for code, (stops, added, late, followed, passed) in expected.items():
        row = found[code]
        assert (row.n_stops, row.n_late_in) == (stops, late)
        assert row.avg_added_min == (pytest.approx(sum(added) / len(added)) if added else None)
        assert row.pct_late_passed_on == (pytest.approx(100 * passed / followed, abs=5e-4) if followed else None)


def test_station_fact_by_brute_force(skewed):
    flagged = warehouse.stops_flagged(skewed).cache()
    groups = defaultdict(list)
    for row in flagged.collect():
        groups[row.operating_day, row.station_code, row.transport_type].append(row)
    fact = warehouse.fct_station_delays(flagged).collect()
    assert len(fact) == len(groups)
    for row in fact:
        members = groups[row.operating_day, row.station_code, row.transport_type]
        delays = [d for d in map(measured, members) if d is not None]
        assert row.total_stop_events == len(members)
        assert row.total_cancelled == sum(m.is_cancelled for m in members)
        assert row.median_arrival_delay == (median(delays) if delays else None)
        assert row.avg_arrival_delay_min == (pytest.approx(sum(delays) / len(delays)) if delays else None)
        expected = 100 * sum(d <= 0 for d in delays) / len(delays) if delays else None
        assert row.pct_on_time == (None if expected is None else pytest.approx(expected, abs=5e-4))


def test_both_facts_count_the_same_stops(skewed):
    flagged = warehouse.stops_flagged(skewed)
    totals = [F.sum("total_stop_events"), F.sum("total_cancelled")]
    daily = warehouse.fct_daily_delays(flagged).agg(*totals).first()
    assert daily == warehouse.fct_station_delays(flagged).agg(*totals).first()
    assert daily[0] == flagged.count()


def test_dedup_keeps_the_real_stop_and_leaves_no_repeats(skewed, raw):
    assert quality.test_unique(warehouse.typed_stops(skewed)).count() > 0
    assert quality.test_unique(warehouse.stops_flagged(skewed)).count() == 0
    pair = raw(stop(DURCHFAHRT_TF="true", arrival="01.03.2026 09:00"), stop(arrival="01.03.2026 11:00"))
    kept = warehouse.dedup_stops(warehouse.typed_stops(pair)).collect()
    assert [row.is_pass_through for row in kept] == [False]


def longest_generated_method(df):
    """Bytes of the longest method of whole-stage code; the JVM interprets those of more than 8000."""
    debug = getattr(getattr(df.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max((stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())), default=0)


@pytest.fixture
def given(spark, tmp_path):
    """A folder with one order of the given tables, from which the stop view is made."""
    tables = {
        "nation": ("n_nationkey int, n_name string", (1, "N")),
        "customer": ("c_custkey long, c_nationkey int", (7, 1)),
        "supplier": ("s_suppkey long, s_name string", (5, "S")),
        "orders": ("o_orderkey long, o_custkey long, o_orderpriority string", (4, 7, "1-URGENT")),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string",
            (4, 34, 5, 2, 9.0, "N"),
        ),
    }
    for name, (schema, row) in tables.items():
        spark.createDataFrame([row], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_generated_methods_are_short_enough_to_be_compiled(spark, given):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        view = raw_stop_events(spark, given)
        for made in (warehouse.typed_stops(view), warehouse.stops_flagged(view), lake.with_day(view), column_profile(view)):
            assert longest_generated_method(made) <= 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert view.select("BETRIEBSTAG", "ANKUNFTSZEIT", "AB_PROGNOSE").first() == (
        "05.01.2026",
        "05.01.2026 05:34",
        "05.01.2026 05:54:39",
    )


def test_quality_checks(raw):
    staged = warehouse.stg_stop_events(
        raw(stop(), stop("t2", arrival=None), stop("t3", actual="01.03.2026 13:01:00"), stop("t4", FAELLT_AUS_TF="1"))
    )
    failures = {row["column"]: row.failures for row in quality.test_not_null(staged).collect()}
    assert failures == {"operating_day": 0, "trip_id": 0, "station_code": 0, "scheduled_arrival_at": 1}
    offenders = quality.test_delay_reasonable(warehouse.int_delays(staged)).collect()
    assert [row.arrival_delay_min for row in offenders] == [181]
    typed = warehouse.typed_stops(raw(stop(AN_PROGNOSE_STATUS="odd"), stop(AN_PROGNOSE_STATUS=None), stop()))
    assert [tuple(row) for row in quality.test_accepted_values(typed).collect()] == [("ODD", 1)]


def test_dimension_takes_newest_attributes(raw):
    staged = warehouse.stg_stop_events(
        raw(
            stop("a", BETRIEBSTAG="2026-03-02", BETREIBER_ABK="NEW", BETREIBER_NAME=None),
            stop("b", BETRIEBSTAG="2026-03-02", BETREIBER_ABK="NEW", BETREIBER_NAME="n"),
            stop("c", BETRIEBSTAG="2026-03-01", BETREIBER_ABK="OLD", BETREIBER_NAME="z"),
            stop("d", BETREIBER_ID=None),
        )
    )
    assert [tuple(row) for row in warehouse.dim_operators(staged).collect()] == [("85:11", "NEW", "n")]


def test_build_warehouse(spark, skewed):
    tables = build.build_warehouse(skewed, new_folder(spark, "warehouse"))
    direct = warehouse.fct_daily_delays(warehouse.stops_flagged(skewed))
    assert sorted(map(str, tables["fct_daily_delays"].select(direct.columns).collect())) == sorted(
        map(str, direct.collect())
    )
    assert tables["dim_stations"].count() == tables["stg_stop_events"].select("station_code").distinct().count()
    chosen = slice_dates_types(tables["fct_daily_delays"], dt.date(2026, 3, 1), dt.date(2026, 3, 1), ["S"])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(operating_day" in plan and "In(transport_type" in plan.replace("EqualTo", "In")


def test_stops_without_a_whole_key_stay(raw):
    events = raw(*[stop(None, "?", arrival=f"01.03.2026 1{i}:00") for i in range(5)], stop("t"), stop("t"))
    flagged = warehouse.stops_flagged(events)
    assert flagged.count() == 6
    failures = {r.column: r.failures for r in quality.test_not_null(warehouse.without_cancelled(flagged)).collect()}
    assert failures["trip_id"] == failures["station_code"] == 5


def test_every_fact_finds_its_dimension_rows(raw):
    events = raw(stop("a"), stop("b", "8500009", FAELLT_AUS_TF="true", HALTESTELLEN_NAME="Closed", VERKEHRSMITTEL_TEXT="IC"))
    flagged = warehouse.stops_flagged(events)
    joined = warehouse.star_join(
        warehouse.fct_station_delays(flagged),
        (warehouse.dim_stations(flagged), "station_code"),
        (warehouse.dim_transport_types(flagged), "transport_type"),
    )
    found = {(r.station_code, r.station_name, r.description) for r in joined.collect()}
    assert found == {(8500001, "Station 8500001", "Suburban train"), (8500009, "Closed", "InterCity")}


def test_refreshing_days_equals_a_full_build_and_keeps_other_files(spark, raw, tmp_path):
    root, full = str(tmp_path / "daily"), str(tmp_path / "full")
    first = [stop("a"), stop("b", BETRIEBSTAG="2026-03-02"), stop("c", BETRIEBSTAG="2026-03-02")]
    build.build_warehouse(raw(*first), root)

    def files(day):
        return sorted(p.name for p in (tmp_path / "daily/fct_daily_delays" / f"operating_day={day}").glob("*.parquet"))

    kept = files("2026-03-01")
    changed = [first[0], stop("b", BETRIEBSTAG="2026-03-02"), stop("d", "8500007", BETRIEBSTAG="2026-03-03")]
    build.build_warehouse(raw(*changed), root, days=["2026-03-02", dt.date(2026, 3, 3)])
    expected = build.build_warehouse(raw(*changed), full)
    assert files("2026-03-01") == kept
    for name in ("stops_flagged", "fct_daily_delays", "fct_station_delays", "dim_stations", "dim_transport_types"):
        now = spark.read.parquet(f"{root}/{name}").select(expected[name].columns)
        assert sorted(map(str, now.collect())) == sorted(map(str, expected[name].collect())), name


def test_a_day_without_rows_is_cleared_and_untouched_days_are_not_read(spark, raw, tmp_path):
    root = str(tmp_path / "w")
    events = [stop("a"), stop("b", BETRIEBSTAG="2026-03-02", HALTESTELLEN_NAME="New"), stop("c", "8500009", BETRIEBSTAG="2026-03-02")]
    build.build_warehouse(raw(*events), root)
    for folder in ("stops_flagged", "delay_state", "log_dim_stations"):  # unreadable from now on
        for path in (tmp_path / "w" / folder / "operating_day=2026-03-01").glob("*.parquet"):
            if folder == "stops_flagged":
                path.write_bytes(b"no parquet")
    tables = build.build_warehouse(raw(events[0]), root, days=["2026-03-02"])
    assert [str(r.operating_day) for r in tables["fct_daily_delays"].collect()] == ["2026-03-01"]
    assert [str(r.operating_day) for r in tables["fct_station_delays"].collect()] == ["2026-03-01"]
    assert [tuple(r) for r in tables["dim_stations"].select("station_code", "station_name").collect()] == [
        (8500001, "Station 8500001")
    ]
    later = build.build_warehouse(raw(*events), root, days=["2026-03-02"])
    assert later["fct_daily_delays"].count() == 2
    names = {r.station_code: r.station_name for r in later["dim_stations"].collect()}
    assert names == {8500001: "New", 8500009: "Station 8500009"}


def test_state_answers_for_coarser_keys(spark, skewed):
    flagged = warehouse.stops_flagged(skewed)
    state = warehouse.delay_state(flagged)
    assert sorted(map(str, warehouse.daily_from_state(state).collect())) == sorted(
        map(str, warehouse.fct_daily_delays(flagged).collect())
    )
    halves = [flagged.where(f"pmod(hash(trip_id), 2) = {i}") for i in (0, 1)]
    merged = warehouse.delay_state(halves[0]).unionByName(warehouse.delay_state(halves[1]))
    for make in (warehouse.monthly_line_delays, warehouse.station_from_state, warehouse.state_histogram):
        assert sorted(map(str, make(merged).collect())) == sorted(map(str, make(state).collect()))


def test_chains_by_a_walk_over_each_trip(skewed):
    flagged = warehouse.stops_flagged(skewed)
    found = sorted(tuple(r)[3:] for r in insights.delay_chains(flagged).collect())
    stops = [
        r
        for r in flagged.withColumn("arr", warehouse.arrival_delay()).collect()
        if not r.is_cancelled and (r.arrival_status or "") in ("REAL", "ESTIMATED")
        and None not in (r.operating_day, r.trip_id, r.station_code, r.arr)
    ]
    trips = {}
    for r in stops:
        at = r.scheduled_departure_at or r.scheduled_arrival_at
        trips.setdefault((r.operating_day, r.trip_id), []).append((at is None, at, r.station_code, r.arr))
    expected = []
    for trip in trips.values():
        run = []
        for _, _, station, arr in [*sorted(trip, key=lambda s: (s[0], str(s[1]), s[2])), (0, 0, 0, 0)]:
            if arr >= 3:
                run.append((station, arr))
            elif run:
                expected.append((run[0][0], run[0][1], len(run), max(a for _, a in run)))
                run = []
    assert found == sorted(expected) and found


def test_tiles_in_one_pass_equal_the_single_ones(skewed):
    delays = warehouse.int_delays(warehouse.stg_stop_events(skewed))
    whole = insights.tiles(delays)
    for name, single in (
        ("delay_by_type", insights.tile_delay_by_type(delays)),
        ("on_time_trend", insights.tile_on_time_trend(delays)),
        ("hour_weekday", insights.tile_hour_weekday(delays)),
        ("season_profile", insights.season_profile(delays)),
    ):
        mine = whole.where(whole.tile == name).select(single.columns)
        assert sorted(map(str, mine.collect())) == sorted(map(str, single.collect())), name
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Range") == 1


def test_build_counts_offenders_as_it_writes(spark, raw, skewed):
    odd = raw(
        stop("odd", "1", actual="01.03.2026 20:00:00"),
        stop("odd", "2", arrival=None),
        stop("odd", "3", AN_PROGNOSE_STATUS="GUESSED"),
        stop(None, "4"),
    )
    tables = build.build_warehouse(skewed.unionByName(odd), new_folder(spark, "checked"))
    found = {row.check: row.failures for row in tables["checks"].collect()}
    flagged = tables["stops_flagged"]
    nulls = {f"not_null_{row['column']}": row.failures for row in quality.test_not_null(flagged).collect()}
    values = quality.test_accepted_values(flagged).agg(F.sum("occurrences")).first()[0]
    late = quality.test_delay_reasonable(tables["int_delays"]).count()
    assert found == nulls | {"accepted_arrival_status": values, "within_arrival_delay": late}
    assert found["not_null_trip_id"] == values == late == 1
    assert {row.row_count for row in tables["checks"].collect()} == {flagged.count()}
    empty = build.build_warehouse(raw(), new_folder(spark, "checked"))["checks"].collect()
    assert {(row.row_count, row.failures) for row in empty} == {(0, 0)}


def test_a_strict_check_leaves_the_old_tables(spark, raw):
    root = new_folder(spark, "strict")
    strict = [*build.stop_checks(), *quality.not_null("line_name", strict=True)]
    build.build_warehouse(raw(stop("a"), stop("b")), root, checks=strict)
    names = ("stops_flagged", "fct_daily_delays", "fct_station_delays", "dim_stations", "delay_state")

    def rows():
        return {name: sorted(map(str, spark.read.parquet(f"{root}/{name}").collect())) for name in names}

    before = rows()
    with pytest.raises(Exception, match="fails the check not_null_line_name"):
        build.build_warehouse(raw(stop("a"), stop("c", LINIEN_TEXT=None)), root, days=["2026-03-01"], checks=strict)
    assert rows() == before
    assert before["stops_flagged"]


def test_bloom_filters_skip_row_groups(spark, raw, table_name, tmp_path):
    """A trip that no row has, within the least and greatest one, is looked up without its dictionary."""

    def scanned(frame):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan()
        return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()

    events = [stop(f"trip{i:05d}", str(8500000 + i)) for i in range(0, 2000, 2)]
    flagged = build.build_warehouse(raw(*events), f"{tmp_path}/warehouse")["stops_flagged"]
    table = table_name()
    lake.load_table(raw(*events), table, f"{tmp_path}/days")
    for path, column in ((f"{tmp_path}/warehouse/stops_flagged", "trip_id"), (f"{tmp_path}/days", "FAHRT_BEZEICHNER")):
        stored = spark.read.option("parquet.filter.dictionary.enabled", "false").parquet(path)
        assert scanned(stored.where(F.col(column) == "trip00500")) > 0
        assert scanned(stored.where(F.col(column) == "trip00501")) == 0
    assert flagged.count() == len(events)


def test_a_build_holds_one_shuffle_of_whole_rows_at_a_time(spark, raw, tmp_path, monkeypatch):
    """What is laid out by day was deduplicated by an earlier write; nothing of that stays, and no shuffle."""
    plans, store = {}, build.store

    def noted(df, path, *args, **kwargs):
        plans[path.rpartition("/")[2]] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, path, *args, **kwargs)

    monkeypatch.setattr(build, "store", noted)
    before = shuffle_files(spark)
    tables = build.build_warehouse(raw(stop("a"), stop("a", arrival="01.03.2026 09:00"), stop("b")), str(tmp_path))
    assert not left_over(spark, before)
    assert "Window" not in plans["stops_flagged"] and "Relation" in plans["stops_flagged"]
    assert tables["stops_flagged"].count() == 2
    (aside,) = (tmp_path / "_aside").iterdir()
    assert spark.read.schema(tables["stops_flagged"].schema).parquet(str(aside)).count() == 0
