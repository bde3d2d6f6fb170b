from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pytest

from conftest import stop
from stopmetrics.plans import lake
from stopmetrics.schema import RAW_COLUMNS
from stopmetrics.scratch import freed_shuffles, new_folder, shared_folder
from stopmetrics.sources.stop_files import scan_latest
from stopmetrics.streaming.ingest import incremental_ingest, reload_day
from stopmetrics.streaming.ledger import load_changed, read_ledger
from stopmetrics.verification import queries




def contents(spark, table):
    rows = spark.table(table).select(lake.DAY_COLUMN, "FAHRT_BEZEICHNER").collect()
    return sorted((str(row[0]), row[1]) for row in rows)


@pytest.fixture
def loaded(spark, raw, table_name):
    table = table_name()
    events = raw(
        stop("a"), stop("b", BETRIEBSTAG="2026-03-02"), stop("c", BETRIEBSTAG="2026-03-02"), stop("d", BETRIEBSTAG="?")
    )
    lake.load_table(events, table, new_folder(spark, "days"))
    return table


def test_replace_day(spark, raw, loaded):
    assert contents(spark, loaded) == [("2026-03-01", "a"), ("2026-03-02", "b"), ("2026-03-02", "c")]
    reload = raw(stop("x", BETRIEBSTAG="02.03.2026"), stop("other", BETRIEBSTAG="2026-03-01"), stop("bad", BETRIEBSTAG=None))
    for _ in range(2):
        lake.replace_day(reload, loaded, "2026-03-02")
        assert contents(spark, loaded) == [("2026-03-01", "a"), ("2026-03-02", "x")]


def test_replace_day_without_rows_clears_it(spark, raw, loaded):
    lake.replace_day(raw(stop("a")), loaded, "2026-03-02")
    assert contents(spark, loaded) == [("2026-03-01", "a")]


def test_replace_days_in_one_write(spark, raw, loaded):
    reload = raw(stop("x"), stop("y", BETRIEBSTAG="2026-03-03"), stop("z", BETRIEBSTAG="2026-03-04"))
    lake.replace_days(reload, loaded, ["2026-03-01", "2026-03-02", dt.date(2026, 3, 3)])
    assert contents(spark, loaded) == [("2026-03-01", "x"), ("2026-03-03", "y")]
    lake.replace_days(raw(), loaded, ["2026-03-01"])
    assert contents(spark, loaded) == [("2026-03-03", "y")]


def test_columns_match_by_name(spark, raw, loaded):
    shuffled = raw(stop("x")).select("SLOID", "FAHRT_BEZEICHNER", "BETRIEBSTAG")
    lake.replace_day(shuffled, loaded, "2026-03-01")
    assert ("2026-03-01", "x") in contents(spark, loaded)


def test_create_keeps_existing_rows_and_starts_empty(spark, raw, loaded, table_name):
    lake.create_day_table(raw(), loaded)
    assert spark.table(loaded).count() == 3
    fresh = table_name()
    lake.create_day_table(raw(stop()), fresh, new_folder(spark, "fresh"))
    assert spark.table(fresh).count() == 0
    assert spark.table(fresh).schema[lake.DAY_COLUMN].dataType.simpleString() == "date"


def test_lake_layout_by_target_day(spark, raw):
    root = new_folder(spark, "lake")
    lake.write_lake(raw(stop("a"), stop("b", BETRIEBSTAG="?")), root, target_day="2026-03-09")
    rows = lake.read_lake(spark, root).select("year", "month", "day").distinct().collect()
    assert [tuple(row) for row in rows] == [(2026, 3, 9)]


def test_load_check_and_missing_column(raw):
    events = raw(stop("a"), stop("b"), stop("c", BETRIEBSTAG="2026-03-02"))
    assert [tuple(r) for r in lake.load_check(lake.with_day(events), newest=1).collect()] == [(dt.date(2026, 3, 2), 1)]
    assert lake.add_missing_column(events).first()[lake.DAY_COLUMN] is None


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def daily(folder, day, *trips, rows_day=None, columns=RAW_COLUMNS):
    header = ";".join(columns)
    lines = [";".join([rows_day or day, trip] + [""] * (len(columns) - 2)) for trip in trips]
    (folder / f"{day}_istdaten.csv").write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


def run(spark, folder, table, state, **options):
    query = incremental_ingest(spark, str(folder), table, state, new_folder(spark, "ingest-table"), **options)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_incremental_ingest(spark, tmp_path, table_name, files_per_batch):
    table, state = table_name(), new_folder(spark, "state")
    for day, trip in (("2026-03-01", "a"), ("2026-03-02", "b"), ("2026-03-03", "c")):
        daily(tmp_path, day, trip, "n/a")
    expected = [(f"2026-03-0{i}", trip) for i, trip in ((1, "a"), (2, "b"), (3, "c"))]
    query = run(spark, tmp_path, table, state, files_per_batch=files_per_batch)
    assert [row for row in contents_text(spark, table) if row[1]] == expected
    assert len(query.recentProgress) == (3 if files_per_batch else 1)
    run(spark, tmp_path, table, state, files_per_batch=files_per_batch)
    assert spark.table(table).count() == 6
    daily(tmp_path, "2026-03-04", "d")
    run(spark, tmp_path, table, state, files_per_batch=files_per_batch)
    assert spark.table(table).count() == 7


def contents_text(spark, table):
    rows = spark.table(table).select(lake.DAY_COLUMN, "FAHRT_BEZEICHNER").collect()
    return sorted(((str(row[0]), row[1] or "") for row in rows))


def test_ingest_refuses_files_without_a_day_and_split_days(spark, tmp_path, table_name):
    named, split = tmp_path / "named", tmp_path / "split"
    named.mkdir()
    daily(named, "2026-03-01", "a")
    (named / "2026-03-01_istdaten.csv").rename(named / "other.csv")
    with pytest.raises(Exception, match="not named"):
        run(spark, named, table_name(), new_folder(spark, "state"))
    part = split / "2026-03-01_istdaten.csv"
    part.mkdir(parents=True)
    daily(part, "2026-03-01", "a")
    (part / "2026-03-01_istdaten.csv").rename(part / "part-0.csv")
    with pytest.raises(Exception, match="split over files"):
        run(spark, split / "*", table_name(), new_folder(spark, "state"))


def test_ingest_of_an_older_layout_and_of_rows_of_another_day(spark, tmp_path, table_name):
    table, older = table_name(), RAW_COLUMNS[:-1]
    daily(tmp_path, "2026-03-01", "a", columns=older)
    daily(tmp_path, "2026-03-02", "b", rows_day="2026-03-01", columns=older)
    run(spark, tmp_path, table, new_folder(spark, "state"), columns=older)
    assert contents(spark, table) == [("2026-03-01", "a")]
    with pytest.raises(Exception, match="header"):
        run(spark, tmp_path, table_name(), new_folder(spark, "state"))


def test_laying_out_a_day_leaves_the_others(spark, raw):
    root = new_folder(spark, "lake")
    lake.write_lake(raw(stop("a")), root, target_day="2026-03-01")
    lake.write_lake(raw(stop("b")), root, target_day="2026-03-02")
    lake.write_lake(raw(stop("c", BETRIEBSTAG="2026-03-02"), stop("d", BETRIEBSTAG="2026-03-03")), root)
    lake.write_lake(raw(stop("e"), stop("f")), root, target_day="2026-03-03")
    rows = lake.read_lake(spark, root).select("day", "FAHRT_BEZEICHNER").collect()
    assert sorted(tuple(row) for row in rows) == [(1, "a"), (2, "c"), (3, "e"), (3, "f")]


def test_new_columns_reach_the_table(spark, raw, table_name):
    table = table_name()
    older = raw(stop("a")).drop("SLOID")
    lake.create_day_table(older, table, new_folder(spark, "grows"))
    lake.replace_days(older, table)
    lake.replace_day(raw(stop("b", BETRIEBSTAG="2026-03-02", SLOID="s")), table, "2026-03-02")
    rows = spark.table(table).select("FAHRT_BEZEICHNER", "SLOID", lake.DAY_COLUMN).collect()
    assert sorted((r[0], r[1], str(r[2])) for r in rows) == [("a", None, "2026-03-01"), ("b", "s", "2026-03-02")]


def part(folder, day, name, *trips):
    (folder / f"{day}_istdaten.csv").mkdir(parents=True, exist_ok=True)
    daily(folder / f"{day}_istdaten.csv", day, *trips)
    (folder / f"{day}_istdaten.csv" / f"{day}_istdaten.csv").rename(folder / f"{day}_istdaten.csv" / f"part-{name}.csv")


def test_ingest_takes_part_files_of_a_day_as_a_whole_only(spark, tmp_path, table_name):
    table, state = table_name(), new_folder(spark, "state")
    with pytest.raises(ValueError, match="1 or None"):
        run(spark, tmp_path, table, state, files_per_batch=2)
    for name in "abcd":
        part(tmp_path, "2026-03-01", name, f"t{name}")
    run(spark, tmp_path / "*", table, state, files_per_batch=None)
    assert [trip for _, trip in contents_text(spark, table)] == ["ta", "tb", "tc", "td"]
    part(tmp_path, "2026-03-01", "e", "te")
    with pytest.raises(Exception, match="were loaded before"):
        run(spark, tmp_path / "*", table, state, files_per_batch=None)
    assert spark.table(table).count() == 4
    reload_day(spark, str(tmp_path / "2026-03-01_istdaten.csv"), table, "2026-03-01")
    assert spark.table(table).count() == 5


def test_ingest_refuses_files_without_rows_and_without_columns(spark, tmp_path, table_name):
    table = table_name()
    daily(tmp_path, "2026-03-01")
    for _ in range(2):  # a refused file is tried again, not taken for loaded
        with pytest.raises(Exception, match="No stop events in"):
            run(spark, tmp_path, table, new_folder(spark, "state"))
    with pytest.raises(ValueError, match="Missing required columns: FAELLT_AUS_TF"):
        run(spark, tmp_path, table, new_folder(spark, "state"), columns=[c for c in RAW_COLUMNS if c != "FAELLT_AUS_TF"])


def test_a_reloaded_day_is_seen_by_who_read_it_before(spark, tmp_path, table_name):
    table, state = table_name(), new_folder(spark, "state")
    daily(tmp_path, "2026-03-01", "a")
    run(spark, tmp_path, table, state)
    assert contents_text(spark, table) == [("2026-03-01", "a")]
    (tmp_path / "again").mkdir()
    daily(tmp_path / "again", "2026-03-01", "b", "c")
    location = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()[1]
    incremental_ingest(spark, str(tmp_path / "again"), table, new_folder(spark, "state"), location).awaitTermination()
    assert [trip for _, trip in contents_text(spark, table)] == ["b", "c"]
    daily(tmp_path, "2026-03-01", "d")  # corrected under the same name
    run(spark, tmp_path, table, state)
    assert [trip for _, trip in contents_text(spark, table)] == ["b", "c"]
    reload_day(spark, str(tmp_path / "2026-03-01_istdaten.csv"), table, "2026-03-01")
    assert contents_text(spark, table) == [("2026-03-01", "d")]


def test_intermediates_need_a_shared_folder():
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="Set spark.checkpoint.dir"):
        shared_folder(Session())


def test_rows_without_a_day_stay_through_later_loads(spark, raw):
    root = new_folder(spark, "lake")
    lake.write_lake(raw(stop("a"), stop("x", BETRIEBSTAG="?"), stop("y", BETRIEBSTAG=None)), root, source="first.csv")
    lake.write_lake(raw(stop("b", BETRIEBSTAG="2026-03-02"), stop("z", BETRIEBSTAG="31.02.2026")), root, source="s/2 é.csv")
    lake.write_lake(raw(stop("u", BETRIEBSTAG="")), root)
    lake.write_lake(raw(stop("v", BETRIEBSTAG="")), root)

    def held():
        rows = lake.read_lake(spark, root).select("day", "FAHRT_BEZEICHNER").collect()
        return sorted(((row[0] or 0), row[1]) for row in rows)

    assert held() == [(0, "u"), (0, "v"), (0, "x"), (0, "y"), (0, "z"), (1, "a"), (2, "b")]
    lake.write_lake(raw(stop("a"), stop("w", BETRIEBSTAG="?")), root, source="first.csv")
    assert held() == [(0, "u"), (0, "v"), (0, "w"), (0, "z"), (1, "a"), (2, "b")]
    lake.write_lake(raw(stop("a")), root, source="first.csv")
    assert held() == [(0, "u"), (0, "v"), (0, "z"), (1, "a"), (2, "b")]


def test_a_lake_of_undated_rows_only_and_an_empty_one(spark, raw):
    root = new_folder(spark, "lake")
    with pytest.raises(ValueError, match="No stop events"):
        lake.read_lake(spark, root)
    lake.write_lake(raw(stop("x", BETRIEBSTAG="?")), root)
    assert [tuple(r) for r in lake.read_lake(spark, root).select("year", "FAHRT_BEZEICHNER").collect()] == [(None, "x")]


def test_ledger_loads_corrected_files_once(spark, tmp_path, table_name):
    table, entries, place = table_name(), new_folder(spark, "ledger"), new_folder(spark, "days")
    load = lambda: load_changed(spark, str(tmp_path), table, entries, place)
    assert load() == []
    for day, trip in (("2026-03-01", "a"), ("2026-03-02", "b")):
        daily(tmp_path, day, trip, "n/a")
    assert load() == ["2026-03-01", "2026-03-02"]
    before = read_ledger(spark, entries).count()
    assert load() == [] and read_ledger(spark, entries).count() == before == 2
    daily(tmp_path, "2026-03-02", "corrected", "twice")
    daily(tmp_path, "2026-03-03", "c")
    assert load() == ["2026-03-02", "2026-03-03"]
    expected = [("2026-03-01", "a"), ("2026-03-02", "corrected"), ("2026-03-02", "twice"), ("2026-03-03", "c")]
    assert [row for row in contents_text(spark, table) if row[1]] == expected
    assert load() == []


def test_ledger_takes_nothing_from_a_failed_load(spark, tmp_path, table_name):
    table, entries, place = table_name(), new_folder(spark, "ledger"), new_folder(spark, "days")
    daily(tmp_path, "2026-03-01", "a")
    assert load_changed(spark, str(tmp_path), table, entries, place) == ["2026-03-01"]
    daily(tmp_path, "2026-03-01")
    with pytest.raises(ValueError, match="No stop events of their day"):
        load_changed(spark, str(tmp_path), table, entries, place)
    assert spark.table(table).count() == 1
    assert read_ledger(spark, entries).count() == 1
    daily(tmp_path, "2026-03-01", "b")
    assert load_changed(spark, str(tmp_path), table, entries, place) == ["2026-03-01"]
    (tmp_path / "again").mkdir()
    daily(tmp_path / "again", "2026-03-05", "x")
    daily(tmp_path, "2026-03-05", "y")
    with pytest.raises(ValueError, match="Two changed files"):
        load_changed(spark, str(tmp_path), table, entries, place)


def test_ledger_notes_all_days_in_one_metric(spark, tmp_path, table_name, monkeypatch):
    """A metric per day is a comparison per row and day."""
    noted = []
    kind = type(spark.range(1))
    observe = kind.observe
    monkeypatch.setattr(kind, "observe", lambda df, name, *exprs: noted.append(len(exprs)) or observe(df, name, *exprs))
    days = [f"2026-03-{day:02}" for day in range(1, 6)]
    for day in days:
        daily(tmp_path, day, "a")
    assert load_changed(spark, str(tmp_path), table_name(), new_folder(spark, "ledger"), new_folder(spark, "days")) == days
    assert noted == [1]


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {name for name in names if name.startswith("shuffle_")}


def left_over(spark, before: set[str]) -> set[str]:
    """Shuffle files that are there for longer than Spark takes to remove them."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_daily_files_are_compressed_and_leave_no_shuffle_behind(spark, raw):
    events = [stop("a"), *[stop(f"b{i}", BETRIEBSTAG="2026-03-02", AN_PROGNOSE=f" 02.03.2026 10:{i}:00 ") for i in (10, 11)]]
    before = shuffle_files(spark)
    root = queries._write_daily_csv(raw(*events), "daily")
    assert not left_over(spark, before)
    files = [path for path in Path(root).rglob("part-*")]
    assert {path.parent.name for path in files} == {"file=2026-03-01_istdaten.csv", "file=2026-03-02_istdaten.csv"}
    assert all(path.name.endswith(".csv.gz") for path in files)
    latest = {(row.FAHRT_BEZEICHNER, row.AN_PROGNOSE) for row in scan_latest(spark, root).collect()}
    assert latest == {("b10", " 02.03.2026 10:10:00 "), ("b11", " 02.03.2026 10:11:00 ")}


def test_the_setting_that_frees_shuffles_is_given_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError), freed_shuffles(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name, None) == before
    spark.conf.set(name, "false")
    with freed_shuffles(spark):
        pass
    assert spark.conf.get(name) == "false"
    spark.conf.unset(name)
