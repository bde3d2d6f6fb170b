"""DuckDB SQL for each registered query. Rules and fixed values are stated anew; column names and the parameters of the
queries are shared with the code under test.

DuckDB sees only the given tables, so every statement starts with the stop-event view as CTEs.
"""

from __future__ import annotations

from stopmetrics.schema import RAW_COLUMNS, STAGING_NAMES
from stopmetrics.verification.queries import BASE_URL, CHOSEN_TYPES, FIRST_DAY, LAST_DAY, RELOADED_DAY

_MINUTE, _SECOND, _ISO = "%d.%m.%Y %H:%M", "%d.%m.%Y %H:%M:%S", "%Y-%m-%d %H:%M:%S"


def _at(seconds: str, pattern: str) -> str:
    return f"strftime(CAST(op_day AS TIMESTAMP) + to_seconds(CAST({seconds} AS BIGINT)), '{pattern}')"


_BASE = """
base AS (
  SELECT *,
    DATE '2026-01-01' + CAST(l_orderkey % 90 AS INTEGER) AS op_day,
    300 + (l_orderkey * 7) % 1080 + 6 * (l_linenumber - 1) AS arr_min,
    (l_partkey * 37 + l_suppkey * 11 + l_linenumber * 53) % 1500 - 240
      + CASE WHEN l_partkey % 211 = 0 THEN 12000 WHEN l_partkey % 223 = 0 THEN -4000 ELSE 0 END AS delay_s
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

_RAW = f"""
raw AS (
  SELECT
    CASE WHEN l_orderkey % 2 = 0 THEN {_at('0', '%d.%m.%Y')} ELSE {_at('0', '%Y-%m-%d')} END AS BETRIEBSTAG,
    CAST(l_orderkey AS VARCHAR) AS FAHRT_BEZEICHNER,
    '85:' || n_nationkey AS BETREIBER_ID,
    'OP' || n_nationkey AS BETREIBER_ABK,
    n_name AS BETREIBER_NAME,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Bus' ELSE 'Zug' END AS PRODUKT_ID,
    CAST(o_custkey % 12 + 1 AS VARCHAR) AS LINIEN_ID,
    'L' || (o_custkey % 12 + 1) AS LINIEN_TEXT,
    CAST(NULL AS VARCHAR) AS UMLAUF_ID,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL
         WHEN o_orderpriority = '1-URGENT' THEN 'IC'
         WHEN o_orderpriority = '2-HIGH' THEN 'IR'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'S'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Bus'
         ELSE 'RE' END AS VERKEHRSMITTEL_TEXT,
    CASE WHEN l_orderkey % 41 = 0 THEN 'true' ELSE 'false' END AS ZUSATZFAHRT_TF,
    CASE CAST(l_quantity AS BIGINT) WHEN 1 THEN 'true' WHEN 2 THEN 'TRUE' WHEN 3 THEN '1' WHEN 4 THEN 'yes'
         WHEN 5 THEN NULL WHEN 6 THEN 't' WHEN 7 THEN '1.0' ELSE 'false' END AS FAELLT_AUS_TF,
    CAST(8500000 + l_suppkey AS VARCHAR) AS BPUIC,
    s_name AS HALTESTELLEN_NAME,
    CASE WHEN l_linenumber <> 1 THEN {_at('arr_min * 60', _MINUTE)} END AS ANKUNFTSZEIT,
    CASE WHEN l_linenumber = 1 THEN NULL
         WHEN l_partkey % 101 = 0 THEN 'n/a'
         WHEN l_partkey % 17 = 0 THEN {_at('arr_min * 60 + delay_s', _ISO)}
         WHEN l_partkey % 19 = 0 THEN ' ' || {_at('arr_min * 60 + delay_s', _SECOND)} || ' '
         ELSE {_at('arr_min * 60 + delay_s', _SECOND)} END AS AN_PROGNOSE,
    CASE WHEN l_partkey % 20 <= 10 THEN 'REAL' WHEN l_partkey % 20 <= 14 THEN 'ESTIMATED'
         WHEN l_partkey % 20 = 15 THEN 'real' WHEN l_partkey % 20 = 16 THEN 'FORECAST'
         WHEN l_partkey % 20 = 17 THEN 'UNKNOWN' WHEN l_partkey % 20 = 19 THEN 'NULL' END AS AN_PROGNOSE_STATUS,
    CASE WHEN l_linenumber <> 7 THEN {_at('(arr_min + 1) * 60', _MINUTE)} END AS ABFAHRTSZEIT,
    CASE WHEN l_linenumber <> 7
         THEN {_at('(arr_min + 1) * 60 + delay_s + (l_suppkey % 5) * 30', _SECOND)} END AS AB_PROGNOSE,
    CASE WHEN l_partkey % 20 <= 10 THEN 'REAL' WHEN l_partkey % 20 <= 14 THEN 'ESTIMATED'
         ELSE 'UNKNOWN' END AS AB_PROGNOSE_STATUS,
    CASE WHEN l_returnflag = 'R' AND l_partkey % 5 = 0 THEN 'true' ELSE 'false' END AS DURCHFAHRT_TF,
    'ch:1:sloid:' || l_suppkey AS SLOID
  FROM base
)"""


def _stamp(column: str) -> str:
    return (
        f"COALESCE(try_strptime(trim({column}), '{_SECOND}'), try_strptime(trim({column}), '{_MINUTE}'), "
        f"TRY_CAST(trim({column}) AS TIMESTAMP))"
    )


def _day(column: str) -> str:
    return f"CAST(COALESCE(try_strptime({column}, '%Y-%m-%d'), try_strptime({column}, '%d.%m.%Y')) AS DATE)"


def _flag(column: str) -> str:
    return f"COALESCE(lower({column}) IN ('true', '1', 't', 'yes'), FALSE)"


_STATUS = "upper(COALESCE(AN_PROGNOSE_STATUS, ''))"
_MEASURED = f"{_STATUS} IN ('REAL', 'ESTIMATED')"
_CANCELLED = _flag("FAELLT_AUS_TF")
_DELAY = f"round(date_diff('microsecond', {_stamp('ANKUNFTSZEIT')}, {_stamp('AN_PROGNOSE')}) / 6e7, 3)"
_WHOLE_DELAY = "datesub('minute', scheduled_arrival_at, actual_arrival_at)"

_TYPED_VALUES = {
    "BETRIEBSTAG": _day("BETRIEBSTAG"),
    "LINIEN_ID": "TRY_CAST(LINIEN_ID AS INTEGER)",
    "BPUIC": "TRY_CAST(BPUIC AS INTEGER)",
    "ZUSATZFAHRT_TF": _flag("ZUSATZFAHRT_TF"),
    "FAELLT_AUS_TF": _CANCELLED,
    "DURCHFAHRT_TF": _flag("DURCHFAHRT_TF"),
    "ANKUNFTSZEIT": _stamp("ANKUNFTSZEIT"),
    "AN_PROGNOSE": _stamp("AN_PROGNOSE"),
    "ABFAHRTSZEIT": _stamp("ABFAHRTSZEIT"),
    "AB_PROGNOSE": _stamp("AB_PROGNOSE"),
    "AN_PROGNOSE_STATUS": "upper(AN_PROGNOSE_STATUS)",
    "AB_PROGNOSE_STATUS": "upper(AB_PROGNOSE_STATUS)",
}
_TYPED = "\ntyped AS (SELECT " + ", ".join(
    f"{_TYPED_VALUES.get(name, name)} AS {new}" for name, new in STAGING_NAMES.items()
) + " FROM raw)"

_FIRST_STOP = """QUALIFY row_number() OVER (PARTITION BY operating_day, trip_id, station_code ORDER BY
    is_pass_through NULLS LAST, scheduled_arrival_at NULLS LAST, scheduled_departure_at NULLS LAST,
    actual_arrival_at NULLS LAST, actual_departure_at NULLS LAST, arrival_status NULLS LAST,
    is_cancelled NULLS LAST, line_name NULLS LAST, transport_type NULLS LAST, operator_id NULLS LAST) = 1
  OR operating_day IS NULL OR trip_id IS NULL OR station_code IS NULL"""
_FLAGGED = f"\nflagged AS (SELECT * FROM typed WHERE NOT is_pass_through {_FIRST_STOP})"
_STAGED = "\nstaged AS (SELECT * FROM flagged WHERE NOT is_cancelled)"
_DELAYS = f"""
delays AS (
  SELECT *, {_WHOLE_DELAY} AS arrival_delay_min FROM staged WHERE arrival_status IN ('REAL', 'ESTIMATED')
)"""
# Texts that a pandas CSV reader takes for missing, apart from the empty one.
_NA = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
_TOKENS = ", ".join(f"'{token}'" for token in _NA)
_BLANKED = "\nblanked AS (SELECT " + ", ".join(
    f"CASE WHEN {name} IN ({_TOKENS}) THEN NULL ELSE {name} END AS {name}" for name in RAW_COLUMNS
) + " FROM raw)"
_PROFILED = f"""
profiled AS (
  SELECT *, {_DELAY} AS delay_min, {_MEASURED} AS measured, {_CANCELLED} AS cancelled FROM raw
)"""

_PLANNED, _REAL = _stamp("ANKUNFTSZEIT"), _stamp("AN_PROGNOSE")
# The second delay formula: days apart, and seconds of the day apart.
_BY_PARTS = f"""round((date_diff('day', CAST({_PLANNED} AS DATE), CAST({_REAL} AS DATE)) * 86400
    + date_part('hour', {_REAL}) * 3600 + date_part('minute', {_REAL}) * 60 + date_part('second', {_REAL})
    - date_part('hour', {_PLANNED}) * 3600 - date_part('minute', {_PLANNED}) * 60 - date_part('second', {_PLANNED}))
    / 60e0, 3)"""

_PAGES = """
listing AS (
  SELECT page_id, html || '<a ' || CASE WHEN page_id % 7 = 0 THEN 'HREF' ELSE 'href' END || '="'
    || CASE WHEN page_id % 5 = 0 THEN 'https://h.example.org' ELSE '' END || '/dataset/' || page_id || '/download/'
    || strftime(DATE '2026-01-01' + CAST(page_id % 60 AS INTEGER), '%Y-%m-%d') || '_istdaten.csv">' AS html
  FROM pages
),
found AS (
  SELECT page_id, unnest(links) AS link, unnest(range(len(links))) AS pos
  FROM (SELECT page_id,
    regexp_extract_all(html, '(?i)href="([^"]*/download/\\d{4}-\\d{2}-\\d{2}_istdaten\\.csv)"', 1) AS links FROM listing)
),
dated AS (SELECT *, regexp_extract(link, '/download/(\\d{4}-\\d{2}-\\d{2})_istdaten', 1, 'i') AS day FROM found),
days AS (SELECT DISTINCT day FROM dated)"""

_HOST = "/".join(BASE_URL.split("/")[:3])
_FOLDER = BASE_URL.rsplit("/", 1)[0]
_INDEX = f"""
archive AS (
  SELECT day, CASE WHEN link LIKE 'http%' THEN link WHEN link LIKE '//%' THEN 'https:' || link
    WHEN link LIKE '/%' THEN '{_HOST}' || link ELSE '{_FOLDER}/' || link END AS url
  FROM dated QUALIFY row_number() OVER (PARTITION BY day ORDER BY page_id DESC, pos DESC) = 1
)"""

_RAW_STEPS = (_BASE, _RAW)
_TYPED_STEPS = (*_RAW_STEPS, _TYPED)
_FLAGGED_STEPS = (*_TYPED_STEPS, _FLAGGED)
_STAGED_STEPS = (*_FLAGGED_STEPS, _STAGED)
_DELAY_STEPS = (*_STAGED_STEPS, _DELAYS)


def _sql(steps: tuple[str, ...], body: str) -> str:
    return "WITH" + ",".join(steps) + "\n" + body.strip()


def _from_raw(body: str) -> str:
    return _sql(_RAW_STEPS, body)


def _from_blanked(body: str) -> str:
    return _sql((*_RAW_STEPS, _BLANKED), body)


def _from_profiled(body: str) -> str:
    return _sql((*_RAW_STEPS, _PROFILED), body)


def _distribution(column: str, limit: str = "") -> str:
    return _from_raw(f"""
SELECT COALESCE({column}, 'NULL') AS value, count(*) AS count,
  round(100e0 * count(*) / (SELECT greatest(count(*), 1) FROM raw), 3) AS share_pct
FROM raw GROUP BY 1 ORDER BY count DESC, value ASC {limit}""")


def _summary(condition: str) -> str:
    return _from_profiled(f"""
SELECT unnest(['count', 'mean', 'median', 'p95', 'min', 'max']) AS metric,
  unnest([n, round(mean, 3), round(median, 3), round(p95, 3), low, high]) AS value
FROM (SELECT CAST(count(delay_min) AS DOUBLE) AS n, avg(delay_min) AS mean, median(delay_min) AS median,
  quantile_cont(delay_min, 0.95) AS p95, min(delay_min) AS low, max(delay_min) AS high
  FROM profiled WHERE {condition})""")


def _long(pairs: dict[str, str], name: str, value: str, source: str) -> str:
    """One row per pair, all values read from one row of `source`."""
    names = ", ".join(f"'{key}'" for key in pairs)
    return (
        f"SELECT unnest([{names}]) AS {name}, unnest([{', '.join(f'v{i}' for i in range(len(pairs)))}]) AS {value} "
        f"FROM (SELECT {', '.join(f'{expr} AS v{i}' for i, expr in enumerate(pairs.values()))} FROM {source})"
    )


def _dtype(column: str) -> str:
    def all_match(pattern: str) -> str:
        return f"count(*) FILTER (WHERE {column} IS NOT NULL AND NOT regexp_full_match({column}, '{pattern}')) = 0"

    integer = r"\s*[+-]?\d+\s*"
    decimal = r"\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*"
    return (
        f"CASE WHEN count({column}) = 0 THEN 'string' WHEN {all_match(integer)} THEN 'bigint' "
        f"WHEN {all_match(decimal)} THEN 'double' WHEN {all_match('(?i:true|false)')} THEN 'boolean' ELSE 'string' END"
    )


def _null_rates() -> str:
    body = _long({name: f"count(*) - count({name})" for name in RAW_COLUMNS}, "column_name", "nulls", "raw")
    return _from_raw(f"""
SELECT column_name AS "column", CAST(nulls AS BIGINT) AS null_count,
  round(100e0 * nulls / (SELECT greatest(count(*), 1) FROM raw), 3) AS null_rate_pct
FROM ({body})""")


def _column_profile() -> str:
    types = _long({name: _dtype(name) for name in RAW_COLUMNS}, "name", "dtype", "raw")
    nulls = _long({name: f"count(*) - count({name})" for name in RAW_COLUMNS}, "name", "nulls", "raw")
    return _from_raw(f"""
SELECT name AS "column", dtype, (SELECT count(*) FROM raw) AS row_count, CAST(nulls AS BIGINT) AS null_count,
  round(100e0 * nulls / (SELECT greatest(count(*), 1) FROM raw), 3) AS null_rate_pct
FROM ({types}) JOIN ({nulls}) USING (name) ORDER BY name""")


def _build_checks() -> str:
    nulls = ("operating_day", "trip_id", "station_code", "scheduled_arrival_at")
    failures = {f"not_null_{name}": f"count(*) - count({name})" for name in nulls} | {
        "accepted_arrival_status": f"count(*) FILTER (WHERE arrival_status NOT IN {_TARGETS})",
        "within_arrival_delay": f"count(*) FILTER (WHERE {_IN_FACT} AND NOT ({_WHOLE_DELAY}) BETWEEN -60 AND 180)",
    }
    return _sql(
        _STAGED_STEPS,
        'SELECT "check", false AS strict, (SELECT count(*) FROM flagged) AS row_count, failures FROM ('
        + _long(failures, '"check"', "failures", "flagged")
        + ")",
    )


def _edge_preview() -> str:
    order = ", ".join(f"{name} ASC NULLS LAST" for name in RAW_COLUMNS)
    conditions = {
        "null_arrivals": "ANKUNFTSZEIT IS NULL",
        "non_delay_status": f"NOT {_MEASURED}",
        "cancelled": _CANCELLED,
    }
    return _from_raw(
        " UNION ALL ".join(
            f"(SELECT *, '{name}' AS slice FROM raw WHERE {condition} ORDER BY {order} LIMIT 10)"
            for name, condition in conditions.items()
        )
    )


_IN_FACT = "NOT is_cancelled AND arrival_status IN ('REAL', 'ESTIMATED')"


def _fact_values(average: str, median: str, largest: str = "") -> str:
    return f"""
  count(*) AS total_stop_events, avg(d) AS {average}, median(d) AS {median},
  round(100e0 * count(*) FILTER (WHERE d <= 0) / nullif(count(d), 0), 3) AS pct_on_time,
  round(100e0 * count(*) FILTER (WHERE d >= 3) / nullif(count(d), 0), 3) AS pct_delayed_3min,
  {largest} CAST(count(*) FILTER (WHERE is_cancelled) AS BIGINT) AS total_cancelled
FROM (SELECT *, CASE WHEN {_IN_FACT} THEN {_WHOLE_DELAY} END AS d FROM flagged)"""


_DAILY = f"""SELECT operating_day, transport_type, line_name, operator_id,
{_fact_values('avg_arrival_delay', 'median_delay', 'max(d) AS max_delay,')}
GROUP BY operating_day, transport_type, line_name, operator_id"""

_STATION = f"""SELECT operating_day, station_code, transport_type,
{_fact_values('avg_arrival_delay_min', 'median_arrival_delay')}
GROUP BY operating_day, station_code, transport_type"""


_CORRECTED = _TYPED.replace(
    " FROM raw)", f" FROM raw WHERE {_day('BETRIEBSTAG')} <> DATE '{RELOADED_DAY}' OR NOT {_CANCELLED})"
)

# A stop is in the same run as another late one of its trip when no other stop lies between them: then the numbers of stops
# and of late stops before them grow alike.
_CHAINS = f"""
measured AS (
  SELECT operating_day, trip_id, station_code, {_WHOLE_DELAY} AS arr,
    row_number() OVER (PARTITION BY operating_day, trip_id
      ORDER BY COALESCE(scheduled_departure_at, scheduled_arrival_at) NULLS LAST, station_code) AS place
  FROM flagged WHERE {_IN_FACT} AND {_WHOLE_DELAY} IS NOT NULL
    AND operating_day IS NOT NULL AND trip_id IS NOT NULL AND station_code IS NOT NULL
),
islands AS (
  SELECT *, place - row_number() OVER (PARTITION BY operating_day, trip_id ORDER BY place) AS island
  FROM measured WHERE arr >= 3
),
chains AS (
  SELECT operating_day, trip_id, row_number() OVER (PARTITION BY operating_day, trip_id ORDER BY min(place)) AS chain,
    min(place) AS place, arg_min(station_code, place) AS station_code, arg_min(arr, place) AS first_delay,
    count(*) AS n_stops, max(arr) AS max_delay
  FROM islands GROUP BY operating_day, trip_id, island
)"""


def _dimension(key: str, attributes: tuple[str, ...], extra: str = "") -> str:
    names = ", ".join((key, *attributes))
    order = ", ".join(f"{name} DESC NULLS LAST" for name in ("operating_day", *attributes))
    return f"""SELECT {names} {extra} FROM flagged WHERE {key} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


_DESCRIPTION = """, CASE transport_type WHEN 'IC' THEN 'InterCity' WHEN 'IR' THEN 'InterRegio'
  WHEN 'RE' THEN 'RegioExpress' WHEN 'R' THEN 'Regional train' WHEN 'S' THEN 'Suburban train'
  WHEN 'Bus' THEN 'Bus service' ELSE 'Other: ' || transport_type END AS description"""
_STATIONS = _dimension("station_code", ("station_name", "sloid"))
_OPERATORS = _dimension("operator_id", ("operator_abbr", "operator_name"))
_TYPES = _dimension("transport_type", ("product_id",), _DESCRIPTION)

_ON_TIME = """round(100e0 * count(*) FILTER (WHERE arrival_delay_min <= 0)
  / nullif(count(arrival_delay_min), 0), 3) AS pct_on_time"""
_LATE = """round(100e0 * count(*) FILTER (WHERE arrival_delay_min >= 3)
  / nullif(count(arrival_delay_min), 0), 3) AS pct_delayed_3min"""
_COUNT = "count(arrival_delay_min) AS measured_stops"
_AVERAGE = "avg(arrival_delay_min) AS avg_delay_min"

_SEASON = """CASE WHEN month(operating_day) IN (12, 1, 2) THEN 'winter' WHEN month(operating_day) IN (3, 4, 5)
  THEN 'spring' WHEN month(operating_day) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season"""

_HUBS = f"""
SELECT station_code, count(*) AS n_stops, avg(dep - arr) AS avg_added_min,
  CAST(count(*) FILTER (WHERE arr >= 3) AS BIGINT) AS n_late_in,
  round(100e0 * count(*) FILTER (WHERE arr >= 3 AND next_arr >= 3)
    / nullif(count(*) FILTER (WHERE arr >= 3 AND next_arr IS NOT NULL), 0), 3) AS pct_late_passed_on
FROM (
  SELECT *, lead(arr) OVER (PARTITION BY operating_day, trip_id
    ORDER BY COALESCE(scheduled_departure_at, scheduled_arrival_at), station_code NULLS LAST) AS next_arr
  FROM (SELECT *, {_WHOLE_DELAY} AS arr,
    datesub('minute', scheduled_departure_at, actual_departure_at) AS dep
    FROM flagged WHERE {_IN_FACT})
  WHERE arr IS NOT NULL)
GROUP BY station_code"""

_ALL_RAW = "SELECT * FROM raw"
_ALL_BLANKED = "SELECT * FROM blanked"
_ROW_KEY = "FAHRT_BEZEICHNER, BPUIC"
_TARGETS = "('REAL', 'ESTIMATED', 'FORECAST', 'UNKNOWN')"


_TILES = f"""
SELECT CASE grouping(transport_type, operating_day, hour, weekday, season)
    WHEN 15 THEN 'delay_by_type' WHEN 7 THEN 'on_time_trend' WHEN 25 THEN 'hour_weekday' WHEN 30 THEN 'season_profile' END AS tile,
  transport_type, operating_day, hour, weekday, season, {_COUNT}, {_AVERAGE}, {_ON_TIME}, {_LATE}
FROM (SELECT *, CAST(hour(scheduled_arrival_at) AS INTEGER) AS hour,
  CAST(isodow(operating_day) - 1 AS INTEGER) AS weekday, {_SEASON} FROM delays)
GROUP BY GROUPING SETS ((transport_type), (operating_day, transport_type), (hour, weekday), (season))"""


def oracle_sql() -> dict[str, str]:
    day = _day("BETRIEBSTAG")
    outside = "(delay_min < -60 OR delay_min > 180)"
    outlier_order = ", ".join(f"{name} ASC NULLS LAST" for name in ("delay_min", *RAW_COLUMNS))
    with_delay = "SELECT * EXCLUDE (measured, cancelled) FROM profiled"
    ready = "measured AND NOT cancelled AND delay_min IS NOT NULL"
    types = ", ".join(f"'{name}'" for name in CHOSEN_TYPES)
    typed_delay = f"SELECT trip_id, station_code, {_WHOLE_DELAY} AS arrival_delay_min FROM typed"
    return {
        "scan_csv": _from_blanked(_ALL_BLANKED),
        "scan_parquet": _from_raw(_ALL_RAW),
        "read_stop_events": _from_blanked(
            "SELECT * FROM blanked WHERE BETRIEBSTAG LIKE '%-%' "
            "UNION ALL SELECT * FROM raw WHERE BETRIEBSTAG NOT LIKE '%-%'"
        ),
        "scan_latest": _from_blanked(
            f"SELECT * FROM blanked WHERE {day} = (SELECT max({day}) FROM raw)"
        ),
        "require_columns": _from_raw(_ALL_RAW),
        "require_rows": _from_raw(_ALL_RAW),
        "csv_to_parquet": _from_blanked(_ALL_BLANKED),
        "lake_layout": _from_raw(
            f"SELECT *, CAST(year({day}) AS INTEGER) AS year, CAST(month({day}) AS INTEGER) AS month, "
            f"CAST(day({day}) AS INTEGER) AS day FROM raw "
            "UNION ALL SELECT * REPLACE ('?' AS BETRIEBSTAG), NULL, NULL, NULL FROM raw "
            "WHERE FAHRT_BEZEICHNER LIKE '%17' OR FAHRT_BEZEICHNER LIKE '%3'"
        ),
        "create_day_table": _from_raw(f"SELECT *, {day} AS betriebstag_date FROM raw"),
        "replace_day": _from_raw(
            f"SELECT *, {day} AS betriebstag_date FROM raw "
            f"WHERE {day} <> DATE '{RELOADED_DAY}' OR NOT {_CANCELLED}"
        ),
        "add_missing_column": _from_raw(
            f"SELECT *, CASE WHEN BETRIEBSTAG NOT LIKE '%-%' THEN {day} END AS betriebstag_date FROM raw"
        ),
        "load_check": _from_raw(
            f"SELECT {day} AS betriebstag_date, count(*) AS row_count FROM raw GROUP BY 1 ORDER BY 1 DESC LIMIT 10"
        ),
        "archive_index": _sql((_PAGES, _INDEX), "SELECT * FROM archive"),
        "archive_latest_n": _sql((_PAGES, _INDEX), "SELECT * FROM archive ORDER BY day DESC LIMIT 5"),
        "available_days": _sql((_PAGES,), "SELECT day FROM days ORDER BY day"),
        "target_days": _sql(
            (_PAGES,), "SELECT day FROM days WHERE day <= '2026-02-10' ORDER BY day DESC LIMIT 7"
        ),
        "pending_days": _sql(
            (_PAGES,),
            "SELECT day FROM days WHERE day NOT IN (SELECT strftime(DATE '2026-01-01' "
            "+ CAST(page_id % 60 AS INTEGER), '%Y-%m-%d') FROM pages WHERE page_id % 3 = 0)",
        ),
        "parse_timestamp": _from_raw(
            f"SELECT {_ROW_KEY}, {_stamp('ANKUNFTSZEIT')} AS ankunftszeit, {_stamp('AN_PROGNOSE')} AS an_prognose, "
            f"{_stamp('ABFAHRTSZEIT')} AS abfahrtszeit, {_stamp('AB_PROGNOSE')} AS ab_prognose FROM raw"
        ),
        "parse_operating_day": _from_raw(f"SELECT {_ROW_KEY}, {day} AS operating_day FROM raw"),
        "normalize_status": _from_raw(f"SELECT {_ROW_KEY}, {_STATUS} AS status FROM raw"),
        "normalize_flag": _from_raw(f"SELECT {_ROW_KEY}, {_CANCELLED} AS is_cancelled FROM raw"),
        "delay_minutes": _from_raw(f"SELECT {_ROW_KEY}, {_DELAY} AS delay_min FROM raw"),
        "null_label": _from_raw(f"SELECT {_ROW_KEY}, COALESCE(AN_PROGNOSE_STATUS, 'NULL') AS label FROM raw"),
        "whole_minute_delay": _sql(_TYPED_STEPS, typed_delay),
        "delay_flags": _sql(
            _TYPED_STEPS,
            "SELECT *, arrival_delay_min > 0 AS is_delayed, arrival_delay_min >= 3 AS is_significantly_delayed "
            f"FROM ({typed_delay})",
        ),
        "calendar_parts": _sql(
            _TYPED_STEPS,
            "SELECT trip_id, station_code, CAST(hour(scheduled_arrival_at) AS INTEGER) AS arrival_hour, "
            f"CAST(isodow(operating_day) - 1 AS INTEGER) AS weekday, {_SEASON} FROM typed",
        ),
        "rename_snake_case": _from_raw(
            "SELECT " + ", ".join(f"{name} AS {new}" for name, new in STAGING_NAMES.items()) + " FROM raw"
        ),
        "filter_delay_status": _from_raw(f"SELECT * FROM raw WHERE {_MEASURED}"),
        "filter_computable": _from_raw(
            f"SELECT * FROM raw WHERE {_MEASURED} AND NOT {_CANCELLED} "
            f"AND {_stamp('ANKUNFTSZEIT')} IS NOT NULL AND {_stamp('AN_PROGNOSE')} IS NOT NULL"
        ),
        "edge_null_arrivals": _from_raw("SELECT * FROM raw WHERE ANKUNFTSZEIT IS NULL"),
        "edge_non_delay_status": _from_raw(f"SELECT * FROM raw WHERE NOT {_MEASURED}"),
        "edge_cancelled": _from_raw(f"SELECT * FROM raw WHERE {_CANCELLED}"),
        "edge_preview": _edge_preview(),
        "delay_outliers": _from_profiled(f"{with_delay} WHERE {outside}"),
        "delay_outliers_preview": _from_profiled(f"{with_delay} WHERE {outside} ORDER BY {outlier_order} LIMIT 20"),
        "delay_range": _from_profiled(
            f"SELECT {_ROW_KEY}, delay_min FROM profiled WHERE {ready} AND delay_min BETWEEN -20 AND 60"
        ),
        "exclude_pass_through": _from_raw(f"SELECT * FROM raw WHERE NOT {_flag('DURCHFAHRT_TF')}"),
        "slice_dates_types": _sql(
            _FLAGGED_STEPS,
            f"SELECT * FROM ({_DAILY}) WHERE operating_day BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' "
            f"AND transport_type IN ({types})",
        ),
        "profile_overview": _from_raw(
            f"SELECT count(*) AS row_count, CAST({len(RAW_COLUMNS)} AS BIGINT) AS column_count FROM raw"
        ),
        "column_types": _from_raw(_long({name: _dtype(name) for name in RAW_COLUMNS}, '"column"', "dtype", "raw")),
        "null_rates": _null_rates(),
        "column_profile": _column_profile(),
        "value_distribution": _distribution("VERKEHRSMITTEL_TEXT"),
        "top_values": _distribution("HALTESTELLEN_NAME", "LIMIT 12"),
        "delay_summary": _summary("TRUE"),
        "delay_summary_filtered": _summary(ready),
        "kpi_table": _from_profiled(
            _long(
                {
                    "rows_total": "count(*)",
                    "columns_total": f"CAST({len(RAW_COLUMNS)} AS BIGINT)",
                    "rows_real_or_estimated": "count(*) FILTER (WHERE measured)",
                    "rows_cancelled": "count(*) FILTER (WHERE cancelled)",
                    "rows_with_computable_arrival_delay": f"count(*) FILTER (WHERE {ready})",
                    "rows_null_ankunftszeit": "count(*) FILTER (WHERE ANKUNFTSZEIT IS NULL)",
                    "rows_non_delay_status": "count(*) FILTER (WHERE NOT measured)",
                },
                "metric",
                "value",
                "profiled",
            )
        ),
        "formula_validation": _from_profiled(
            _long(
                {
                    "formula_match_max_abs_diff_min": f"coalesce(max(abs(delay_min - {_BY_PARTS})) FILTER (WHERE measured AND NOT cancelled), 0e0)",
                    "validated_rows": f"CAST(count(*) FILTER (WHERE {ready}) AS DOUBLE)",
                },
                '"check"',
                "value",
                "profiled",
            )
        ),
        "delay_histogram": _from_profiled(
            f"SELECT CAST(floor(delay_min / 2) * 2 AS BIGINT) AS bin_start, count(*) AS count FROM profiled "
            f"WHERE {ready} AND delay_min BETWEEN -20 AND 60 GROUP BY 1"
        ),
        "range_coverage": _from_profiled(
            "SELECT count(*) FILTER (WHERE delay_min BETWEEN -20 AND 60) AS rows_in_range, "
            f"count(*) AS rows_total FROM profiled WHERE {ready}"
        ),
        "executive_summary": _from_profiled(f"""
SELECT count(*) AS rows_total, count(*) FILTER (WHERE {ready}) AS delay_ready_rows,
  count(*) FILTER (WHERE cancelled) AS cancelled_rows,
  count(*) FILTER (WHERE NOT measured) AS non_delay_status_rows,
  round(avg(delay_min), 3) AS mean_delay, round(quantile_cont(delay_min, 0.95), 3) AS p95_delay,
  coalesce(max(abs(delay_min - {_BY_PARTS})) FILTER (WHERE measured AND NOT cancelled), 0e0) AS formula_max_abs_diff_min,
  any_value(t.value) AS top_transport_type,
  round(100e0 * any_value(t.n) / greatest(count(*), 1), 3) AS top_transport_share_pct
FROM profiled, (SELECT COALESCE(VERKEHRSMITTEL_TEXT, 'NULL') AS value, count(*) AS n FROM raw
  GROUP BY 1 ORDER BY n DESC, value LIMIT 1) AS t"""),
        "status_breakdown": _distribution("AN_PROGNOSE_STATUS"),
        "stg_stop_events": _sql(_STAGED_STEPS, "SELECT * FROM staged"),
        "dedup_stops": _sql(_TYPED_STEPS, f"SELECT * FROM typed {_FIRST_STOP}"),
        "int_delays": _sql(
            _DELAY_STEPS,
            "SELECT operating_day, trip_id, station_code, transport_type, arrival_status, arrival_delay_min, "
            "arrival_delay_min > 0 AS is_delayed, arrival_delay_min >= 3 AS is_significantly_delayed FROM delays",
        ),
        "fct_daily_delays": _sql(_FLAGGED_STEPS, _DAILY),
        "fct_station_delays": _sql(_FLAGGED_STEPS, _STATION),
        "dim_stations": _sql(_FLAGGED_STEPS, _STATIONS),
        "dim_operators": _sql(_FLAGGED_STEPS, _OPERATORS),
        "dim_transport_types": _sql(_FLAGGED_STEPS, _TYPES),
        "star_join": _sql(
            _STAGED_STEPS,
            f"SELECT * FROM ({_STATION}) LEFT JOIN ({_STATIONS}) USING (station_code) "
            f"LEFT JOIN ({_TYPES}) USING (transport_type)",
        ),
        "star_join_daily": _sql(
            _STAGED_STEPS,
            f"SELECT * FROM ({_DAILY}) LEFT JOIN ({_OPERATORS}) USING (operator_id) "
            f"LEFT JOIN ({_TYPES}) USING (transport_type)",
        ),
        "test_delay_reasonable": _sql(
            _DELAY_STEPS,
            "SELECT operating_day, trip_id, station_code, transport_type, arrival_status, arrival_delay_min, "
            "arrival_delay_min > 0 AS is_delayed, arrival_delay_min >= 3 AS is_significantly_delayed FROM delays "
            "WHERE NOT arrival_delay_min BETWEEN -60 AND 180",
        ),
        "build_checks": _build_checks(),
        "test_not_null": _sql(
            _STAGED_STEPS,
            _long(
                {
                    name: f"count(*) - count({name})"
                    for name in ("operating_day", "trip_id", "station_code", "scheduled_arrival_at")
                },
                '"column"',
                "failures",
                "staged",
            ),
        ),
        "test_unique": _sql(
            _TYPED_STEPS,
            "SELECT operating_day, trip_id, station_code, count(*) AS occurrences FROM typed "
            "GROUP BY ALL HAVING count(*) > 1",
        ),
        "test_accepted_values": _sql(
            _TYPED_STEPS,
            f"SELECT arrival_status AS value, count(*) AS occurrences FROM typed "
            f"WHERE arrival_status NOT IN {_TARGETS} GROUP BY 1",
        ),
        "tile_delay_by_type": _sql(
            _DELAY_STEPS, f"SELECT transport_type, {_AVERAGE}, {_COUNT} FROM delays GROUP BY 1"
        ),
        "tile_on_time_trend": _sql(
            _DELAY_STEPS, f"SELECT operating_day, transport_type, {_ON_TIME}, {_COUNT} FROM delays GROUP BY 1, 2"
        ),
        "tile_hour_weekday": _sql(
            _DELAY_STEPS,
            f"SELECT CAST(hour(scheduled_arrival_at) AS INTEGER) AS hour, "
            f"CAST(isodow(operating_day) - 1 AS INTEGER) AS weekday, {_AVERAGE}, {_COUNT} FROM delays GROUP BY 1, 2",
        ),
        "worst_lines": _sql(
            _DELAY_STEPS,
            f"SELECT line_name, {_COUNT}, {_AVERAGE} FROM delays GROUP BY 1 HAVING measured_stops >= 30 "
            "ORDER BY avg_delay_min DESC, line_name LIMIT 10",
        ),
        "worst_stations": _sql(
            _DELAY_STEPS,
            f"SELECT station_name, station_code, {_COUNT}, {_AVERAGE} FROM delays GROUP BY 1, 2 "
            "HAVING measured_stops >= 30 ORDER BY avg_delay_min DESC, station_name, station_code LIMIT 10",
        ),
        "season_profile": _sql(
            _DELAY_STEPS, f"SELECT {_SEASON}, {_COUNT}, {_AVERAGE}, {_ON_TIME}, {_LATE} FROM delays GROUP BY 1"
        ),
        "commuter_vs_intercity": _sql(
            _DELAY_STEPS,
            f"SELECT transport_type, {_COUNT}, {_AVERAGE}, {_ON_TIME}, {_LATE} FROM delays "
            "WHERE transport_type IN ('S', 'IC') GROUP BY 1",
        ),
        "hub_propagation": _sql(_FLAGGED_STEPS, _HUBS),
        "cancellation_rate": _sql(
            _FLAGGED_STEPS,
            "SELECT transport_type, count(*) AS total_stop_events, "
            "count(*) FILTER (WHERE is_cancelled) AS total_cancelled, "
            "round(100e0 * count(*) FILTER (WHERE is_cancelled) / count(*), 3) AS pct_cancelled "
            "FROM flagged GROUP BY 1",
        ),
        "unknown_status_count": _sql(
            _FLAGGED_STEPS,
            "SELECT transport_type, count(*) FILTER (WHERE arrival_status = 'UNKNOWN') AS unknown_stops, "
            "count(*) AS total_stop_events FROM flagged GROUP BY 1",
        ),
        "incremental_ingest": _from_blanked(f"SELECT *, {day} AS betriebstag_date FROM blanked"),
        "ingest_corrected": _from_blanked(
            f"SELECT *, {day} AS betriebstag_date FROM blanked "
            f"WHERE {day} <> DATE '{RELOADED_DAY}' OR NOT {_CANCELLED}"
        ),
        "refresh_daily_fact": _sql((*_RAW_STEPS, _CORRECTED, _FLAGGED), _DAILY),
        "refresh_stations": _sql((*_RAW_STEPS, _CORRECTED, _FLAGGED), _STATIONS),
        "monthly_line_delays": _sql(
            _FLAGGED_STEPS,
            "SELECT CAST(date_trunc('month', operating_day) AS DATE) AS month, transport_type, line_name, "
            f"quantile_cont(d, 0.95) AS p95_delay, {_fact_values('avg_delay', 'median_delay', 'max(d) AS max_delay,')} "
            "GROUP BY 1, 2, 3",
        ),
        "state_histogram": _sql(
            _FLAGGED_STEPS,
            f"SELECT transport_type, CAST(floor({_WHOLE_DELAY} / 5e0) * 5 AS BIGINT) AS bin_start, count(*) AS count "
            f"FROM flagged WHERE {_IN_FACT} AND {_WHOLE_DELAY} IS NOT NULL GROUP BY 1, 2",
        ),
        "insight_tiles": _sql(_DELAY_STEPS, _TILES),
        "delay_chains": _sql((*_FLAGGED_STEPS, _CHAINS), "SELECT * EXCLUDE (place) FROM chains"),
        "chain_origins": _sql(
            (*_FLAGGED_STEPS, _CHAINS),
            "SELECT station_code, count(*) AS n_chains, CAST(sum(n_stops) AS BIGINT) AS late_stops, "
            "avg(n_stops) AS avg_length, max(n_stops) AS max_length, avg(first_delay) AS avg_first_delay "
            "FROM chains GROUP BY 1",
        ),
    }
