"""Independent SQL statement of every registered query (DuckDB dialect).

Written from the rules, not from the Spark plans: the fixture formulas, R1 through
DuckDB's ``timezone(zone, local_timestamp)`` (which picks the later instant in a
repeated hour), R2 as a CASE, and each question as plain SQL over views ``orders``,
``nation``, ``lineitem``. Flight ids are order keys (unique), so the stored flights
table needs no deduplication here.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from tarmac.plans import insights
from tarmac.operators.quality import CHECKS
from tarmac.plans.registry import REPEAT_STEP, REPEATS, UPSERT_INSERTED_PRIORITY, UPSERT_UPDATED_PRIORITY
from tarmac.plans.replace import SOURCE_CODE, TARGET_CODE
from tarmac.sources.fixtures import (
    AIRPORT_CODES, AIRPORT_OFFSETS, AIRPORT_ZONES, BASE_DATE, CARRIER_CODES,
    CLOCK_CHANGE_FALL, CLOCK_CHANGE_SPRING, N_AIRPORTS, NO_DST_ZONES, NULL_IATA_INDEX,
)


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))
                           for v in values) + "]"


def _ms(day: str, seconds: int = 0) -> int:
    d = date.fromisoformat(day)
    t = datetime(d.year, d.month, d.day, tzinfo=timezone.utc) + timedelta(seconds=seconds)
    return int(t.timestamp() * 1000)


CODES, ZONES, OFFS, CARRIERS = (_list(AIRPORT_CODES), _list(AIRPORT_ZONES),
                                _list(AIRPORT_OFFSETS), _list(CARRIER_CODES))


def _utc(t: str, z: str) -> str:
    p = f"lpad({t}, 4, '0')"
    return (f"CASE WHEN fl_date IS NULL OR {t} IS NULL OR {z} IS NULL THEN CAST(0 AS BIGINT) "
            f"ELSE epoch_ms(timezone({z}, CAST(fl_date AS TIMESTAMP) + to_minutes("
            f"CAST(substr({p}, 1, 2) AS INTEGER) * 60 + CAST(substr({p}, 3, 2) AS INTEGER)))) END")


AIRPORTS_CTE = f"""
airports_src AS (
  SELECT CAST(3400 + n_nationkey AS INTEGER) AS airport_id,
         n_name || ' Airport' AS airport_name,
         'City ' || {CODES}[n_nationkey + 1] AS city,
         'United States' AS country,
         CASE WHEN n_nationkey = {NULL_IATA_INDEX} THEN NULL ELSE {CODES}[n_nationkey + 1] END AS iata,
         'K' || {CODES}[n_nationkey + 1] AS icao,
         CAST(20.0 + n_nationkey AS DOUBLE) AS latitude,
         CAST(-160.0 + 3 * n_nationkey AS DOUBLE) AS longitude,
         CAST(10 * n_nationkey AS INTEGER) AS altitude,
         CAST(trunc({OFFS}[n_nationkey + 1] / 60) AS INTEGER) AS timezone_offset,
         CASE WHEN {ZONES}[n_nationkey + 1] IN {tuple(NO_DST_ZONES)} THEN 'N' ELSE 'A' END AS dst,
         {ZONES}[n_nationkey + 1] AS timezone_code,
         'airport' AS type
  FROM nation),
lookup AS (
  SELECT iata,
         CASE WHEN timezone_code IS NULL
                OR timezone_code IN (SELECT name FROM pg_timezone_names())
                OR regexp_matches(timezone_code, '^[+-][0-9]{{2}}:[0-9]{{2}}$')
              THEN timezone_code ELSE 'UTC' END AS tz
  FROM airports_src WHERE iata IS NOT NULL)"""

RAW_CTE = f"""
fx AS (
  SELECT o_orderkey AS k, o_custkey AS c,
         CAST(o_custkey % {N_AIRPORTS} AS INTEGER) AS oi,
         CAST((o_custkey + 1 + o_orderkey % 24) % {N_AIRPORTS} AS INTEGER) AS di,
         CASE WHEN o_orderkey % 40 = 0 THEN DATE '{CLOCK_CHANGE_SPRING}'
              WHEN o_orderkey % 40 = 1 THEN DATE '{CLOCK_CHANGE_FALL}'
              ELSE DATE '{BASE_DATE}' + CAST(o_orderkey % 60 AS INTEGER) END AS fl_date,
         (37 * o_orderkey + 11 * o_custkey) % 1440 AS m,
         CAST(60 + (7 * o_orderkey) % 300 AS INTEGER) AS el,
         CASE WHEN o_orderkey % 10 = 8 THEN 60 WHEN o_orderkey % 10 = 9 THEN -60 ELSE 0 END AS j
  FROM orders),
fx2 AS (
  SELECT *, (((m + el + {OFFS}[di + 1] - {OFFS}[oi + 1] + j) % 1440) + 1440) % 1440 AS am FROM fx),
flights_raw AS (
  SELECT CAST(k AS BIGINT) AS id,
         CAST(year(fl_date) AS INTEGER) AS year,
         CAST(day(fl_date) + CASE WHEN k % 97 = 0 THEN 1 ELSE 0 END AS INTEGER) AS day_of_month,
         fl_date,
         CAST(19000 + c % 20 AS INTEGER) AS airline_id,
         {CARRIERS}[CAST(c % 5 AS INTEGER) + 1] AS carrier,
         CAST(1 + c % 900 AS INTEGER) AS fl_num,
         CAST(10000 + oi AS INTEGER) AS origin_airport_id,
         {CODES}[oi + 1] AS origin,
         'City ' || {CODES}[oi + 1] AS origin_city_name,
         substr({CODES}[oi + 1], 1, 2) AS origin_state_abr,
         {CODES}[di + 1] AS dest,
         'City ' || {CODES}[di + 1] AS dest_city_name,
         substr({CODES}[di + 1], 1, 2) AS dest_state_abr,
         CASE WHEN k % 53 = 0 THEN NULL WHEN m = 0 THEN '2400'
              ELSE CAST((m // 60) * 100 + m % 60 AS VARCHAR) END AS dep_time,
         CASE WHEN k % 59 = 0 THEN NULL
              ELSE CAST((am // 60) * 100 + am % 60 AS VARCHAR) END AS arr_time,
         el AS actual_elapsed_time,
         CAST(CASE WHEN k % 31 = 0 THEN el WHEN k % 101 = 0 THEN el + 5
                   ELSE el - 10 - k % 20 END AS INTEGER) AS air_time,
         CAST(100 + (13 * k) % 2500 AS INTEGER) AS distance
  FROM fx2)"""

RAW_COLUMNS = ("id, year, day_of_month, fl_date, airline_id, carrier, fl_num, origin_airport_id, "
               "origin, origin_city_name, origin_state_abr, dest, dest_city_name, dest_state_abr, "
               "dep_time, arr_time, actual_elapsed_time, air_time, distance")


def _enriched_cte(join: str) -> str:
    return f"""
zoned AS (
  SELECT r.*, lo.tz AS origin_timezone_code, ld.tz AS dest_timezone_code
  FROM flights_raw r {join} JOIN lookup lo ON r.origin = lo.iata
                     {join} JOIN lookup ld ON r.dest = ld.iata),
timed AS (
  SELECT {RAW_COLUMNS}, origin_timezone_code,
         {_utc('dep_time', 'origin_timezone_code')} AS dep_time_utc_ms,
         dest_timezone_code,
         {_utc('arr_time', 'dest_timezone_code')} AS arr_time_utc_ms_tmp
  FROM zoned),
enriched AS (
  SELECT *,
         CASE WHEN origin_timezone_code IS NOT DISTINCT FROM 'Pacific/Guam'
                   AND dest_timezone_code IS NOT DISTINCT FROM 'Pacific/Honolulu'
              THEN CASE WHEN coalesce(TRY_CAST(dep_time AS INTEGER) > 1600
                                      AND TRY_CAST(arr_time AS INTEGER) < 600, false)
                        THEN arr_time_utc_ms_tmp ELSE arr_time_utc_ms_tmp - 86400000 END
              WHEN arr_time_utc_ms_tmp < dep_time_utc_ms THEN arr_time_utc_ms_tmp + 86400000
              ELSE arr_time_utc_ms_tmp END AS arr_time_utc_ms
  FROM timed)"""


FLIGHTS_CTE = """
flights_t AS (
  SELECT id, year, day_of_month, fl_date, airline_id, carrier, fl_num, origin_airport_id,
         origin, origin_city_name, origin_state_abr, dest, dest_city_name, dest_state_abr,
         dep_time_utc_ms AS dep_time, arr_time_utc_ms AS arr_time,
         actual_elapsed_time, air_time, distance
  FROM enriched),
departures_t AS (
  SELECT origin, dep_time, id, airline_id, carrier, fl_num, origin_city_name, origin_state_abr,
         dest, dest_city_name, dest_state_abr, distance
  FROM flights_t WHERE origin IS NOT NULL AND dep_time IS NOT NULL AND id IS NOT NULL),
airtime_t AS (
  SELECT fl_num, CAST(ceil(air_time / 10.0) * 10 AS INTEGER) AS air_time_bucket, id, carrier,
         origin, origin_city_name, dest, dest_city_name
  FROM flights_t WHERE fl_num IS NOT NULL AND air_time IS NOT NULL AND id IS NOT NULL),
delays AS (
  SELECT id, origin, dest, dep_time, arr_time, actual_elapsed_time, air_time,
         (arr_time // 1000 - dep_time // 1000) / 60 - actual_elapsed_time AS delay
  FROM flights_t WHERE actual_elapsed_time <> air_time)"""


def with_flights(body: str, join: str = "LEFT") -> str:
    return ("WITH " + AIRPORTS_CTE.strip() + ",\n" + RAW_CTE.strip() + ",\n"
            + _enriched_cte(join).strip() + ",\n" + FLIGHTS_CTE.strip() + "\n" + body)


ENRICHED_COLUMNS = (RAW_COLUMNS + ", origin_timezone_code, dep_time_utc_ms, dest_timezone_code, "
                    "arr_time_utc_ms_tmp, arr_time_utc_ms")
AUDIT = ("id, fl_date, day_of_month, origin, dest, dep_time, arr_time, origin_timezone_code, "
         "dest_timezone_code, dep_time_utc_ms, arr_time_utc_ms_tmp, arr_time_utc_ms, "
         "actual_elapsed_time, air_time")

Q1_LO, Q1_HI = _ms(insights.Q1_DAY), _ms(insights.Q1_DAY, 86400)
Q3_LO, Q3_HI = _ms(insights.Q3_DAY), _ms(insights.Q3_DAY, 86399)
SRC, TGT = SOURCE_CODE, TARGET_CODE


def _top_routes(valid: bool, limit: str = f"LIMIT {insights.TOP_ROUTES}") -> str:
    cond = ("WHERE dep_time <> 0 AND arr_time NOT IN (0, 86400000, -86400000)" if valid else "")
    return with_flights(f"""
SELECT origin || '-' || dest AS route, count(delay) AS trip_count
FROM (SELECT origin, dest, (arr_time // 1000 - dep_time // 1000) / 60 - actual_elapsed_time AS delay
      FROM (SELECT * FROM flights_t {cond}) v WHERE actual_elapsed_time <> air_time) d
WHERE delay > 0
GROUP BY 1 ORDER BY trip_count DESC, route ASC NULLS FIRST {limit}""")


def _ground(corrected: bool) -> str:
    late = "delay > 0" if corrected else "delay < 0"
    return with_flights(f"""
SELECT delayed_mean, ontime_mean,
       CASE WHEN delayed_mean <= ontime_mean THEN '{insights.VERDICT_NOT_A_REASON}'
            WHEN delayed_mean > ontime_mean THEN '{insights.VERDICT_A_REASON}' END AS verdict
FROM (SELECT avg(CASE WHEN {late} THEN actual_elapsed_time - air_time END) AS delayed_mean,
             avg(CASE WHEN delay = 0 THEN actual_elapsed_time - air_time END) AS ontime_mean
      FROM delays) s""")


REPLACE_CTE = f""",
flights_r AS (
  SELECT * REPLACE (CASE WHEN origin = '{SRC}' THEN '{TGT}' ELSE origin END AS origin,
                    CASE WHEN dest = '{SRC}' THEN '{TGT}' ELSE dest END AS dest)
  FROM flights_t),
airtime_r AS (
  SELECT * REPLACE (CASE WHEN origin = '{SRC}' THEN '{TGT}' ELSE origin END AS origin,
                    CASE WHEN dest = '{SRC}' THEN '{TGT}' ELSE dest END AS dest)
  FROM airtime_t),
moved AS (SELECT * REPLACE ('{TGT}' AS origin) FROM departures_t WHERE origin = '{SRC}'),
departures_1 AS (
  SELECT * FROM departures_t
  WHERE origin IS DISTINCT FROM '{SRC}' AND origin IS DISTINCT FROM '{TGT}'
  UNION ALL
  SELECT e.* FROM departures_t e
  WHERE e.origin = '{TGT}'
    AND NOT EXISTS (SELECT 1 FROM moved m WHERE m.dep_time = e.dep_time AND m.id = e.id)
  UNION ALL
  SELECT * FROM moved),
departures_r AS (
  SELECT * REPLACE (CASE WHEN dest = '{SRC}' THEN '{TGT}' ELSE dest END AS dest)
  FROM departures_1)"""


def _counts(f: str, a: str, d0: str, d1: str, prefix: str = "") -> str:
    return with_flights(prefix.rstrip() + (REPLACE_CTE if not prefix else "") + f"""
SELECT CAST(1 AS INTEGER) AS step, 'flights' AS table_name, 'origin' AS column_name,
       count(CASE WHEN origin = '{SRC}' THEN 1 END) AS matched_rows FROM {f}
UNION ALL SELECT 2, 'flights', 'dest', count(CASE WHEN dest = '{SRC}' THEN 1 END) FROM {f}
UNION ALL SELECT 3, 'flights_airtime', 'origin', count(CASE WHEN origin = '{SRC}' THEN 1 END) FROM {a}
UNION ALL SELECT 4, 'flights_airtime', 'dest', count(CASE WHEN dest = '{SRC}' THEN 1 END) FROM {a}
UNION ALL SELECT 5, 'airport_departures', 'origin', count(CASE WHEN origin = '{SRC}' THEN 1 END) FROM {d0}
UNION ALL SELECT 6, 'airport_departures', 'dest', count(CASE WHEN dest = '{SRC}' THEN 1 END) FROM {d1}""")


# After one full replacement no row matches; the second run's step-6 input is the
# replaced departures moved again (a no-op), so every count reads the replaced tables.
_RERUN = _counts("flights_r", "airtime_r", "departures_r", "departures_r", prefix=REPLACE_CTE)

UPSERT = f"""
WITH delta AS (
  SELECT o_orderkey, 'X' AS o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice, true AS hit
  FROM orders WHERE o_orderpriority = '{UPSERT_UPDATED_PRIORITY}'
  UNION ALL
  SELECT -o_orderkey - 1, 'N', o_totalprice, true
  FROM orders WHERE o_orderpriority = '{UPSERT_INSERTED_PRIORITY}')
SELECT coalesce(b.o_orderkey, d.o_orderkey) AS o_orderkey, b.o_custkey,
       CASE WHEN d.hit THEN d.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
       CASE WHEN d.hit THEN d.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
       b.o_orderdate, b.o_orderpriority
FROM orders b FULL OUTER JOIN delta d ON b.o_orderkey = d.o_orderkey"""

_TZ_TAIL = "substr(CAST(timezone_offset AS VARCHAR), 2)"
_TZ_LEFT = f"CASE WHEN length({_TZ_TAIL}) >= 2 THEN {_TZ_TAIL} ELSE lpad({_TZ_TAIL}, 2, '0') END"

ORACLE: dict[str, str] = {
    "enrich_utc": with_flights(f"SELECT {ENRICHED_COLUMNS} FROM enriched"),
    "enrich_inner": with_flights(f"SELECT {ENRICHED_COLUMNS} FROM enriched", join="INNER"),
    "unmatched_airports": with_flights("""
SELECT id, 'origin' AS side, origin AS code FROM flights_raw r
WHERE NOT EXISTS (SELECT 1 FROM lookup l WHERE l.iata = r.origin AND l.tz IS NOT NULL)
UNION ALL
SELECT id, 'dest', dest FROM flights_raw r
WHERE NOT EXISTS (SELECT 1 FROM lookup l WHERE l.iata = r.dest AND l.tz IS NOT NULL)"""),
    "flights_table": with_flights("SELECT * FROM flights_t"),
    "airport_departures": with_flights("SELECT * FROM departures_t"),
    "flights_airtime": with_flights("SELECT * FROM airtime_t"),
    "rejected_key_rows": with_flights("""
SELECT id, 'airport_departures' AS table_name FROM flights_t
WHERE origin IS NULL OR dep_time IS NULL OR id IS NULL
UNION ALL
SELECT id, 'flights_airtime' FROM flights_t
WHERE fl_num IS NULL OR air_time IS NULL OR id IS NULL"""),
    "q01_departures_on_day": with_flights(f"""
SELECT count(*) AS flights FROM departures_t
WHERE origin = '{insights.Q1_ORIGIN}' AND dep_time >= {Q1_LO} AND dep_time < {Q1_HI}"""),
    "q02_codes_with_prefix": with_flights(f"""
SELECT count(DISTINCT origin) AS airport_codes FROM departures_t
WHERE starts_with(origin, '{insights.Q2_PREFIX}')"""),
    "q03_busiest_origin": with_flights(f"""
SELECT origin, count(id) AS flights_count FROM departures_t
WHERE dep_time BETWEEN {Q3_LO} AND {Q3_HI}
GROUP BY origin ORDER BY flights_count DESC, origin ASC NULLS FIRST LIMIT 1"""),
    "q03_sql": with_flights(f"""
SELECT origin, count(id) AS flights_count FROM departures_t
WHERE dep_time BETWEEN {Q3_LO} AND {Q3_HI}
GROUP BY origin ORDER BY flights_count DESC, origin ASC NULLS FIRST LIMIT 1"""),
    "q03_origin_counts": with_flights(f"""
SELECT origin, count(id) AS flights_count FROM departures_t
WHERE dep_time BETWEEN {Q3_LO} AND {Q3_HI} GROUP BY origin"""),
    "q04_replace_flights": with_flights(REPLACE_CTE + "\nSELECT * FROM flights_r"),
    "q04_replace_airtime": with_flights(REPLACE_CTE + "\nSELECT * FROM airtime_r"),
    "q04_replace_departures": with_flights(REPLACE_CTE + "\nSELECT * FROM departures_r"),
    "q04_counts": _counts("flights_t", "airtime_t", "departures_t", "departures_1"),
    "q04_rerun_counts": _RERUN,
    "q05_delayed_routes": _top_routes(False),
    "q05_clean": _top_routes(True),
    "q05_route_ranking": _top_routes(False, ""),
    "q01_open_range": with_flights(f"""
SELECT count(*) AS flights FROM departures_t
WHERE origin = '{insights.Q1_ORIGIN}' AND dep_time > {Q1_LO} AND dep_time < {Q1_HI} - 1000"""),
    "dest_counts": with_flights("SELECT dest, count(*) AS count FROM flights_t GROUP BY dest"),
    "audit_csv_export": with_flights("""
SELECT id, origin, dest, (arr_time_utc_ms - dep_time_utc_ms) / 60000 AS time_taken,
       actual_elapsed_time - (arr_time_utc_ms - dep_time_utc_ms) / 60000 AS delay
FROM enriched
WHERE actual_elapsed_time <> air_time
  AND actual_elapsed_time - (arr_time_utc_ms - dep_time_utc_ms) / 60000 <> 0"""),
    "q06_ground_time": _ground(False),
    "q06_corrected": _ground(True),
    "q08_delay_audit": with_flights("""
SELECT id, fl_date, origin, dest, dep_time, arr_time, origin_timezone_code, dest_timezone_code,
       dep_time_utc_ms, arr_time_utc_ms, actual_elapsed_time, air_time,
       (arr_time_utc_ms - dep_time_utc_ms) / 60000 AS time_taken,
       actual_elapsed_time - (arr_time_utc_ms - dep_time_utc_ms) / 60000 AS delay
FROM enriched
WHERE actual_elapsed_time <> air_time
  AND actual_elapsed_time - (arr_time_utc_ms - dep_time_utc_ms) / 60000 <> 0"""),
    "dq_elapsed_eq_air": with_flights(f"SELECT {AUDIT} FROM enriched WHERE actual_elapsed_time = air_time"),
    "dq_elapsed_lt_air": with_flights(f"SELECT {AUDIT} FROM enriched WHERE actual_elapsed_time < air_time"),
    "dq_arr_before_dep_raw": with_flights(
        f"SELECT {AUDIT} FROM enriched WHERE arr_time_utc_ms_tmp <= dep_time_utc_ms"),
    "dq_arr_before_dep_fixed": with_flights(
        f"SELECT {AUDIT} FROM enriched WHERE arr_time_utc_ms <= dep_time_utc_ms "
        "AND actual_elapsed_time <> air_time"),
    "dq_short_flights": with_flights(
        f"SELECT {AUDIT} FROM enriched WHERE arr_time_utc_ms - dep_time_utc_ms < 3600000"),
    "dq_duration_mismatch": with_flights(
        f"SELECT {AUDIT}, (arr_time_utc_ms_tmp - dep_time_utc_ms) / 60000 AS diff_mins FROM enriched "
        "WHERE actual_elapsed_time <> (arr_time_utc_ms_tmp - dep_time_utc_ms) / 60000"),
    "dq_day_mismatch": with_flights(f"SELECT {AUDIT} FROM enriched WHERE day(fl_date) <> day_of_month"),
    "dq_route_zone_pair": with_flights(
        f"SELECT {AUDIT} FROM enriched WHERE origin_timezone_code = 'Pacific/Guam' "
        "AND dest_timezone_code = 'Pacific/Honolulu'"),
    "pk_dedupe": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
                 l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
                 l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
      FROM lineitem) t
WHERE rn = 1""",
    "upsert_partial": UPSERT,
    "upsert_partial_shuffle": UPSERT,
    "tz_offset_text": "WITH " + AIRPORTS_CTE.strip() + f"""
SELECT iata, timezone_offset,
       CASE WHEN timezone_offset IS NULL THEN NULL ELSE
         '-' || CASE WHEN length({_TZ_LEFT}) >= 4 THEN {_TZ_LEFT} ELSE rpad({_TZ_LEFT}, 4, '0') END
       END AS offset_text,
       CASE WHEN timezone_offset IS NULL THEN NULL ELSE
         CASE WHEN timezone_offset < 0 THEN '-' ELSE '+' END
         || lpad(CAST(abs(timezone_offset) AS VARCHAR), 2, '0') || '00' END AS offset_text_signed
FROM airports_src WHERE iata IS NOT NULL""",
    "csv_export_roundtrip": with_flights(f"SELECT {ENRICHED_COLUMNS} FROM enriched"),
    "stream_enrich_load": with_flights(f"SELECT {ENRICHED_COLUMNS} FROM enriched"),
    "q04_switched": with_flights(REPLACE_CTE + "\nSELECT * FROM departures_r"),
    "q04_switched_flights": with_flights(REPLACE_CTE + "\nSELECT * FROM flights_r"),
    "q04_switched_counts": _counts("flights_t", "airtime_t", "departures_t", "departures_1"),
    "delete_partition": with_flights(f"SELECT * FROM departures_t WHERE origin <> '{SRC}'"),
    "q02_from_partitions": with_flights(f"""
SELECT count(DISTINCT origin) AS airport_codes FROM departures_t
WHERE starts_with(origin, '{insights.Q2_PREFIX}')"""),
    "upsert_files": UPSERT,
    "upsert_sink": UPSERT,
    "layout_check": with_flights("".join(f"""
{'UNION ALL ' if i else ''}SELECT '{name}' AS table_name, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order_rows,
       CAST(0 AS BIGINT) AS overlapping_files FROM {view}""" for i, (name, view) in enumerate(
        (("flights", "flights_t"), ("airport_departures", "departures_t"), ("flights_airtime", "airtime_t"))))),
    "dq_all": with_flights("".join(f"""
{'UNION ALL ' if i else ''}SELECT '{name}' AS check_name, id FROM enriched WHERE {cond}"""
                                   for i, (name, cond) in enumerate(CHECKS.items()))),
    "dq_repeated_load": with_flights(f"""
, loads AS (SELECT r.* REPLACE (id + n * {REPEAT_STEP} AS id) FROM flights_raw r, range({REPEATS}) t(n)),
natural_keys AS (SELECT count(*) AS copies, list(id ORDER BY id) AS ids FROM loads
                 GROUP BY {', '.join(c.strip() for c in RAW_COLUMNS.split(',') if c.strip() != 'id')} HAVING count(*) > 1)
SELECT copies, CASE WHEN len(list_distinct(gaps)) = 1 AND gaps[1] > 0 THEN gaps[1] END AS id_step, count(*) AS flights
FROM (SELECT copies, list_transform(range(1, len(ids)), lambda i: ids[i + 1] - ids[i]) AS gaps FROM natural_keys) g
GROUP BY 1, 2"""),
    "csv_rejects": with_flights("""
SELECT id, CASE id % 50 WHEN 7 THEN 'date' WHEN 8 THEN 'columns' WHEN 9 THEN 'value' ELSE 'good' END AS reason
FROM flights_raw"""),
    "offset_path": with_flights("""
SELECT r.id, CAST(fl_date AS VARCHAR) || lpad(dep_time, 4, '0') AS date_time,
       CASE WHEN fl_date IS NULL OR dep_time IS NULL THEN CAST(0 AS BIGINT)
            ELSE epoch_ms(CAST(fl_date AS TIMESTAMP)) + (CAST(substr(lpad(dep_time, 4, '0'), 1, 2) AS BIGINT) * 60
                 + CAST(substr(lpad(dep_time, 4, '0'), 3, 2) AS BIGINT)) * 60000 - timezone_offset * 3600000 END
         AS dep_time_utc_ms
FROM flights_raw r JOIN airports_src a ON r.origin = a.iata"""),
    "flights_columns": with_flights("SELECT id, origin, dep_time FROM flights_t"),
    "dq_origin": with_flights(f"SELECT {AUDIT} FROM enriched WHERE origin = 'STT'"),
    "dq_elapsed_111": with_flights(f"SELECT {AUDIT} FROM enriched WHERE actual_elapsed_time = 111"),
    "airport_duplicates": "WITH " + AIRPORTS_CTE.strip() + """
SELECT iata, count(*) AS occurrences
FROM (SELECT iata FROM airports_src UNION ALL SELECT iata FROM airports_src WHERE airport_id % 5 = 0) a
WHERE iata IS NOT NULL GROUP BY iata HAVING count(*) > 1""",
    "rejected_null_keys": with_flights("""
SELECT id, 'airport_departures' AS table_name FROM flights_t
WHERE id % 11 = 0 OR origin IS NULL OR dep_time IS NULL
UNION ALL SELECT id, 'flights_airtime' FROM flights_t WHERE id % 7 = 0 OR fl_num IS NULL OR air_time IS NULL"""),
}
