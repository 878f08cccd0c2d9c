"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives its inputs from the generated tables in ``sf_dir`` (flights from
``orders``, airports from ``nation``, keyed-table cases from ``lineitem``/``orders``)
and runs over the whole tables. Instants are returned as BIGINT epoch milliseconds
and every computed column is aliased, so results compare 1:1 with ``plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.clock import date_time_text, offset_zone_id, utc_millis, zone_offset_text
from tarmac.operators import quality
from tarmac.operators.aggregate import grouped_count
from tarmac.operators.derive import rejected_rows
from tarmac.operators.enrich import enrich_flights, unmatched_airports
from tarmac.operators.joins import duplicate_keys
from tarmac.operators.keyed import dedupe_keys, upsert
from tarmac.plans import insights
from tarmac.plans.jobs import Version, build_tables, downstream, enriched_table
from tarmac.plans.replace import SOURCE_CODE, replace_code
from tarmac.plans.rewrite import replace_code_in, upsert_bucketed, upsert_into, write_bucketed
from tarmac.schema import AIRTIME_TABLE, DEPARTURES_TABLE, ENRICHED_TABLE, FLIGHTS_TABLE, KeyedTable
from tarmac.session import scratch_path
from tarmac.sources.files import (
    export_csv, read_airports_csv, read_csv, read_flights_csv, read_flights_csv_checked, read_table,
    write_airports_csv, write_flights_csv,
)
from tarmac.sources.fixtures import load_fixture, read_tables
from tarmac.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# The changed subset used by the upsert case (derived from ``orders``).
UPSERT_UPDATED_PRIORITY = "1-URGENT"   # these orders get status 'X' and a null price
UPSERT_INSERTED_PRIORITY = "5-LOW"     # these appear again under key -(k+1), status 'N'


def _lower(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(c.lower()) for c in df.columns])


def _ms(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.unix_millis(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def enriched(spark: SparkSession, sf_dir: str, how: str = "left") -> DataFrame:
    raw, airports = load_fixture(spark, sf_dir)
    return enrich_flights(raw, airports, how=how)


_STORED: dict[tuple[str, str], Version] = {}


def stored(spark: SparkSession, sf_dir: str) -> Version:
    """The stored tables of one scale, as the load and downstream jobs leave them: the
    enrichment, ``flights``, ``airport_departures`` and ``flights_airtime`` are written
    once per application and input, and every question and check reads them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _STORED:
        try:
            read_table(spark, _STORED[key].path(AIRTIME_TABLE), AIRTIME_TABLE)
        except AnalysisException:  # the shared folder was cleaned meanwhile
            del _STORED[key]
    if key not in _STORED:
        at = Version(scratch_path(spark, "warehouse"), 1)
        raw, airports = load_fixture(spark, sf_dir)
        build_tables(enrich_flights(raw, airports), at)
        downstream(spark, at, at)
        _STORED[key] = at
    return _STORED[key]


def enriched_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_table(spark, stored(spark, sf_dir))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, stored(spark, sf_dir).path(FLIGHTS_TABLE), FLIGHTS_TABLE)


def departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, stored(spark, sf_dir).path(DEPARTURES_TABLE), DEPARTURES_TABLE)


def airtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, stored(spark, sf_dir).path(AIRTIME_TABLE), AIRTIME_TABLE)


def q_enrich_utc(spark, sf_dir):
    return _lower(enriched(spark, sf_dir))


def q_enrich_inner(spark, sf_dir):
    return _lower(enriched(spark, sf_dir, how="inner"))


def q_unmatched_airports(spark, sf_dir):
    raw, airports = load_fixture(spark, sf_dir)
    return unmatched_airports(raw, airports)


def q_flights_table(spark, sf_dir):
    return _ms(flights(spark, sf_dir), "dep_time", "arr_time")


def q_airport_departures(spark, sf_dir):
    return _ms(departures(spark, sf_dir), "dep_time")


def q_flights_airtime(spark, sf_dir):
    return airtime(spark, sf_dir)


def q_rejected_key_rows(spark, sf_dir):
    return rejected_rows(flights(spark, sf_dir)).withColumnRenamed("table", "table_name")


def q01(spark, sf_dir):
    return insights.departures_on_day(departures(spark, sf_dir))


def q01_open(spark, sf_dir):
    return insights.departures_on_day(departures(spark, sf_dir), style="open")


def q_dest_counts(spark, sf_dir):
    return grouped_count(flights(spark, sf_dir).select("dest"), ["dest"])


def q02(spark, sf_dir):
    return insights.codes_with_prefix(departures(spark, sf_dir))


def q03(spark, sf_dir):
    return insights.busiest_origin(departures(spark, sf_dir))


def q03_counts(spark, sf_dir):
    return insights.origin_counts(departures(spark, sf_dir))


def q03_sql(spark, sf_dir):
    return insights.busiest_origin_sql(spark, departures(spark, sf_dir))


def _replacement(spark, sf_dir, runs: int = 1):
    result = replace_code(flights(spark, sf_dir), airtime(spark, sf_dir), departures(spark, sf_dir))
    for _ in range(runs - 1):
        result = replace_code(result.flights, result.flights_airtime, result.airport_departures)
    return result


def q04_replace_flights(spark, sf_dir):
    return _ms(_replacement(spark, sf_dir).flights, "dep_time", "arr_time")


def q04_replace_airtime(spark, sf_dir):
    return _replacement(spark, sf_dir).flights_airtime


def q04_replace_departures(spark, sf_dir):
    return _ms(_replacement(spark, sf_dir).airport_departures, "dep_time")


def q04_counts(spark, sf_dir):
    return _replacement(spark, sf_dir).counts


def q04_rerun_counts(spark, sf_dir):
    return _replacement(spark, sf_dir, runs=2).counts


def q05(spark, sf_dir):
    return insights.delayed_routes(flights(spark, sf_dir))


def q05_clean(spark, sf_dir):
    return insights.delayed_routes(flights(spark, sf_dir), clean=True)


def q05_ranking(spark, sf_dir):
    return insights.delayed_routes(flights(spark, sf_dir), k=None)


def q06(spark, sf_dir):
    return insights.ground_time_factor(flights(spark, sf_dir))


def q06_corrected(spark, sf_dir):
    return insights.ground_time_factor(flights(spark, sf_dir), corrected=True)


def q08(spark, sf_dir):
    return insights.delay_audit(enriched_stored(spark, sf_dir))


def _check(fn, **kw) -> Query:
    return lambda spark, sf_dir: fn(enriched_stored(spark, sf_dir), **kw)


def q_pk_dedupe(spark, sf_dir):
    (lineitem,) = read_tables(spark, sf_dir, "lineitem")
    return dedupe_keys(lineitem, ["l_orderkey", "l_linenumber"])


def upsert_delta(orders: DataFrame) -> DataFrame:
    """Changed subset of ``orders``: updates with a written null, plus new keys."""
    updated = orders.filter(F.col("o_orderpriority") == UPSERT_UPDATED_PRIORITY).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"),
        F.lit(None).cast("double").alias("o_totalprice"))
    inserted = orders.filter(F.col("o_orderpriority") == UPSERT_INSERTED_PRIORITY).select(
        (-F.col("o_orderkey") - 1).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"),
        F.col("o_totalprice"))
    return updated.unionByName(inserted)


def _upsert(max_broadcast_rows: int | None) -> Query:
    def run(spark, sf_dir):
        (orders,) = read_tables(spark, sf_dir, "orders")
        kw = {} if max_broadcast_rows is None else {"max_broadcast_rows": max_broadcast_rows}
        return upsert(orders, upsert_delta(orders), ["o_orderkey"], **kw)
    return run


def q_tz_offset_text(spark, sf_dir):
    _, airports = load_fixture(spark, sf_dir)
    a = airports.filter(F.col("IATA").isNotNull())
    return a.select(F.col("IATA").alias("iata"), F.col("TIMEZONE_OFFSET").alias("timezone_offset"),
                    zone_offset_text("TIMEZONE_OFFSET").alias("offset_text"),
                    zone_offset_text("TIMEZONE_OFFSET", signed=True).alias("offset_text_signed"))


def q_csv_roundtrip(spark, sf_dir):
    """S-01/S-02/S-09: write the inputs in the original file formats (in parallel),
    read them back with the CSV readers, and enrich."""
    raw, airports = load_fixture(spark, sf_dir)
    flights_csv, airports_csv = scratch_path(spark, "flights-csv"), scratch_path(spark, "airports-csv")
    write_flights_csv(raw, flights_csv)
    write_airports_csv(airports, airports_csv)
    back = enrich_flights(read_flights_csv(spark, flights_csv), read_airports_csv(spark, airports_csv))
    return _lower(back)


def q_csv_export(spark, sf_dir):
    """S-09 and S-03: the audit exported to one CSV file with a header, read back."""
    path = scratch_path(spark, "audit-csv")
    audit = insights.delay_audit(enriched_stored(spark, sf_dir)).select("id", "origin", "dest", "time_taken", "delay")
    export_csv(audit, path, single_file=True)
    back = read_csv(spark, path, header=True)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in audit.schema])


def q_stream_enrich_load(spark, sf_dir):
    """Streaming form of the load: fixture flights as CSV files -> incremental,
    checkpointed enrichment -> Parquet staging rows, read back when caught up."""
    from tarmac.streaming import incremental_load
    raw, airports = load_fixture(spark, sf_dir)
    src = scratch_path(spark, "stream-in")
    write_flights_csv(raw, src)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    query = incremental_load(spark, src, airports, out, ckpt)
    query.awaitTermination()
    return _lower(spark.read.schema(ENRICHED_TABLE.schema).parquet(out))


def warehouse(spark, sf_dir) -> Warehouse:
    """A root of its own whose current state is the stored tables of one scale."""
    wh = Warehouse(spark, scratch_path(spark, "root"))
    wh.create(FLIGHTS_TABLE, DEPARTURES_TABLE, AIRTIME_TABLE)
    wh.replace({FLIGHTS_TABLE: flights(spark, sf_dir), DEPARTURES_TABLE: departures(spark, sf_dir),
                AIRTIME_TABLE: airtime(spark, sf_dir)})
    return wh


def q04_switched(spark, sf_dir):
    """Q-04 in the warehouse, read back through its current state."""
    wh = warehouse(spark, sf_dir)
    replace_code_in(wh)
    return _ms(wh.read(DEPARTURES_TABLE), "dep_time")


def q04_switched_flights(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    replace_code_in(wh)
    return _ms(wh.read(FLIGHTS_TABLE), "dep_time", "arr_time")


def q04_switched_counts(spark, sf_dir):
    return replace_code_in(warehouse(spark, sf_dir))


def q_delete_partition(spark, sf_dir):
    """D-04: one origin deleted from the stored departures, without reading a row."""
    wh = warehouse(spark, sf_dir)
    wh.drop_partition(DEPARTURES_TABLE, SOURCE_CODE)
    return _ms(wh.read(DEPARTURES_TABLE), "dep_time")


def q02_from_partitions(spark, sf_dir):
    """Q-02 from the partition values of the current state: no row is scanned."""
    values = warehouse(spark, sf_dir).partitions(DEPARTURES_TABLE)
    n = sum(v.startswith(insights.Q2_PREFIX) for v in values)
    return spark.createDataFrame([(n,)], "airport_codes long")


def orders_table(orders: DataFrame) -> KeyedTable:
    return KeyedTable("orders", orders.schema, keys=("o_orderkey",), cluster_by=("o_orderkey",))


def q_upsert_files(spark, sf_dir):
    """S-07: the upsert written into the warehouse (touched files only), read back."""
    (orders,) = read_tables(spark, sf_dir, "orders")
    wh, table = Warehouse(spark, scratch_path(spark, "root")), orders_table(orders)
    wh.replace({table: orders})
    upsert_into(wh, table, upsert_delta(orders))
    return wh.read(table)


def q_upsert_sink(spark, sf_dir, buckets: int = 16):
    """S-07 / D-01 on a bucketed table: written, upserted without shuffling it, read back."""
    (orders,) = read_tables(spark, sf_dir, "orders")
    names = [f"orders_{uuid.uuid4().hex[:10]}" for _ in range(2)]
    paths = [scratch_path(spark, n) for n in names]
    base = write_bucketed(orders, names[0], paths[0], ["o_orderkey"], buckets)
    return upsert_bucketed(base, upsert_delta(orders), ["o_orderkey"], names[1], paths[1], buckets)


def q_layout_check(spark, sf_dir):
    at, parts = stored(spark, sf_dir), []
    for t in (FLIGHTS_TABLE, DEPARTURES_TABLE, AIRTIME_TABLE):
        rows = spark.read.schema(t.schema).parquet(at.path(t))
        parts.append(quality.layout_check(rows, t.name, list(t.cluster_by), ranged=not t.partition_by))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_dq_all(spark, sf_dir):
    return quality.exceptions(enriched_stored(spark, sf_dir)).select("check_name", "id")


REPEATS, REPEAT_STEP = 3, 100_000_000  # fixed values: the load repeated with moved ids


def q_repeated_load(spark, sf_dir):
    raw, _ = load_fixture(spark, sf_dir)
    again = raw.withColumn("_n", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))))
    return quality.repeated_loads(again.withColumn("ID", F.col("ID") + F.col("_n") * REPEAT_STEP).drop("_n"))


def q_csv_rejects(spark, sf_dir):
    """S-01 with broken lines: a date in another format, a cut line, a word for a number."""
    raw, _ = load_fixture(spark, sf_dir)
    cols = [F.date_format("FL_DATE", "yyyy/MM/dd") if c == "FL_DATE" else F.col(c).cast("string") for c in raw.columns]
    text = [F.coalesce(c, F.lit("")) for c in cols]
    date, short, word = text.copy(), text[:10], text.copy()
    date[3], word[18] = F.lit("2012-01-03"), F.lit("far")
    line = (F.when(F.col("ID") % 50 == 7, F.concat_ws(",", *date)).when(F.col("ID") % 50 == 8, F.concat_ws(",", *short))
            .when(F.col("ID") % 50 == 9, F.concat_ws(",", *word)).otherwise(F.concat_ws(",", *text)))
    path = scratch_path(spark, "broken-csv")
    raw.select(line).write.text(path)
    good, rejects = read_flights_csv_checked(spark, path)
    return rejects.select("id", "reason").unionByName(good.select(F.col("ID").alias("id"), F.lit("good").alias("reason")))


def q_offset_path(spark, sf_dir):
    """F-12, F-13: date and clock as one text, and UTC by the airport's numeric offset."""
    raw, airports = load_fixture(spark, sf_dir)
    zone = offset_zone_id(zone_offset_text("TIMEZONE_OFFSET", signed=True))
    zones = airports.filter("IATA IS NOT NULL").select(F.col("IATA").alias("ORIGIN"), zone.alias("zone"))
    return raw.join(F.broadcast(zones), "ORIGIN").select(  # one row per airport code
        F.col("ID").alias("id"), date_time_text("FL_DATE", "DEP_TIME").alias("date_time"),
        utc_millis("FL_DATE", "DEP_TIME", "zone").alias("dep_time_utc_ms"))


def q_flights_columns(spark, sf_dir):
    return _ms(read_table(spark, stored(spark, sf_dir).path(FLIGHTS_TABLE), FLIGHTS_TABLE,
                          columns=["id", "origin", "dep_time"]), "dep_time")


def q_airport_duplicates(spark, sf_dir):
    """C-07: codes that occur more than once, on airports of which some are listed again."""
    _, airports = load_fixture(spark, sf_dir)
    again = airports.filter(F.col("AIRPORT_ID") % 5 == 0)
    return duplicate_keys(airports.unionByName(again).filter("IATA IS NOT NULL"), ["IATA"]).withColumnRenamed("IATA", "iata")


def q_rejected_null_keys(spark, sf_dir):
    """R3 on flights of which some lack a key part."""
    null = F.lit(None)
    df = flights(spark, sf_dir)
    df = df.withColumn("air_time", F.when(F.col("id") % 7 != 0, F.col("air_time")).otherwise(null))
    df = df.withColumn("origin", F.when(F.col("id") % 11 != 0, F.col("origin")).otherwise(null))
    return rejected_rows(df).withColumnRenamed("table", "table_name")


QUERIES: dict[str, Query] = {
    "enrich_utc": q_enrich_utc,
    "enrich_inner": q_enrich_inner,
    "unmatched_airports": q_unmatched_airports,
    "flights_table": q_flights_table,
    "airport_departures": q_airport_departures,
    "flights_airtime": q_flights_airtime,
    "rejected_key_rows": q_rejected_key_rows,
    "q01_departures_on_day": q01,
    "q01_open_range": q01_open,
    "dest_counts": q_dest_counts,
    "q02_codes_with_prefix": q02,
    "q03_busiest_origin": q03,
    "q03_origin_counts": q03_counts,
    "q03_sql": q03_sql,
    "q04_replace_flights": q04_replace_flights,
    "q04_replace_airtime": q04_replace_airtime,
    "q04_replace_departures": q04_replace_departures,
    "q04_counts": q04_counts,
    "q04_rerun_counts": q04_rerun_counts,
    "q05_delayed_routes": q05,
    "q05_clean": q05_clean,
    "q05_route_ranking": q05_ranking,
    "q06_ground_time": q06,
    "q06_corrected": q06_corrected,
    "q08_delay_audit": q08,
    "dq_elapsed_eq_air": _check(quality.elapsed_equals_air),
    "dq_elapsed_lt_air": _check(quality.elapsed_below_air),
    "dq_arr_before_dep_raw": _check(quality.arrival_not_after_departure_raw),
    "dq_arr_before_dep_fixed": _check(quality.arrival_not_after_departure),
    "dq_short_flights": _check(quality.short_flights),
    "dq_duration_mismatch": _check(quality.duration_mismatch),
    "dq_day_mismatch": _check(quality.day_of_month_mismatch),
    "dq_route_zone_pair": _check(quality.spot_check, origin_timezone_code="Pacific/Guam",
                                 dest_timezone_code="Pacific/Honolulu"),
    "pk_dedupe": q_pk_dedupe,
    "upsert_partial": _upsert(None),
    "upsert_partial_shuffle": _upsert(0),
    "tz_offset_text": q_tz_offset_text,
    "csv_export_roundtrip": q_csv_roundtrip,
    "audit_csv_export": q_csv_export,
    "stream_enrich_load": q_stream_enrich_load,
    "q04_switched": q04_switched,
    "q04_switched_flights": q04_switched_flights,
    "q04_switched_counts": q04_switched_counts,
    "delete_partition": q_delete_partition,
    "q02_from_partitions": q02_from_partitions,
    "upsert_files": q_upsert_files,
    "upsert_sink": q_upsert_sink,
    "layout_check": q_layout_check,
    "dq_all": q_dq_all,
    "dq_repeated_load": q_repeated_load,
    "csv_rejects": q_csv_rejects,
    "offset_path": q_offset_path,
    "flights_columns": q_flights_columns,
    "dq_origin": _check(quality.spot_check, origin="STT"),
    "dq_elapsed_111": _check(quality.spot_check, actual_elapsed_time=111),
    "airport_duplicates": q_airport_duplicates,
    "rejected_null_keys": q_rejected_null_keys,
}
