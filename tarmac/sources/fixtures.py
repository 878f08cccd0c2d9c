"""Adapter from the driver's generated tables to the flight data model.

The test tables hold no flights. This module derives a deterministic flight table
from ``orders`` (one flight per order; k = o_orderkey, c = o_custkey) and an airport
dimension from ``nation`` (one airport per nation key), so every query reads the given
tables and its work grows with them. The derivation is a single projection: no
shuffle, no driver round trip. ``tarmac.plans.oracle`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import AIRPORTS, FLIGHTS_RAW

# Fixed values (fixture design): airport index -> IATA code, IANA zone, standard
# offset in minutes. Index 24 has no zone and its airport row has a null IATA, so
# flights coded ZZZ stay unmatched.
AIRPORT_CODES = ["ATL", "BOS", "JFK", "LAX", "SFO", "SEA", "SAN", "DFW", "ORD", "AUS",
                 "DEN", "ABQ", "PHX", "ANC", "ADQ", "HNL", "OGG", "GUM", "STT", "SJU",
                 "ABE", "AGS", "MIA", "LAS", "ZZZ"]
AIRPORT_ZONES = ["America/New_York", "America/New_York", "America/New_York",
                 "America/Los_Angeles", "America/Los_Angeles", "America/Los_Angeles",
                 "America/Los_Angeles", "America/Chicago", "America/Chicago",
                 "America/Chicago", "America/Denver", "America/Denver", "America/Phoenix",
                 "America/Anchorage", "America/Anchorage", "Pacific/Honolulu",
                 "Pacific/Honolulu", "Pacific/Guam", "America/Puerto_Rico",
                 "America/Puerto_Rico", "America/New_York", "America/New_York",
                 "America/New_York", "America/Los_Angeles", None]
AIRPORT_OFFSETS = [-300, -300, -300, -480, -480, -480, -480, -360, -360, -360, -420, -420,
                   -420, -540, -540, -600, -600, 600, -240, -240, -300, -300, -300, -480, 0]
NULL_IATA_INDEX = 24
NO_DST_ZONES = ["America/Phoenix", "Pacific/Honolulu", "Pacific/Guam", "America/Puerto_Rico"]
CARRIER_CODES = ["AA", "B6", "DL", "UA", "WN"]
N_AIRPORTS = len(AIRPORT_CODES)

# Fixed values (fixture design): moduli that place dirty and edge rows.
CLOCK_CHANGE_SPRING = "2012-03-11"   # k % 40 == 0
CLOCK_CHANGE_FALL = "2012-11-04"     # k % 40 == 1
BASE_DATE = "2012-01-01"             # + k % 60 days otherwise


def _sql_value(v) -> str:
    return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))


def _sql_array(values, cast: str) -> str:
    return f"CAST(array({', '.join(_sql_value(v) for v in values)}) AS array<{cast}>)"


def _pick(values, index: F.Column, cast: str) -> F.Column:
    """values[index] — the list is one SQL array literal (a single call into the JVM)."""
    return F.element_at(F.expr(_sql_array(values, cast)), index + 1)


def flights_raw_from_orders(orders: DataFrame) -> DataFrame:
    """One raw flight per order, in the raw-file layout (``schema.FLIGHTS_RAW``).

    Two narrow projections written as SQL expressions (planned in two calls).
    """
    codes, offs = _sql_array(AIRPORT_CODES, "string"), _sql_array(AIRPORT_OFFSETS, "int")
    carriers = _sql_array(CARRIER_CODES, "string")
    base = orders.selectExpr(
        "o_orderkey AS k", "o_custkey AS c",
        f"CAST(o_custkey % {N_AIRPORTS} AS INT) AS oi",
        f"CAST((o_custkey + 1 + o_orderkey % 24) % {N_AIRPORTS} AS INT) AS di",
        f"CASE WHEN o_orderkey % 40 = 0 THEN DATE'{CLOCK_CHANGE_SPRING}' "
        f"WHEN o_orderkey % 40 = 1 THEN DATE'{CLOCK_CHANGE_FALL}' "
        f"ELSE date_add(DATE'{BASE_DATE}', CAST(o_orderkey % 60 AS INT)) END AS fl_date",
        "(37 * o_orderkey + 11 * o_custkey) % 1440 AS m",
        "CAST(60 + (7 * o_orderkey) % 300 AS INT) AS el",
        "CASE WHEN o_orderkey % 10 = 8 THEN 60 WHEN o_orderkey % 10 = 9 THEN -60 ELSE 0 END AS j")
    code = lambda i: f"element_at({codes}, {i} + 1)"
    off = lambda i: f"element_at({offs}, {i} + 1)"
    am = f"(((m + el + {off('di')} - {off('oi')} + j) % 1440) + 1440) % 1440"
    clock = lambda x: f"CAST(CAST(floor({x} / 60) * 100 + {x} % 60 AS BIGINT) AS STRING)"
    exprs = {
        "ID": "k",
        "YEAR": "year(fl_date)",
        "DAY_OF_MONTH": "dayofmonth(fl_date) + CASE WHEN k % 97 = 0 THEN 1 ELSE 0 END",
        "FL_DATE": "fl_date",
        "AIRLINE_ID": "19000 + c % 20",
        "CARRIER": f"element_at({carriers}, CAST(c % 5 AS INT) + 1)",
        "FL_NUM": "1 + c % 900",
        "ORIGIN_AIRPORT_ID": "10000 + oi",
        "ORIGIN": code("oi"),
        "ORIGIN_CITY_NAME": f"concat('City ', {code('oi')})",
        "ORIGIN_STATE_ABR": f"substring({code('oi')}, 1, 2)",
        "DEST": code("di"),
        "DEST_CITY_NAME": f"concat('City ', {code('di')})",
        "DEST_STATE_ABR": f"substring({code('di')}, 1, 2)",
        "DEP_TIME": f"CASE WHEN k % 53 = 0 THEN NULL WHEN m = 0 THEN '2400' ELSE {clock('m')} END",
        "ARR_TIME": f"CASE WHEN k % 59 = 0 THEN NULL ELSE {clock(am)} END",
        "ACTUAL_ELAPSED_TIME": "el",
        "AIR_TIME": "CASE WHEN k % 31 = 0 THEN el WHEN k % 101 = 0 THEN el + 5 ELSE el - 10 - k % 20 END",
        "DISTANCE": "100 + (13 * k) % 2500",
    }
    return base.selectExpr(*[f"CAST({exprs[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
                             for f in FLIGHTS_RAW.fields])


def airports_from_nation(nation: DataFrame) -> DataFrame:
    """One airport per nation key, in the airport-file layout (``schema.AIRPORTS``).

    The row at ``NULL_IATA_INDEX`` keeps a null IATA; readers reject it (P-14).
    """
    i = F.col("n_nationkey").cast("int")
    code = _pick(AIRPORT_CODES, i, "string")
    zone = _pick(AIRPORT_ZONES, i, "string")
    cols = {
        "AIRPORT_ID": 3400 + i,
        "AIRPORT_NAME": F.concat(F.col("n_name"), F.lit(" Airport")),
        "CITY": F.concat(F.lit("City "), code),
        "COUNTRY": F.lit("United States"),
        "IATA": F.when(i == NULL_IATA_INDEX, F.lit(None).cast("string")).otherwise(code),
        "ICAO": F.concat(F.lit("K"), code),
        "LATITUDE": 20.0 + i,
        "LONGITUDE": -160.0 + 3 * i,
        "ALTITUDE": 10 * i,
        "TIMEZONE_OFFSET": (_pick(AIRPORT_OFFSETS, i, "int") / 60).cast("int"),
        "DST": F.when(zone.isin(*NO_DST_ZONES), "N").otherwise("A"),
        "TIMEZONE_CODE": zone,
        "TYPE": F.lit("airport"),
    }
    return nation.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in AIRPORTS.fields])


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer input splits than the session's task slots one partition
    per slot (round-robin, after column pruning). A generated table is one file with
    one row group, i.e. one split: without this every per-row step downstream would run
    in a single task. Inputs with enough splits (any table at cluster scale) pass as is.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def read_tables(spark: SparkSession, sf_dir: str, *names: str,
                spread_splits: bool = True) -> list[DataFrame]:
    dfs = [spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names]
    return [spread(df) for df in dfs] if spread_splits else dfs


def load_fixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(raw flights, airports including the null-IATA row) derived from ``sf_dir``."""
    (orders,) = read_tables(spark, sf_dir, "orders")
    (nation,) = read_tables(spark, sf_dir, "nation", spread_splits=False)
    return flights_raw_from_orders(orders), airports_from_nation(nation)
