"""Schemas of the inputs and of the three stored tables, plus their key declarations.

Column names and order are the data model users of the original application know
(fixed values): the raw flight file has 19 upper-case columns, the airport file 13,
and the stored tables use lower-case names. ``ID``/``id`` is widened to a 64-bit
integer so that row ids do not overflow at cluster scale.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw flight file layout (no header, comma separated, dates yyyy/MM/dd).
FLIGHTS_RAW = _struct([
    ("ID", T.LongType()),
    ("YEAR", T.IntegerType()),
    ("DAY_OF_MONTH", T.IntegerType()),
    ("FL_DATE", T.DateType()),
    ("AIRLINE_ID", T.IntegerType()),
    ("CARRIER", T.StringType()),
    ("FL_NUM", T.IntegerType()),
    ("ORIGIN_AIRPORT_ID", T.IntegerType()),
    ("ORIGIN", T.StringType()),
    ("ORIGIN_CITY_NAME", T.StringType()),
    ("ORIGIN_STATE_ABR", T.StringType()),
    ("DEST", T.StringType()),
    ("DEST_CITY_NAME", T.StringType()),
    ("DEST_STATE_ABR", T.StringType()),
    ("DEP_TIME", T.StringType()),
    ("ARR_TIME", T.StringType()),
    ("ACTUAL_ELAPSED_TIME", T.IntegerType()),
    ("AIR_TIME", T.IntegerType()),
    ("DISTANCE", T.IntegerType()),
])

# Airport file layout (with header). Declared instead of inferred so
# reading needs no extra inference pass over the file.
AIRPORTS = _struct([
    ("AIRPORT_ID", T.IntegerType()),
    ("AIRPORT_NAME", T.StringType()),
    ("CITY", T.StringType()),
    ("COUNTRY", T.StringType()),
    ("IATA", T.StringType()),
    ("ICAO", T.StringType()),
    ("LATITUDE", T.DoubleType()),
    ("LONGITUDE", T.DoubleType()),
    ("ALTITUDE", T.IntegerType()),
    ("TIMEZONE_OFFSET", T.IntegerType()),
    ("DST", T.StringType()),
    ("TIMEZONE_CODE", T.StringType()),
    ("TYPE", T.StringType()),
])

# Stored base table; dep_time/arr_time are UTC instants.
FLIGHTS = _struct([
    ("id", T.LongType()),
    ("year", T.IntegerType()),
    ("day_of_month", T.IntegerType()),
    ("fl_date", T.DateType()),
    ("airline_id", T.IntegerType()),
    ("carrier", T.StringType()),
    ("fl_num", T.IntegerType()),
    ("origin_airport_id", T.IntegerType()),
    ("origin", T.StringType()),
    ("origin_city_name", T.StringType()),
    ("origin_state_abr", T.StringType()),
    ("dest", T.StringType()),
    ("dest_city_name", T.StringType()),
    ("dest_state_abr", T.StringType()),
    ("dep_time", T.TimestampType()),
    ("arr_time", T.TimestampType()),
    ("actual_elapsed_time", T.IntegerType()),
    ("air_time", T.IntegerType()),
    ("distance", T.IntegerType()),
])

# Departures by airport, clustered by (dep_time, id) inside an origin.
AIRPORT_DEPARTURES = _struct([
    ("origin", T.StringType()),
    ("dep_time", T.TimestampType()),
    ("id", T.LongType()),
    ("airline_id", T.IntegerType()),
    ("carrier", T.StringType()),
    ("fl_num", T.IntegerType()),
    ("origin_city_name", T.StringType()),
    ("origin_state_abr", T.StringType()),
    ("dest", T.StringType()),
    ("dest_city_name", T.StringType()),
    ("dest_state_abr", T.StringType()),
    ("distance", T.IntegerType()),
])

# Flights by number and air-time bucket.
FLIGHTS_AIRTIME = _struct([
    ("fl_num", T.IntegerType()),
    ("air_time_bucket", T.IntegerType()),
    ("id", T.LongType()),
    ("carrier", T.StringType()),
    ("origin", T.StringType()),
    ("origin_city_name", T.StringType()),
    ("dest", T.StringType()),
    ("dest_city_name", T.StringType()),
])


# Staging layout of the enrichment: the raw columns plus zones and UTC milliseconds.
FLIGHTS_ENRICHED = T.StructType(FLIGHTS_RAW.fields + [
    T.StructField("ORIGIN_TIMEZONE_CODE", T.StringType(), True),
    T.StructField("DEP_TIME_UTC_MS", T.LongType(), True),
    T.StructField("DEST_TIMEZONE_CODE", T.StringType(), True),
    T.StructField("ARR_TIME_UTC_MS_TMP", T.LongType(), True),
    T.StructField("ARR_TIME_UTC_MS", T.LongType(), True),
])


@dataclass(frozen=True)
class KeyedTable:
    """A stored table: schema, primary key, and its physical layout on write.

    ``partition_by`` becomes directory partitioning (pruned by equality filters);
    ``cluster_by`` is the in-file order (row-group min/max skipping on range filters).
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    columns: tuple[str, ...] = field(default=())

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(f.name for f in self.schema.fields))


FLIGHTS_TABLE = KeyedTable("flights", FLIGHTS, keys=("id",), cluster_by=("id",))
DEPARTURES_TABLE = KeyedTable("airport_departures", AIRPORT_DEPARTURES,
                              keys=("origin", "dep_time", "id"),
                              partition_by=("origin",), cluster_by=("dep_time", "id"))
AIRTIME_TABLE = KeyedTable("flights_airtime", FLIGHTS_AIRTIME,
                           keys=("fl_num", "air_time_bucket", "id"),
                           cluster_by=("fl_num", "air_time_bucket", "id"))

# Not keyed by the original store: a staging table the checks and the audit read, so
# the zone conversion runs once per load instead of once per check.
ENRICHED_TABLE = KeyedTable("flights_enriched", FLIGHTS_ENRICHED, keys=("ID",))

TABLES = {t.name: t for t in (FLIGHTS_TABLE, DEPARTURES_TABLE, AIRTIME_TABLE, ENRICHED_TABLE)}
