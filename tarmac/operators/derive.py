"""D-06 / D-07: query-shaped projections of the base flight table.

Both are narrow projections of ``flights`` (no shuffle). Their primary keys contain
``id``, the base table's unique key, so they are unique by construction and need no
deduplication. Rows with a null key part are rejected (R3: the store refuses them);
:func:`rejected_rows` reports them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.clock import air_time_bucket
from tarmac.operators.keyed import drop_null_keys, null_key_rows
from tarmac.schema import AIRTIME_TABLE, DEPARTURES_TABLE


def airport_departures(flights: DataFrame) -> DataFrame:
    """D-06: departures by origin airport (12 columns)."""
    out = flights.select(*DEPARTURES_TABLE.columns)
    return drop_null_keys(out, DEPARTURES_TABLE.keys)


def flights_airtime(flights: DataFrame) -> DataFrame:
    """D-07: flights by number with the air-time bucket (F-10) (8 columns)."""
    out = flights.withColumn("air_time_bucket", air_time_bucket("air_time"))
    return drop_null_keys(out.select(*AIRTIME_TABLE.columns), AIRTIME_TABLE.keys)


def rejected_rows(flights: DataFrame) -> DataFrame:
    """Flights that cannot enter a derived table because a key part is null."""
    dep = null_key_rows(flights.select(*DEPARTURES_TABLE.columns), DEPARTURES_TABLE.keys)
    air = null_key_rows(flights.withColumn("air_time_bucket", air_time_bucket("air_time"))
                        .select(*AIRTIME_TABLE.columns), AIRTIME_TABLE.keys)
    return (dep.select("id", F.lit(DEPARTURES_TABLE.name).alias("table"))
            .unionByName(air.select("id", F.lit(AIRTIME_TABLE.name).alias("table"))))
