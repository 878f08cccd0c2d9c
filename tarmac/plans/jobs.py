"""The three batch programs, as Spark jobs over a table root.

load        raw flight CSV + airport CSV -> enriched, keyed ``flights`` table
downstream  ``flights`` -> ``airport_departures`` + ``flights_airtime`` (one pruned scan each)
questions   Q-01..Q-06 over the stored tables; Q-04 writes new table versions

Every job writes its output as a new table version under ``root`` (a shared folder
on a cluster); the written table is the lineage cut between jobs, so a lost executor
only recomputes tasks of the running job. Mid-pipeline ``count()`` actions of the
original are not repeated; row metrics come from ``DataFrame.observe`` instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.derive import airport_departures, flights_airtime
from tarmac.operators.enrich import enrich_flights, to_flights_table
from tarmac.operators.keyed import dedupe_keys_measured
from tarmac.plans import insights
from tarmac.plans.replace import SOURCE_CODE, STEPS, TARGET_CODE, replace_code
from tarmac.schema import AIRTIME_TABLE, DEPARTURES_TABLE, ENRICHED_TABLE, FLIGHTS_TABLE
from tarmac.sources.files import (
    materialize, read_airports_csv, read_flights_csv, read_table, table_path, write_table,
)


@dataclass
class Version:
    root: str
    version: int

    def path(self, table) -> str:
        return table_path(self.root, table, self.version)


def load(spark: SparkSession, flights_csv: str, airports_csv: str, out: Version,
         dedupe: bool = True) -> dict[str, int]:
    """Program 1: read the two CSV inputs, enrich, write ``flights``. Returns row metrics.

    The enrichment (zones, local clocks, UTC ms) is written once as the
    ``flights_enriched`` staging table — the lineage cut of the job and the input of the
    checks and the audit. ``flights`` is built from the stored copy; the primary-key
    rule first measures repeated ids (reading only the id column) and shuffles only
    when, and only what, it has to.
    """
    raw = read_flights_csv(spark, flights_csv)
    airports = read_airports_csv(spark, airports_csv)
    return build_tables(enrich_flights(raw, airports), out, dedupe)


def build_tables(enriched: DataFrame, out: Version, dedupe: bool = True) -> dict[str, int]:
    """Writes the enrichment as staging table, and ``flights`` from the stored copy."""
    staged = materialize(enriched, out.path(ENRICHED_TABLE))
    flights = to_flights_table(staged)
    if dedupe:
        flights = dedupe_keys_measured(flights, FLIGHTS_TABLE.keys)
    obs = Observation("load")
    write_table(flights, out.path(FLIGHTS_TABLE), FLIGHTS_TABLE, observe=(
        obs, F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.unix_millis("dep_time") == 0, 1)).alias("dep_sentinels")))
    return {k: int(v) for k, v in obs.get.items()}


def downstream(spark: SparkSession, src: Version, out: Version) -> None:
    """Program 2: both derived tables from one stored ``flights`` version."""
    flights = read_table(spark, src.path(FLIGHTS_TABLE), FLIGHTS_TABLE)
    write_table(airport_departures(flights), out.path(DEPARTURES_TABLE), DEPARTURES_TABLE)
    write_table(flights_airtime(flights), out.path(AIRTIME_TABLE), AIRTIME_TABLE)


def enriched_table(spark: SparkSession, at: Version) -> DataFrame:
    """The staging table written by ``load`` (input of the checks and the audit)."""
    return read_table(spark, at.path(ENRICHED_TABLE), ENRICHED_TABLE)


def tables(spark: SparkSession, flights_at: Version, derived_at: Version) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (read_table(spark, flights_at.path(FLIGHTS_TABLE), FLIGHTS_TABLE),
            read_table(spark, derived_at.path(AIRTIME_TABLE), AIRTIME_TABLE),
            read_table(spark, derived_at.path(DEPARTURES_TABLE), DEPARTURES_TABLE))


def questions(spark: SparkSession, flights_at: Version, derived_at: Version) -> dict[str, DataFrame]:
    """Program 3 (read-only part): Q-01, Q-02, Q-03, Q-05, Q-06 over stored tables."""
    flights, _, departures = tables(spark, flights_at, derived_at)
    return {
        "q01": insights.departures_on_day(departures),
        "q02": insights.codes_with_prefix(departures),
        "q03": insights.busiest_origin(departures),
        "q05": insights.delayed_routes(flights),
        "q06": insights.ground_time_factor(flights),
    }


def replace_airport_code(spark: SparkSession, flights_at: Version, derived_at: Version,
                         out: Version, src: str = SOURCE_CODE, tgt: str = TARGET_CODE) -> DataFrame:
    """Program 3, Q-04: compute all three new versions, write them, return the counts.

    Each table is read once, by its write: steps 1-4 and 6 are counted by observations
    on the write plans, step 5 by a count pruned to the ``origin=src`` directory.
    """
    flights, airtime, departures = tables(spark, flights_at, derived_at)
    result = replace_code(flights, airtime, departures, src, tgt, observed=True)
    moved = departures.filter(F.col("origin") == src).count()
    # Both are narrow changes of stored tables: their distribution stays as it is.
    write_table(result.flights, out.path(FLIGHTS_TABLE), FLIGHTS_TABLE, keep_layout=True)
    write_table(result.flights_airtime, out.path(AIRTIME_TABLE), AIRTIME_TABLE, keep_layout=True)
    write_table(result.airport_departures, out.path(DEPARTURES_TABLE), DEPARTURES_TABLE)
    of, oa, od = (o.get for o in result.observations)
    values = {1: of["s1"], 2: of["s2"], 3: oa["s3"], 4: oa["s4"], 5: moved, 6: od["s6"]}
    rows = [(n, t, c, int(values[n])) for n, t, c in STEPS]
    return spark.createDataFrame(rows, "step int, table_name string, column_name string, matched_rows long")
