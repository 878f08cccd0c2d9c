"""Q-04 / D-05: replace an airport code everywhere, as keyed writes.

Six steps, in the original order, each with its matched-row count:

  1 flights            origin = src -> origin := tgt   (D-01, written: id, origin)
  2 flights            dest   = src -> dest   := tgt   (D-01, written: id, dest)
  3 flights_airtime    origin = src -> origin := tgt   (D-01, written: key, origin)
  4 flights_airtime    dest   = src -> dest   := tgt   (D-01, written: key, dest)
  5 airport_departures origin = src -> rows copied under origin tgt, then the
                       src partition deleted (D-03 + D-04; origin is a key column)
  6 airport_departures dest   = src (read after step 5) -> dest := tgt (D-01)

Steps 1-4 and 6 select the written rows from the table itself, so they are narrow
conditional updates (``update_where``); only step 5 may shuffle, and only the rows
stored under ``src`` or ``tgt``. All new versions are computed first and written to
new paths; nothing is overwritten in place, so a half-done replacement is never seen.
Running it again matches 0 rows in every step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tarmac.operators.keyed import rekey, update_where
from tarmac.schema import DEPARTURES_TABLE

# The original run's arguments.
SOURCE_CODE, TARGET_CODE = "BOS", "TST"

STEPS = [
    (1, "flights", "origin"),
    (2, "flights", "dest"),
    (3, "flights_airtime", "origin"),
    (4, "flights_airtime", "dest"),
    (5, "airport_departures", "origin"),
    (6, "airport_departures", "dest"),
]


@dataclass
class Replacement:
    flights: DataFrame
    flights_airtime: DataFrame
    airport_departures: DataFrame
    counts: DataFrame
    # With ``observed=True``: Observations filled while the three new versions are
    # written (steps 1-2, 3-4, 6); step 5 is then a partition-pruned count.
    observations: tuple[Observation, Observation, Observation] | None = None


def _matches(df: DataFrame, column: str, code: str) -> F.Column:
    return F.count(F.when(F.col(column) == code, 1)).cast("long")


def replace_code(flights: DataFrame, airtime: DataFrame, departures: DataFrame,
                 src: str = SOURCE_CODE, tgt: str = TARGET_CODE, *,
                 observed: bool = False) -> Replacement:
    """Next versions of the three tables plus a (step, table, column, matched_rows) frame.

    ``observed=True`` also attaches metric observations at points every row passes
    exactly once on its way to the write (the flights and airtime inputs, the
    departures after the move), so a job writing the versions gets the step counts
    without extra scans of the tables.
    """
    observations = None
    plain_flights, plain_airtime = flights, airtime
    if observed:
        of, oa, od = Observation("replace_flights"), Observation("replace_airtime"), Observation("replace_departures")
        flights = flights.observe(of, _matches(flights, "origin", src).alias("s1"),
                                  _matches(flights, "dest", src).alias("s2"))
        airtime = airtime.observe(oa, _matches(airtime, "origin", src).alias("s3"),
                                  _matches(airtime, "dest", src).alias("s4"))
        observations = (of, oa, od)
    f1 = update_where(flights, F.col("origin") == src, {"origin": tgt})
    f2 = update_where(f1, F.col("dest") == src, {"dest": tgt})
    a1 = update_where(airtime, F.col("origin") == src, {"origin": tgt})
    a2 = update_where(a1, F.col("dest") == src, {"dest": tgt})
    d1 = rekey(departures, DEPARTURES_TABLE.keys, "origin", src, tgt)
    d1_in = d1.observe(observations[2], _matches(d1, "dest", src).alias("s6")) if observed else d1
    d2 = update_where(d1_in, F.col("dest") == src, {"dest": tgt})

    # Counts: steps 1/2 read flights (step 1 does not touch dest), 3/4 airtime,
    # 5 the departures before the move, 6 the departures after it.
    # Each table is scanned once for both of its counts (one partial+final aggregate).
    sources = {"flights": plain_flights, "flights_airtime": plain_airtime}
    parts = []
    for table, df in sources.items():
        steps = [(n, c) for n, t, c in STEPS if t == table]
        wide = df.agg(*[_matches(df, c, src).alias(f"s{n}") for n, c in steps])
        stack = ", ".join(f"{n}, '{table}', '{c}', s{n}" for n, c in steps)
        parts.append(wide.selectExpr(
            f"stack({len(steps)}, {stack}) AS (step, table_name, column_name, matched_rows)"))
    for n, df in ((5, departures), (6, d1)):
        column = "origin" if n == 5 else "dest"
        parts.append(df.agg(_matches(df, column, src).alias("matched_rows")).select(
            F.lit(n).alias("step"), F.lit(DEPARTURES_TABLE.name).alias("table_name"),
            F.lit(column).alias("column_name"), "matched_rows"))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    counts = counts.select(F.col("step").cast("int"), "table_name", "column_name",
                           F.col("matched_rows").cast("long"))
    return Replacement(f2, a2, d2, counts, observations)
