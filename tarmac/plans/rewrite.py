"""Changes of a :class:`~tarmac.sources.warehouse.Warehouse` that rewrite only touched files.

Each first finds the files with a row to change (a scan of the tested columns), computes
their new rows with the keyed operators, writes these as one layer per table, and switches
all tables in one commit. Files without such a row are neither read again nor written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tarmac.operators.joins import BROADCAST_MAX_ROWS, fits_broadcast
from tarmac.operators.keyed import rekey, update_where, upsert
from tarmac.plans.replace import SOURCE_CODE, STEPS, TARGET_CODE
from tarmac.schema import AIRTIME_TABLE, DEPARTURES_TABLE, FLIGHTS_TABLE, KeyedTable
from tarmac.session import scratch_path
from tarmac.sources.files import materialize
from tarmac.sources.warehouse import FILE, State, Warehouse, touched, without


def _matches(column: str, code: str, name: str) -> F.Column:
    return F.count(F.when(F.col(column) == code, 1)).cast("long").alias(name)


def replace_code_in(wh: Warehouse, src: str = SOURCE_CODE, tgt: str = TARGET_CODE) -> DataFrame:
    """Q-04 / D-05 on the current state: the six steps, then one switch. Returns the counts
    (step, table_name, column_name, matched_rows).

    ``flights`` and ``flights_airtime`` change in place (narrow, order kept). Of
    ``airport_departures`` the files of ``src`` and ``tgt`` and those with a flight to
    ``src`` are computed anew; the old partition of ``src`` is left out by the switch."""
    base = wh.state()
    changes, counts = {}, {}
    for table, steps in ((FLIGHTS_TABLE, (1, 2)), (AIRTIME_TABLE, (3, 4))):
        rows = wh.scan(table, base).filter((F.col("origin") == src) | (F.col("dest") == src))
        hits = touched(rows, _matches("origin", src, "o"), _matches("dest", src, "d"))
        counts.update(zip(steps, (sum(r["o"] for r in hits), sum(r["d"] for r in hits))))
        if hits and src != tgt:
            files = [r[FILE] for r in hits]
            df = wh.scan(table, base, files).drop(FILE)
            for c in ("origin", "dest"):
                df = update_where(df, F.col(c) == src, {c: tgt})
            changes[table.name] = (*without(base.tables[table.name], files), wh.write(df, table, keep_order=True))
    counts[5] = counts[6] = 0
    rows = wh.scan(DEPARTURES_TABLE, base).filter(F.col("origin").isin(src, tgt) | (F.col("dest") == src))
    hits = touched(rows, _matches("origin", src, "o"), _matches("dest", src, "d"))
    if sum(r["o"] + r["d"] for r in hits):
        counts[5], files = sum(r["o"] for r in hits), [r[FILE] for r in hits]
        seen = Observation("departures")
        moved = rekey(wh.scan(DEPARTURES_TABLE, base, files).drop(FILE), DEPARTURES_TABLE.keys, "origin", src, tgt)
        moved = moved.observe(seen, _matches("dest", src, "d"))
        layer = wh.write(update_where(moved, F.col("dest") == src, {"dest": tgt}), DEPARTURES_TABLE)
        counts[6] = seen.get["d"]
        changes[DEPARTURES_TABLE.name] = (*without(base.tables[DEPARTURES_TABLE.name], files), layer)
    if changes and src != tgt:
        wh.commit(base, changes)
    return wh.spark.createDataFrame([(n, t, c, int(counts[n])) for n, t, c in STEPS],
                                    "step int, table_name string, column_name string, matched_rows long")


def upsert_into(wh: Warehouse, table: KeyedTable, delta: DataFrame) -> State:
    """S-07 / D-01: ``delta`` (keys and any columns) upserted into the current state.

    Only files that hold a key of the delta are rewritten; keys that no file holds become
    rows of the new layer. The keys of the delta bound the first key column of the search,
    a filter that skips files and row groups by their statistics."""
    base, keys = wh.state(), list(table.keys)
    delta = materialize(delta, scratch_path(wh.spark, "upsert-delta"))
    lead = keys[0]
    seen = delta.agg(F.count(F.lit(1)).alias("n"), F.min(lead).alias("lo"), F.max(lead).alias("hi")).first()
    if not seen["n"]:
        return base
    at = wh.scan(table, base).select(*keys, FILE).filter(F.col(lead).between(seen["lo"], seen["hi"]))
    wanted = delta.select(*keys)
    if fits_broadcast(wanted, seen["n"], BROADCAST_MAX_ROWS):
        wanted = F.broadcast(wanted)
    files = [r[FILE] for r in touched(at.join(wanted, keys, "left_semi"))]
    rows = upsert(wh.scan(table, base, files).drop(FILE), delta, keys)
    return wh.commit(base, {table.name: (*without(base.tables[table.name], files), wh.write(rows, table))})


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` stored at ``path`` in ``buckets`` hash buckets of ``keys``, sorted by them, as
    session table ``name``; joins and upserts on the keys then don't shuffle it."""
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


def open_bucketed(spark, name: str, path: str, schema, keys: Sequence[str], buckets: int) -> DataFrame:
    """A stored bucketed table under a session name, its files as they are."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}) "
              f"USING parquet CLUSTERED BY ({', '.join(keys)}) SORTED BY ({', '.join(keys)}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)


def upsert_bucketed(base: DataFrame, delta: DataFrame, keys: Sequence[str], name: str, path: str,
                    buckets: int) -> DataFrame:
    """D-01 with a large delta on a bucketed table: only the delta is shuffled, into the
    base's buckets; the result is the next bucketed table."""
    out = upsert(base, delta, keys, max_broadcast_rows=0)
    (out.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name))
    return base.sparkSession.table(name)
