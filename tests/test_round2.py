"""Stored tables behind the questions, zone resolution, and the keyed operators' edges."""

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from tarmac.operators import enrich
from tarmac.operators.joins import fits_broadcast
from tarmac.operators.keyed import rekey, upsert
from tarmac.plans import insights, jobs, registry
from tarmac.schema import AIRPORTS, AIRTIME_TABLE, FLIGHTS_RAW


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_registered_questions_read_pruned_tables(spark):
    q1 = _plan(registry.q01(spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(origin" in q1 and "GreaterThanOrEqual(dep_time" in q1
    assert "ReadSchema: struct<dep_time:timestamp" in q1
    assert registry.stored(spark, SF_SMALL) is registry.stored(spark, SF_SMALL)


def test_airtime_files_hold_separate_ranges(spark, scratch):
    at = registry.stored(spark, SF_SMALL)
    files = (spark.read.parquet(at.path(AIRTIME_TABLE)).groupBy(F.input_file_name())
             .agg(F.min("fl_num").alias("lo"), F.max("fl_num").alias("hi")).orderBy("lo").collect())
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))


def _airports(spark, rows):
    cols = {"IATA": 0, "TIMEZONE_CODE": 1}
    return spark.createDataFrame([tuple(r[cols[f]] if f in cols else None for f in AIRPORTS.fieldNames())
                                  for r in rows], AIRPORTS)


def _flights(spark, rows):
    return spark.createDataFrame([tuple(r.get(f) for f in FLIGHTS_RAW.fieldNames()) for r in rows], FLIGHTS_RAW)


def test_airport_without_zone_is_unmatched(spark):
    airports = _airports(spark, [("AAA", "UTC"), ("BBB", None)])
    flights = _flights(spark, [{"ID": 1, "ORIGIN": "AAA", "DEST": "BBB"}, {"ID": 2, "ORIGIN": "CCC", "DEST": "AAA"}])
    got = sorted(map(tuple, enrich.unmatched_airports(flights, airports).collect()))
    assert got == [(1, "dest", "BBB"), (2, "origin", "CCC")]


def test_zone_ids_come_from_the_jvm(spark, monkeypatch):
    import zoneinfo
    monkeypatch.setattr(zoneinfo, "available_timezones", lambda: set())
    zones = spark.createDataFrame([("America/New_York",), ("PST",), ("GMT-5",), ("Nowhere/X",), (None,)], "z string")
    got = [r[0] for r in zones.select(enrich.sanitize_zone("z")).collect()]
    assert got == ["America/New_York", "PST", "GMT-5", "UTC", None]
    hours = zones.select(F.hour(F.to_utc_timestamp(F.lit("2012-01-15 00:00:00"), enrich.sanitize_zone("z")))).collect()
    assert [r[0] for r in hours] == [5, 8, 5, 0, None]


def test_ground_time_verdict_uses_plain_means(spark):
    # Delayed mean 20.0000005, on-time mean 20: a difference below six digits decides.
    n = 2_000_000
    one = spark.range(1).select(F.lit(0).cast("timestamp").alias("dep_time"))
    rows = (spark.range(n + 1).crossJoin(F.broadcast(one)).select(
        F.col("id"), F.lit("A").alias("origin"), F.lit("B").alias("dest"), "dep_time",
        F.timestamp_seconds(F.when(F.col("id") < n, 60 * 59).otherwise(60 * 60)).alias("arr_time"),
        F.lit(60).alias("actual_elapsed_time"),
        F.when(F.col("id") == 0, 39).otherwise(40).alias("air_time")))
    got = insights.ground_time_factor(rows).first()
    assert got.delayed_mean > got.ontime_mean and got.verdict == insights.VERDICT_A_REASON


def test_all_routes_can_be_ranked(spark):
    top, every = registry.q05(spark, SF_SMALL), registry.q05_ranking(spark, SF_SMALL)
    assert every.limit(10).collect() == top.collect() and every.count() > 10


def test_keyed_edges(spark):
    df = spark.createDataFrame([("A", None, "x"), ("B", None, "old"), ("C", 1, "z")], "o string, k int, v string")
    for bound in (100, 0):
        got = sorted(map(tuple, rekey(df, ["o", "k"], "o", "A", "B", max_broadcast_rows=bound).collect()), key=repr)
        assert got == [("B", None, "x"), ("C", 1, "z")]
    assert rekey(df, ["o", "k"], "o", "A", "A").collect() == df.collect()
    with pytest.raises(ValueError, match="null key"):
        upsert(df, spark.createDataFrame([("A", None, "n")], df.schema), ["o", "k"])
    assert fits_broadcast(df, 10) and not fits_broadcast(df, 5_000_000) and not fits_broadcast(df, 1_900_000)


def test_version_zero_is_a_version():
    from tarmac.__main__ import parse
    args = parse(["downstream", "--root", "r", "--version", "3", "--from-version", "0"])
    assert args.from_version == 0 and jobs.Version("r", 0).path("t") == "r/t/v=0"
