"""R1/R2 and the scalar helpers: golden rows recorded by the original run + edge cases."""

import csv
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tarmac.functions import clock
from tarmac.functions.clock import repair_arrival, utc_millis, with_utc_millis

GOLDEN = os.path.join(os.path.dirname(__file__), "golden")


def _rows(name):
    with open(os.path.join(GOLDEN, name)) as f:
        return list(csv.DictReader(line for line in f if not line.startswith("#")))


def _convert(spark, rows, null_sentinels=False, on_error="fail"):
    df = spark.createDataFrame(rows, "d date, t string, z string")
    staged = with_utc_millis(df, [("ms", "d", "t", "z")], null_sentinels=null_sentinels,
                             on_error=on_error)
    single = df.select(utc_millis("d", "t", "z", null_sentinels=null_sentinels,
                                  on_error=on_error).alias("ms"))
    a = [r.ms for r in staged.collect()]
    b = [r.ms for r in single.collect()]
    assert a == b, "staged and single-expression forms must agree"
    return a


def test_golden_transcript_rows(spark):
    rows = _rows("transcript_rows.csv")
    df = spark.createDataFrame(
        [(int(r["id"]), date.fromisoformat(r["fl_date"]), r["dep_time"], r["arr_time"],
          r["origin_timezone_code"], r["dest_timezone_code"]) for r in rows],
        "id long, d date, dep string, arr string, oz string, dz string")
    timed = with_utc_millis(df, [("dep_ms", "d", "dep", "oz"), ("arr_raw", "d", "arr", "dz")])
    out = timed.select("id", "dep_ms", repair_arrival("dep_ms", "arr_raw", "oz", "dz", "dep", "arr")
                       .alias("arr_ms")).orderBy("id").collect()
    expected = sorted((int(r["id"]), int(r["dep_time_utc_ms"]), int(r["arr_time_utc_ms"])) for r in rows)
    assert [(r.id, r.dep_ms, r.arr_ms) for r in out] == expected


def test_golden_delay_audit_rows(spark):
    rows = _rows("delay_audit_rows.csv")
    df = spark.createDataFrame(
        [(int(r["id"]), date.fromisoformat(r["fl_date"]), r["dep_time"], r["arr_time"],
          r["origin_timezone_code"], r["dest_timezone_code"], int(r["actual_elapsed_time"]))
         for r in rows],
        "id long, d date, dep string, arr string, oz string, dz string, el int")
    timed = with_utc_millis(df, [("dep_ms", "d", "dep", "oz"), ("arr_raw", "d", "arr", "dz")])
    fixed = timed.withColumn("arr_ms", repair_arrival("dep_ms", "arr_raw", "oz", "dz", "dep", "arr"))
    out = fixed.select("id", clock.elapsed_minutes("arr_ms", "dep_ms").alias("taken"),
                       clock.inverse_delay_minutes("el", "arr_ms", "dep_ms").alias("delay")).collect()
    got = {r.id: (r.taken, r.delay) for r in out}
    for r in rows:
        assert got[int(r["id"])] == (float(r["time_taken"]), float(r["delay"])), r["id"]


@pytest.mark.parametrize("d,t,z,expected", [
    ("2012-01-02", "921", "America/New_York", 1325514060000),    # plain
    ("2012-01-02", "2400", "America/New_York", 1325566800000),   # lenient: next day 00:00
    ("2012-01-02", "1260", "America/New_York", 1325527200000),   # lenient: 13:00
    ("2012-11-04", "130", "America/New_York", 1352010600000),    # repeated hour: later instant
    ("2012-03-11", "230", "America/New_York", 1331451000000),    # skipped hour: shifted forward
    ("2012-01-02", "12345", "America/New_York", 1325525640000),  # longer text cut to 4 (12:34)
    ("2012-01-02", "921", "-05:00", 1325514060000),              # offset zone id
])
def test_r1_cases(spark, d, t, z, expected):
    assert _convert(spark, [(date.fromisoformat(d), t, z)]) == [expected]


def test_r1_missing_inputs_give_epoch_or_null(spark):
    rows = [(None, "921", "UTC"), (date(2012, 1, 2), None, "UTC"), (date(2012, 1, 2), "921", None)]
    assert _convert(spark, rows) == [0, 0, 0]
    assert _convert(spark, rows, null_sentinels=True) == [None, None, None]


def test_r1_unparseable_text(spark):
    rows = [(date(2012, 1, 2), "9x1", "UTC")]
    assert _convert(spark, rows, on_error="null") == [None]
    with pytest.raises(Exception, match="unparseable"):
        _convert(spark, rows)


def test_unknown_zone_reads_as_utc(spark):
    from tarmac.operators.enrich import zone_lookup
    ap = spark.createDataFrame([("AAA", "Bogus/Zone"), ("BBB", "Pacific/Guam"), ("CCC", None),
                                ("DDD", "-05:00"), (None, "UTC")], "IATA string, TIMEZONE_CODE string")
    got = {r.IATA: r.TIMEZONE_CODE for r in zone_lookup(ap).collect()}
    assert got == {"AAA": "UTC", "BBB": "Pacific/Guam", "CCC": None, "DDD": "-05:00"}


@pytest.mark.parametrize("oz,dz,dep_clock,arr_clock,dep,arr,expected", [
    ("Pacific/Guam", "Pacific/Honolulu", "1700", "500", 100, 50, 50),            # (a) keep
    ("Pacific/Guam", "Pacific/Honolulu", "1500", "500", 100, 50, 50 - 86400000),  # (a) day earlier
    ("Pacific/Guam", "Pacific/Honolulu", None, "500", 100, 50, 50 - 86400000),    # (a) null clock
    ("America/New_York", "America/Chicago", "900", "100", 100, 50, 50 + 86400000),  # (b)
    ("America/New_York", "America/Chicago", "900", "1000", 100, 150, 150),          # (c)
    (None, "Pacific/Honolulu", "900", "100", 100, 50, 50 + 86400000),              # null-safe zone
])
def test_r2_branches(spark, oz, dz, dep_clock, arr_clock, dep, arr, expected):
    df = spark.createDataFrame([(oz, dz, dep_clock, arr_clock, dep, arr)],
                               "oz string, dz string, dc string, ac string, dep long, arr long")
    out = df.select(repair_arrival("dep", "arr", "oz", "dz", "dc", "ac").alias("x")).first().x
    assert out == expected


def test_air_time_bucket_boundaries(spark):
    df = spark.createDataFrame([(0,), (1,), (10,), (11,), (277,), (None,)], "a int")
    got = [r.b for r in df.select(clock.air_time_bucket("a").alias("b")).collect()]
    assert got == [0, 10, 10, 20, 280, None]


def test_zone_offset_text(spark):
    df = spark.createDataFrame([(-9,), (-10,), (10,), (0,), (None,)], "o int")
    out = df.select(clock.zone_offset_text("o").alias("p"),
                    clock.zone_offset_text("o", signed=True).alias("s")).collect()
    assert [(r.p, r.s) for r in out] == [("-0900", "-0900"), ("-1000", "-1000"),
                                         ("-0000", "+1000"), ("-0000", "+0000"), (None, None)]
    z = spark.createDataFrame([("-0500",)], "t string").select(clock.offset_zone_id("t").alias("z"))
    assert z.first().z == "-05:00"


def test_delay_and_ground_minutes(spark):
    df = spark.createDataFrame([(0, 3_600_000, 50, 40)], "dep long, arr long, el int, air int")
    r = df.select(clock.delay_minutes(F.timestamp_millis("arr"), F.timestamp_millis("dep"), "el").alias("d"),
                  clock.ground_minutes("el", "air").alias("g"),
                  clock.date_time_text(F.lit("2012-01-02"), F.lit("855")).alias("t")).first()
    assert (r.d, r.g, r.t) == (10.0, 10, "2012-01-020855")
