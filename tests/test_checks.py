"""Checks in one scan, repeated loads, stored order, bad records."""

import os

from pyspark.sql import functions as F

from support import SF_SMALL
from tarmac.operators import quality
from tarmac.plans import registry
from tarmac.schema import FLIGHTS_TABLE
from tarmac.sources.files import read_flights_csv_checked
from tarmac.sources.fixtures import load_fixture


def test_exceptions_are_the_union_of_the_single_checks_in_one_scan(spark):
    e = registry.enriched_stored(spark, SF_SMALL)
    found = quality.exceptions(e)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {(r.check_name, r.id) for r in found.select("check_name", "id").collect()}
    single = {"elapsed_eq_air": quality.elapsed_equals_air, "elapsed_lt_air": quality.elapsed_below_air,
              "arr_before_dep_raw": quality.arrival_not_after_departure_raw,
              "arr_before_dep_fixed": quality.arrival_not_after_departure, "short_flight": quality.short_flights,
              "duration_mismatch": quality.duration_mismatch, "day_mismatch": quality.day_of_month_mismatch}
    for name, check in single.items():
        assert {i for n, i in got if n == name} == {r.id for r in check(e).collect()}, name
    unmatched = {(f"{r.side}_unmatched", r.id) for r in registry.q_unmatched_airports(spark, SF_SMALL).collect()}
    assert {x for x in got if x[0].endswith("unmatched")} == unmatched


def test_repeated_loads_tell_even_steps_from_uneven_ones(spark):
    raw, _ = load_fixture(spark, SF_SMALL)
    assert quality.repeated_loads(raw).count() == 0
    two = raw.unionByName(raw.filter("ID % 2 = 0").withColumn("ID", F.col("ID") + 5000))
    (even,) = quality.repeated_loads(two).collect()
    assert tuple(even) == (2, 5000, raw.filter("ID % 2 = 0").count())
    one = raw.limit(1)
    odd = one.unionByName(one.withColumn("ID", F.col("ID") + 3)).unionByName(one.withColumn("ID", F.col("ID") + 10))
    assert [tuple(r) for r in quality.repeated_loads(odd).collect()] == [(3, None, 1)]
    same = one.unionByName(one).unionByName(one)
    assert [tuple(r) for r in quality.repeated_loads(same).collect()] == [(3, None, 1)]


def test_layout_check_fails_on_a_shuffled_copy(spark, scratch):
    flights = registry.flights(spark, SF_SMALL)
    assert all(r.out_of_order_rows == r.overlapping_files == 0 for r in registry.q_layout_check(spark, SF_SMALL).collect())
    path = scratch("shuffled")
    flights.repartition(3).write.parquet(path)
    (bad,) = quality.layout_check(spark.read.schema(FLIGHTS_TABLE.schema).parquet(path), "flights", ["id"], True).collect()
    assert bad.rows == flights.count() and bad.out_of_order_rows > 0 and bad.overlapping_files == 2
    empty = scratch("empty")
    flights.limit(0).write.parquet(empty)
    (none,) = quality.layout_check(spark.read.schema(FLIGHTS_TABLE.schema).parquet(empty), "flights", ["id"], True).collect()
    assert tuple(none) == ("flights", 0, 0, 0)


def test_broken_lines_are_rejected_with_a_reason(spark, scratch):
    good = '4,2012,2,2012/01/02,19805,AA,1,12478,JFK,"New York, NY",NY,LAX,Los Angeles,CA,921,1210,349,325,2475'
    lines = [good, good.replace("2012/01/02", "02.01.2012"), good.replace(",CA,", ",", 1), good + ",extra",
             good.replace("2475", "far"), "x" + good, good.replace("2012/01/02", "")]
    path = scratch("broken")
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    flights, rejects = read_flights_csv_checked(spark, path)
    assert sorted((r.FL_DATE is None, r.ORIGIN_CITY_NAME) for r in flights.collect()) == [
        (False, "New York, NY"), (True, "New York, NY")]
    got = {r.line: (r.id, r.reason) for r in rejects.collect()}
    assert got == {lines[1]: (4, "date"), lines[2]: (4, "columns"), lines[3]: (4, "columns"), lines[4]: (4, "value"),
                   lines[5]: (None, "value")}
