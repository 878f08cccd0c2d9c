"""Readers/writers and the three batch programs end to end on stored tables."""

import os

from pyspark.sql import functions as F

from support import SF_SMALL
from tarmac.plans import jobs, registry
from tarmac.schema import DEPARTURES_TABLE, FLIGHTS_TABLE
from tarmac.sources.files import (
    export_csv, read_airports_csv, read_csv, read_flights_csv, read_table, write_airports_csv,
    write_flights_csv,
)
from tarmac.sources.fixtures import load_fixture


def test_flight_csv_reader_is_permissive_on_bad_dates(spark, scratch):
    path = scratch("bad-dates")
    os.makedirs(path)
    with open(os.path.join(path, "part.csv"), "w") as f:
        f.write("4,2012,2,2012/01/02,19805,AA,1,12478,JFK,New York,NY,LAX,Los Angeles,CA,921,1210,349,325,2475\n")
        f.write("5,2012,3,2012-01-03,19805,AA,1,12478,JFK,New York,NY,LAX,Los Angeles,CA,931,1224,353,319,2475\n")
    rows = read_flights_csv(spark, path).orderBy("ID").collect()
    assert [str(r.FL_DATE) for r in rows] == ["2012-01-02", "None"]
    assert rows[0].DEP_TIME == "921" and rows[0].ACTUAL_ELAPSED_TIME == 349


def test_csv_roundtrip_and_airport_reader(spark, scratch):
    raw, airports = load_fixture(spark, SF_SMALL)
    fp, ap = scratch("flights"), scratch("airports")
    write_flights_csv(raw, fp)
    write_airports_csv(airports, ap)
    back = read_flights_csv(spark, fp)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    a = read_airports_csv(spark, ap)
    assert a.count() == 24 and a.filter(F.col("IATA").isNull()).count() == 0


def test_export_single_file(spark, scratch):
    raw, _ = load_fixture(spark, SF_SMALL)
    out = scratch("export")
    export_csv(raw, out, single_file=True)
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1
    assert read_csv(spark, out, header=True).count() == raw.count()


def test_three_programs_end_to_end(spark, scratch):
    raw, airports = load_fixture(spark, SF_SMALL)
    fp, ap = scratch("in-flights"), scratch("in-airports")
    write_flights_csv(raw, fp)
    write_airports_csv(airports, ap)
    root = scratch("warehouse")
    v1, v2 = jobs.Version(root, 1), jobs.Version(root, 2)
    metrics = jobs.load(spark, fp, ap, v1)
    assert metrics["rows"] == raw.count()
    staged = jobs.enriched_table(spark, v1)
    audit = registry.insights.delay_audit(staged)
    assert sorted(audit.collect()) == sorted(registry.q08(spark, SF_SMALL).collect())
    jobs.downstream(spark, v1, v1)
    answers = {k: df.collect() for k, df in jobs.questions(spark, v1, v1).items()}
    expected = {k: fn(spark, SF_SMALL).collect() for k, fn in
                {"q01": registry.q01, "q02": registry.q02, "q03": registry.q03,
                 "q05": registry.q05, "q06": registry.q06}.items()}
    assert answers == expected
    counts = jobs.replace_airport_code(spark, v1, v1, v2)
    assert counts.count() == 6 and counts.filter("matched_rows > 0").count() == 6
    rerun = jobs.replace_airport_code(spark, v2, v2, jobs.Version(root, 3))
    assert [r.matched_rows for r in rerun.orderBy("step").collect()] == [0] * 6
    dep = read_table(spark, v2.path(DEPARTURES_TABLE), DEPARTURES_TABLE)
    assert dep.filter(F.col("origin") == "BOS").count() == 0
    assert dep.count() == read_table(spark, v1.path(DEPARTURES_TABLE), DEPARTURES_TABLE).count()
    assert read_table(spark, v2.path(FLIGHTS_TABLE), FLIGHTS_TABLE).count() == raw.count()
    # Partition directories per origin on the departures table.
    assert any(d.startswith("origin=") for d in os.listdir(v1.path(DEPARTURES_TABLE)))


def test_generic_csv_reader_infers_types(spark, scratch):
    from tarmac.sources.files import read_csv
    raw, _ = load_fixture(spark, SF_SMALL)
    path = scratch("generic")
    write_flights_csv(raw, path)
    df = read_csv(spark, path)
    assert len(df.columns) == 19 and df.count() == raw.count()
    assert dict(df.dtypes)["_c0"] in ("int", "bigint")


def test_spot_checks(spark):
    from tarmac.operators import quality
    e = registry.enriched(spark, SF_SMALL)
    stt = quality.spot_check(e, origin="STT")
    assert stt.count() == e.filter(F.col("ORIGIN") == "STT").count() > 0
    one = quality.spot_check(e, actual_elapsed_time=111, origin="ATL")
    assert one.count() == e.filter((F.col("ACTUAL_ELAPSED_TIME") == 111) & (F.col("ORIGIN") == "ATL")).count()
    excluded = quality.duration_mismatch(e, exclude_elapsed=111)
    assert excluded.filter(F.col("actual_elapsed_time") == 111).count() == 0


def test_command_line_programs(spark, scratch):
    from tarmac.__main__ import main
    raw, airports = load_fixture(spark, SF_SMALL)
    fp, ap, root = scratch("cli-flights"), scratch("cli-airports"), scratch("cli-root")
    write_flights_csv(raw, fp)
    write_airports_csv(airports, ap)
    assert main(["load", "--flights", fp, "--airports", ap, "--root", root, "--version", "1"],
                spark)["rows"] == raw.count()
    main(["downstream", "--root", root, "--version", "1"], spark)
    answers = main(["questions", "--root", root, "--version", "1"], spark)
    assert answers["q01"] == [r.asDict() for r in registry.q01(spark, SF_SMALL).collect()]
    counts = main(["replace", "--root", root, "--version", "1", "--to-version", "2"], spark)["counts"]
    assert [c["step"] for c in counts] == [1, 2, 3, 4, 5, 6]
