"""Fixture anchors at sf0.01 (values stated in FIXTURES.md) and the question answers."""

import pytest
from pyspark.sql import functions as F

from support import SF_CHECK
from tarmac.plans import registry


@pytest.fixture(scope="module")
def enriched(spark):
    return registry.enriched(spark, SF_CHECK).cache()


def test_fixture_counts(enriched):
    e = enriched
    assert e.count() == 15000
    assert e.filter(F.col("FL_DATE").isin("2012-03-11", "2012-11-04")).count() == 750
    assert e.filter((F.col("ORIGIN_TIMEZONE_CODE") == "Pacific/Guam")
                    & (F.col("DEST_TIMEZONE_CODE") == "Pacific/Honolulu")).count() == 56
    assert e.filter(F.col("ORIGIN_TIMEZONE_CODE").isNull() | F.col("DEST_TIMEZONE_CODE").isNull()).count() == 1181
    assert e.filter(F.col("DEP_TIME") == "2400").count() == 10
    assert e.filter(F.col("ID") % 97 == 0).count() == 155
    assert e.filter(F.col("ACTUAL_ELAPSED_TIME") == F.col("AIR_TIME")).count() == 484
    assert e.filter(F.col("ACTUAL_ELAPSED_TIME") < F.col("AIR_TIME")).count() == 144


def test_delay_sign_split(spark):
    d = registry.insights.with_delay(registry.flights(spark, SF_CHECK))
    signs = {r.s: r.n for r in d.groupBy(F.signum("delay").alias("s")).agg(F.count("*").alias("n")).collect()}
    assert signs == {0.0: 9893, 1.0: 2487, -1.0: 2136}


def test_question_answers(spark):
    assert registry.q01(spark, SF_CHECK).first().flights == 10
    assert registry.q02(spark, SF_CHECK).first().airport_codes == 7
    top = registry.q03(spark, SF_CHECK).first()
    assert (top.origin, top.flights_count) == ("AUS", 15)
    assert registry.q03_sql(spark, SF_CHECK).first().origin == "AUS"
    counts = {r.origin: r.flights_count for r in registry.q03_counts(spark, SF_CHECK).collect()}
    assert counts["DEN"] == 14 and counts["ANC"] == 13
    p = registry.q05(spark, SF_CHECK).first()
    assert (p.route, p.trip_count) == ("ZZZ-JFK", 30)
    c = registry.q05_clean(spark, SF_CHECK).first()
    assert (c.route, c.trip_count) == ("GUM-PHX", 21)


def test_ground_time_means(spark):
    parity = registry.q06(spark, SF_CHECK).first()
    corrected = registry.q06_corrected(spark, SF_CHECK).first()
    assert parity.delayed_mean == pytest.approx(21.44054307, abs=1e-6)
    assert parity.ontime_mean == pytest.approx(18.37895482, abs=1e-6)
    assert corrected.delayed_mean == pytest.approx(20.89183756, abs=1e-6)
    assert parity.verdict == registry.insights.VERDICT_A_REASON
