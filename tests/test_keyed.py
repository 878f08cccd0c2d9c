"""Keyed-table operators: upsert, dedupe, rekey/delete and the code replacement."""

from pyspark.sql import functions as F

from support import SF_SMALL
from tarmac.operators.derive import airport_departures, flights_airtime
from tarmac.operators.keyed import (
    dedupe_keys, dedupe_keys_measured, delete_where, rekey, update_where, upsert,
)
from tarmac.plans import registry
from tarmac.plans.replace import replace_code


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_written_null_wins_and_inserts(spark):
    base = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0), (3, "c", 30.0)], "k int, s string, v double")
    delta = spark.createDataFrame([(2, None), (4, "d")], "k int, s string")
    want = [(1, "a", 10.0), (2, None, 20.0), (3, "c", 30.0), (4, "d", None)]
    assert _rows(upsert(base, delta, ["k"])) == want
    assert _rows(upsert(base, delta, ["k"], max_broadcast_rows=0)) == want


def test_upsert_paths_agree_on_orders(spark):
    (orders,) = registry.read_tables(spark, SF_SMALL, "orders")
    delta = registry.upsert_delta(orders)
    a = upsert(orders, delta, ["o_orderkey"])
    b = upsert(orders, delta, ["o_orderkey"], max_broadcast_rows=0)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == orders.count() + delta.filter(F.col("o_orderkey") < 0).count()


def test_update_where_equals_upsert_of_selected_rows(spark):
    f = registry.flights(spark, SF_SMALL)
    narrow = update_where(f, F.col("origin") == "BOS", {"origin": "TST"})
    delta = f.filter(F.col("origin") == "BOS").select("id").withColumn("origin", F.lit("TST"))
    general = upsert(f, delta, ["id"])
    assert narrow.exceptAll(general).count() == 0 and general.exceptAll(narrow).count() == 0


def test_dedupe_keeps_first_by_order(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 2, "z"), (1, 2, "y"), (2, None, "q"), (2, 5, "p")],
                               "k int, ver int, s string")
    assert _rows(dedupe_keys(df, ["k"], ["ver"])) == [(1, 2, "y"), (2, None, "q")]
    assert _rows(dedupe_keys(df, ["k"], ["ver"], descending=True)) == [(1, 3, "x"), (2, 5, "p")]


def test_dedupe_lineitem_key_count(spark):
    (li,) = registry.read_tables(spark, "/root/testdata/sf0.01", "lineitem")
    assert dedupe_keys(li, ["l_orderkey", "l_linenumber"]).count() == 45832


def test_rekey_overwrites_collisions_and_deletes_source(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 2, "y"), ("B", 1, "old"), ("C", 9, "z")],
                               "o string, k int, v string")
    out = rekey(df, ["o", "k"], "o", "A", "B")
    assert _rows(out) == [("B", 1, "x"), ("B", 2, "y"), ("C", 9, "z")]
    shuffled = rekey(df, ["o", "k"], "o", "A", "B", max_broadcast_rows=0)
    assert _rows(shuffled) == _rows(out)
    assert _rows(delete_where(df, "o", "A")) == [("B", 1, "old"), ("C", 9, "z")]


def test_replace_code_properties_and_idempotence(spark):
    f = registry.flights(spark, SF_SMALL)
    a, d = flights_airtime(f), airport_departures(f)
    first = replace_code(f, a, d, "BOS", "TST")
    counts = {r.step: r.matched_rows for r in first.counts.collect()}
    assert counts[1] == f.filter(F.col("origin") == "BOS").count() > 0
    assert counts[2] == f.filter(F.col("dest") == "BOS").count() > 0
    assert counts[3] == counts[1] and counts[4] == counts[2] and counts[5] == counts[1]
    for df in (first.flights, first.flights_airtime, first.airport_departures):
        assert df.filter((F.col("origin") == "BOS") | (F.col("dest") == "BOS")).count() == 0
    assert first.flights.count() == f.count()
    assert first.airport_departures.count() == d.count()
    assert first.flights_airtime.count() == a.count()
    assert (first.airport_departures.select("id").distinct().count() == d.count())
    again = replace_code(first.flights, first.flights_airtime, first.airport_departures, "BOS", "TST")
    assert [r.matched_rows for r in again.counts.orderBy("step").collect()] == [0] * 6


def test_derived_tables_keep_key_sets(spark):
    f = registry.flights(spark, SF_SMALL)
    ids = f.select("id")
    assert airport_departures(f).select("id").exceptAll(ids).count() == 0
    assert flights_airtime(f).count() == f.count() == airport_departures(f).count()


def test_measured_dedupe_equals_full_dedupe(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 2, "z"), (None, 1, "a"), (None, 0, "b"),
                                (2, 5, "p"), (3, 1, "q")], "k int, ver int, s string")
    assert _rows(dedupe_keys_measured(df, ["k"], ["ver"])) == _rows(dedupe_keys(df, ["k"], ["ver"]))
    assert _rows(dedupe_keys_measured(df, ["k"], ["ver"], max_broadcast_keys=0)) == \
        _rows(dedupe_keys(df, ["k"], ["ver"]))
    (li,) = registry.read_tables(spark, "/root/testdata/sf0.01", "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    a, b = dedupe_keys_measured(li, keys), dedupe_keys(li, keys)
    assert a.count() == 45832 and a.exceptAll(b).count() == 0
    unique = registry.flights(spark, SF_SMALL)
    assert dedupe_keys_measured(unique, ["id"]) is unique
