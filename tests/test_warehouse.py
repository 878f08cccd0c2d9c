"""The warehouse: one current state, changes that rewrite touched files only."""

import os

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from tarmac.plans import registry
from tarmac.plans.replace import replace_code
from tarmac.plans.rewrite import open_bucketed, replace_code_in, upsert_bucketed, upsert_into, write_bucketed
from tarmac.schema import AIRTIME_TABLE, DEPARTURES_TABLE, FLIGHTS_TABLE
from tarmac.sources import warehouse as w
from tarmac.sources.warehouse import CommitConflict, Warehouse

TABLES = (FLIGHTS_TABLE, DEPARTURES_TABLE, AIRTIME_TABLE)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_create_is_idempotent_and_an_empty_table_reads(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    assert wh.state().tables == {}
    one = wh.create(*TABLES)
    assert wh.create(*TABLES) == one and wh.state() == one
    assert all(wh.read(t).count() == 0 and wh.read(t).columns == list(t.columns) for t in TABLES)


def test_readers_see_all_old_or_all_new(spark, monkeypatch):
    wh = registry.warehouse(spark, SF_SMALL)
    before = wh.state()
    old = {t.name: rows(wh.read(t)) for t in TABLES}
    # A run that dies when its last table is written leaves the old state current.
    write = Warehouse.write

    def failing(self, df, table, **kw):
        if table is DEPARTURES_TABLE:
            raise RuntimeError("lost")
        return write(self, df, table, **kw)

    monkeypatch.setattr(Warehouse, "write", failing)
    with pytest.raises(RuntimeError):
        replace_code_in(wh)
    monkeypatch.undo()
    assert wh.state() == before and {t.name: rows(wh.read(t)) for t in TABLES} == old
    # A reader that resolved its state before the switch keeps seeing the old rows.
    early = {t.name: wh.read(t, state=before) for t in TABLES}
    counts = replace_code_in(wh)
    assert {n: rows(df) for n, df in early.items()} == old
    plain = replace_code(registry.flights(spark, SF_SMALL), registry.airtime(spark, SF_SMALL),
                         registry.departures(spark, SF_SMALL))
    new = {"flights": plain.flights, "flights_airtime": plain.flights_airtime, "airport_departures": plain.airport_departures}
    assert {t.name: rows(wh.read(t)) for t in TABLES} == {n: rows(df) for n, df in new.items()}
    assert rows(counts) == rows(plain.counts)
    assert wh.state().sequence == before.sequence + 1
    again = wh.state()
    assert {r.matched_rows for r in replace_code_in(wh).collect()} == {0} and wh.state() == again


def test_second_writer_of_one_state_is_refused(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    base = wh.create(*TABLES)
    wh.commit(base, {})
    with pytest.raises(CommitConflict):
        wh.commit(base, {})


def test_replacement_rewrites_touched_files_only(spark, scratch):
    wh = Warehouse(spark, scratch("wh"))
    dep = registry.departures(spark, SF_SMALL).withColumn("dest", F.when(F.col("origin") == "JFK", "LAX").otherwise(F.col("dest")))
    dep = dep.filter(F.col("origin").isin("BOS", "JFK", "SEA"))
    wh.create(*TABLES)
    wh.replace({DEPARTURES_TABLE: dep})
    before = wh.state()
    replace_code_in(wh)
    old, new = wh.partitions(DEPARTURES_TABLE, before), wh.partitions(DEPARTURES_TABLE)
    assert set(old) == {"BOS", "JFK", "SEA"} and set(new) == {"TST", "JFK", "SEA"}
    assert new["JFK"] == old["JFK"] and new["SEA"] != old["SEA"]  # no flight from JFK goes to BOS
    added = [x for x in wh.state().tables["airport_departures"] if x not in before.tables["airport_departures"]][-1]
    size = lambda names: sum(os.path.getsize(f"{wh.root}/airport_departures/{n}") for n in names)
    assert size(f"{added.path}/{f}" for f in added.files) < 0.9 * size(f for fs in old.values() for f in fs)
    assert wh.read(DEPARTURES_TABLE).filter("origin = 'BOS' or dest = 'BOS'").count() == 0


def test_dropped_partition_reads_nothing_and_can_be_looked_up_before(spark):
    wh = registry.warehouse(spark, SF_SMALL)
    before = wh.state()
    wh.drop_partition(DEPARTURES_TABLE, "BOS")
    assert "BOS" not in wh.partitions(DEPARTURES_TABLE)
    assert wh.read(DEPARTURES_TABLE).filter("origin = 'BOS'").count() == 0
    assert wh.read(DEPARTURES_TABLE, state=wh.state(before.sequence)).filter("origin = 'BOS'").count() > 0
    now = wh.state()
    assert wh.drop_partition(DEPARTURES_TABLE, "none") == now


def test_origin_filter_still_prunes_directories(spark):
    wh = registry.warehouse(spark, SF_SMALL)
    df = wh.read(DEPARTURES_TABLE).filter("origin = 'HNL'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(origin" in plan
    assert {f.split("origin=")[1].split("/")[0] for f in df.inputFiles()} >= {"HNL"}


def test_small_delta_rewrites_few_files(spark, scratch):
    (orders,) = registry.read_tables(spark, SF_SMALL, "orders")
    wh, table = Warehouse(spark, scratch("wh")), registry.orders_table(orders)
    wh.replace({table: orders.repartitionByRange(8, "o_orderkey")})
    # As if eight loads had each written a range.
    least = orders.agg(F.min("o_orderkey")).first()[0]
    parts = [wh.write(orders.filter(F.col("o_orderkey") % 8 == k), table) for k in range(8)]
    wh.commit(wh.state(), {"orders": parts})
    before = {f"{x.path}/{f}" for x in wh.state().tables["orders"] for f in x.files}
    delta = spark.createDataFrame([(least, "Z"), (-5, "N")], "o_orderkey long, o_orderstatus string")
    upsert_into(wh, table, delta)
    after = {f"{x.path}/{f}" for x in wh.state().tables["orders"] for f in x.files}
    assert len(before - after) == 1 and len(before) >= 8
    got = {r.o_orderkey: r for r in wh.read(table).collect()}
    assert got[least].o_orderstatus == "Z" and got[-5].o_orderstatus == "N" and got[-5].o_totalprice is None
    assert len(got) == orders.count() + 1
    state = wh.state()
    assert upsert_into(wh, table, delta.limit(0)) == state


def test_bucketed_upsert_shuffles_the_delta_only(spark, scratch):
    (orders,) = registry.read_tables(spark, SF_SMALL, "orders")
    path = scratch("bucketed")
    write_bucketed(orders, "orders_b1", path, ["o_orderkey"], 4)
    again = open_bucketed(spark, "orders_b2", path, orders.schema, ["o_orderkey"], 4)
    from tarmac.operators.keyed import upsert
    plan = upsert(again, registry.upsert_delta(orders), ["o_orderkey"], max_broadcast_rows=0
                  )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    out = upsert_bucketed(again, registry.upsert_delta(orders), ["o_orderkey"], "orders_b3", scratch("bucketed"), 4)
    assert rows(out.select("o_orderkey", "o_orderstatus")) == rows(
        upsert(orders, registry.upsert_delta(orders), ["o_orderkey"]).select("o_orderkey", "o_orderstatus"))


def test_listing_skips_hidden_files(spark, scratch):
    path = scratch("hidden")
    os.makedirs(f"{path}/_x")
    for n in ("a.parquet", ".b", "_x/c"):
        open(f"{path}/{n}", "w").close()
    assert Warehouse(spark, path)._listed(path) == ["a.parquet"]
    assert w.without((w.Layer("l", ("p=a%20b/f", "g")),), ["l/p=a b/f"]) == (w.Layer("l", ("g",)),)
