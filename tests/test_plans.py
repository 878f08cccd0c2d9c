"""Physical-plan checks: the plans we want at scale, not only the right rows."""

from support import SF_SMALL
from tarmac.operators.keyed import dedupe_keys, upsert
from tarmac.plans import insights, jobs, registry
from tarmac.schema import DEPARTURES_TABLE, FLIGHTS_TABLE
from tarmac.sources.files import read_table, write_table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrichment_broadcasts_dimension_and_never_shuffles_flights(spark):
    plan = _plan(registry.enriched(spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_dimension_above_bound_is_not_broadcast(spark):
    from tarmac.operators.enrich import enrich_flights
    from tarmac.sources.fixtures import load_fixture
    raw, ap = load_fixture(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(enrich_flights(raw, ap, max_broadcast_rows=1))
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_topk_and_partial_aggregation(spark):
    plan = _plan(registry.q05(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan
    assert "partial_count" in plan


def test_dedupe_combines_map_side(spark):
    (li,) = registry.read_tables(spark, SF_SMALL, "lineitem")
    plan = _plan(dedupe_keys(li, ["l_orderkey", "l_linenumber"]))
    assert "partial_min" in plan


def test_small_delta_upsert_does_not_shuffle_base(spark):
    (orders,) = registry.read_tables(spark, SF_SMALL, "orders")
    plan = _plan(upsert(orders, registry.upsert_delta(orders), ["o_orderkey"]))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_stored_departures_prune_and_push_down(spark, scratch):
    root = scratch("pruning")
    v = jobs.Version(root, 1)
    write_table(registry.flights(spark, SF_SMALL), v.path(FLIGHTS_TABLE), FLIGHTS_TABLE)
    jobs.downstream(spark, v, v)
    dep = read_table(spark, v.path(DEPARTURES_TABLE), DEPARTURES_TABLE)
    q1 = insights.departures_on_day(dep)
    plan = _plan(q1)
    assert "PartitionFilters: [isnotnull(origin" in plan and "(origin" in plan and "HNL" in plan
    assert "PushedFilters: [IsNotNull(dep_time), GreaterThanOrEqual(dep_time" in plan
    assert "ReadSchema: struct<dep_time:timestamp" in plan
    q2 = insights.codes_with_prefix(dep)
    plan2 = _plan(q2)
    # origin is the directory partition column: the prefix prunes directories.
    assert "PartitionFilters: [isnotnull(origin" in plan2 and "StartsWith(origin" in plan2


def test_partitioned_write_uses_adaptive_rebalance(spark):
    from tarmac.operators.derive import airport_departures
    dep = airport_departures(registry.flights(spark, SF_SMALL))
    out = dep.hint("rebalance", *DEPARTURES_TABLE.partition_by).sortWithinPartitions("origin", "dep_time", "id")
    plan = _plan(out)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert spark.conf.get("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled") == "true"


def test_question_filters_stay_small(spark):
    # Filters on computed instants must not be copied into the conversion expressions
    # (the generated code would outgrow the compiler and fall back to slow paths).
    for fn in (registry.q01, registry.q03, registry.q05, registry.q06, registry.q08):
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        longest = max((len(line) for line in plan.split("\n") if "Filter" in line), default=0)
        assert longest < 5000, (fn.__name__, longest)
