"""Benchmark: the three batch programs plus the registered operators at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) and
prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.

Timed steps, in pipeline order:
  load          raw flight CSV + airport CSV -> enriched, deduplicated ``flights`` (Parquet)
  downstream    flights -> airport_departures (partitioned by origin) + flights_airtime
  q01..q06      the questions over the stored tables (results collected: a few rows)
  q04_replace   the six-step code replacement, writing three new table versions
  q08, dq_*     the delay audit and the eight checks over the staging table ``load`` wrote
  enrich_utc, unmatched_airports, pk_dedupe, upsert_partial[_shuffle]
                registered queries from the raw tables to a no-op sink (no collect)
The CSV inputs are generated from the driver's tables before timing starts. Set
BENCH_EVENT_LOG=<folder> to also write Spark's event log (per-stage and per-task times).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarmac.operators import quality  # noqa: E402
from tarmac.plans import insights, jobs, registry  # noqa: E402
from tarmac.session import build_session, scratch_path  # noqa: E402
from tarmac.sources.files import write_airports_csv, write_flights_csv  # noqa: E402
from tarmac.sources.fixtures import load_fixture  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": "64m"}
    event_log = os.environ.get("BENCH_EVENT_LOG")  # optional: stage/task times, no UI
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    probe = build_session(f"local[{cpus}]", app="tarmac-bench", shuffle_partitions=cpus * 2,
                          extra=extra)
    if not probe.sparkContext.getConf().get("spark.checkpoint.dir", None):
        os.environ.setdefault("TARMAC_SCRATCH", tempfile.mkdtemp(prefix="tarmac-bench-"))
    spark = probe
    spark.sparkContext.setLogLevel("ERROR")

    raw, airports = load_fixture(spark, sf_dir)
    flights_csv, airports_csv = scratch_path(spark, "bench-flights-csv"), scratch_path(spark, "bench-airports-csv")
    write_flights_csv(raw, flights_csv)
    write_airports_csv(airports, airports_csv)
    root = scratch_path(spark, "bench-warehouse")
    v1, v2 = jobs.Version(root, 1), jobs.Version(root, 2)

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t, 3)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    timed("load", lambda: jobs.load(spark, flights_csv, airports_csv, v1))
    timed("downstream", lambda: jobs.downstream(spark, v1, v1))
    for name, df in jobs.questions(spark, v1, v1).items():
        timed(name, df.collect)
    timed("q04_replace", lambda: jobs.replace_airport_code(spark, v1, v1, v2).collect())
    staged = jobs.enriched_table(spark, v1)
    checks = {
        "q08_delay_audit": insights.delay_audit,
        "dq_elapsed_eq_air": quality.elapsed_equals_air,
        "dq_elapsed_lt_air": quality.elapsed_below_air,
        "dq_arr_before_dep_raw": quality.arrival_not_after_departure_raw,
        "dq_arr_before_dep_fixed": quality.arrival_not_after_departure,
        "dq_short_flights": quality.short_flights,
        "dq_duration_mismatch": quality.duration_mismatch,
        "dq_day_mismatch": quality.day_of_month_mismatch,
    }
    for name, check in checks.items():
        timed(name, lambda check=check: noop(check(staged)))
    for name in ["enrich_utc", "unmatched_airports", "pk_dedupe", "upsert_partial",
                 "upsert_partial_shuffle"]:
        fn = registry.QUERIES[name]
        timed(name, lambda fn=fn: noop(fn(spark, sf_dir)))

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
