"""Incremental load: same rows as the batch enrichment; the checkpoint makes reruns
exactly-once (already-seen files are not read again, new files are)."""

from pyspark.sql import functions as F

from support import SF_SMALL
from tarmac.operators.enrich import enrich_flights
from tarmac.schema import ENRICHED_TABLE
from tarmac.sources.files import write_flights_csv
from tarmac.sources.fixtures import load_fixture
from tarmac.streaming import incremental_load


def test_incremental_load_resumes_from_checkpoint(spark, scratch):
    raw, airports = load_fixture(spark, SF_SMALL)
    src, out, ckpt = scratch("in"), scratch("out"), scratch("ckpt")
    first = raw.filter(F.col("ID") % 2 == 0)
    write_flights_csv(first, src + "/batch=1")
    incremental_load(spark, src + "/*", airports, out, ckpt).awaitTermination()
    read = lambda: spark.read.schema(ENRICHED_TABLE.schema).parquet(out)
    assert read().count() == first.count()
    incremental_load(spark, src + "/*", airports, out, ckpt).awaitTermination()
    assert read().count() == first.count()
    write_flights_csv(raw.filter(F.col("ID") % 2 == 1), src + "/batch=2")
    incremental_load(spark, src + "/*", airports, out, ckpt).awaitTermination()
    got, want = read(), enrich_flights(raw, airports)
    assert got.count() == raw.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
