"""Incremental load: raw flight CSV files arriving in a folder -> enriched staging rows.

The enrichment operators are plain DataFrame transformations, so they apply to a
streaming DataFrame unchanged: the airport lookup is a static, size-checked,
broadcast side (stream-static join) and every micro-batch is one narrow pipeline.
Progress is tracked in the checkpoint folder (shared storage on a cluster), so a
restarted or failed query resumes without losing or repeating files; the Parquet
sink commits each batch atomically.

No key deduplication across batches: a streaming ``dropDuplicates`` on ``ID`` would
keep every id ever seen in state. The batch ``load`` job applies the primary-key
rule when it builds the ``flights`` table from the staged rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tarmac.operators.enrich import enrich_flights
from tarmac.schema import ENRICHED_TABLE, FLIGHTS_RAW
from tarmac.sources.files import FLIGHT_DATE_FORMAT

# Files picked up per micro-batch; bounds the size of one batch.
MAX_FILES_PER_TRIGGER = 64


def enrich_stream(spark: SparkSession, flights_dir: str, airports: DataFrame,
                  max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, **enrich_options) -> DataFrame:
    """A streaming DataFrame of enriched flights read from CSV files in ``flights_dir``."""
    raw = (spark.readStream.schema(FLIGHTS_RAW)
           .option("header", "false").option("dateFormat", FLIGHT_DATE_FORMAT)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .csv(flights_dir))
    return enrich_flights(raw, airports, **enrich_options)


def incremental_load(spark: SparkSession, flights_dir: str, airports: DataFrame, out_path: str,
                     checkpoint_path: str, available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental load into ``out_path`` (staging layout of the enrichment).

    ``available_now=True`` processes every file present and stops (a scheduled
    catch-up run); otherwise it runs continuously every ``processing_time``.
    """
    enriched = enrich_stream(spark, flights_dir, airports).select(*ENRICHED_TABLE.columns)
    writer = (enriched.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(out_path)
