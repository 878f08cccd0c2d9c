"""Readers and writers.

S-01 flight CSV (explicit schema, no header, ``yyyy/MM/dd`` dates, no inference)
S-02 airport CSV (header, declared schema)
S-03 generic CSV via ``format("csv").load``
S-04/S-05 stored-table scan (Parquet; column lists prune the scan)
S-06/S-07/S-08 keyed full-replace write of a new table version (upserts are computed
          as DataFrames by ``operators.keyed`` and then written here)
S-09 CSV export with header — distributed by default; single file only for small results
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.schema import AIRPORTS, FLIGHTS_RAW, KeyedTable
from tarmac.session import scratch_path

FLIGHT_DATE_FORMAT = "yyyy/MM/dd"


def read_flights_csv(spark: SparkSession, path: str, date_format: str = FLIGHT_DATE_FORMAT,
                     mode: str = "PERMISSIVE") -> DataFrame:
    """S-01. A date not matching the pattern becomes null and the row is kept (PERMISSIVE)."""
    return (spark.read.schema(FLIGHTS_RAW)
            .option("header", "false").option("sep", ",")
            .option("dateFormat", date_format).option("mode", mode)
            .csv(path))


CORRUPT = "_corrupt_record"


def read_flights_csv_checked(spark: SparkSession, path: str, date_format: str = FLIGHT_DATE_FORMAT
                             ) -> tuple[DataFrame, DataFrame]:
    """S-01 with bad-record accounting: (flights, rejects). A line that does not fit the
    schema goes to the rejects as (id, reason, line), reason being ``columns`` (too few or
    too many), ``date`` or ``value``; ``id`` is its first field where that is a number.

    The file is parsed once, whole rows with their verdicts, into the shared scratch folder;
    both frames read that copy."""
    schema = T.StructType([*FLIGHTS_RAW.fields, T.StructField(CORRUPT, T.StringType(), True)])
    df = (spark.read.schema(schema).option("header", "false").option("sep", ",")
          .option("dateFormat", date_format).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return split_rejects(materialize(df, scratch_path(spark, "parsed-csv")), date_format)


def split_rejects(scanned: DataFrame, date_format: str = FLIGHT_DATE_FORMAT) -> tuple[DataFrame, DataFrame]:
    """Rows of a scan with the corrupt-record column as (good rows, rejects)."""
    n, names = len(scanned.columns) - 1, [c for c in scanned.columns if c != CORRUPT]
    fields = F.from_csv(F.col(CORRUPT), F.lit(", ".join(f"f{i} STRING" for i in range(n + 1))))
    commas = F.length(F.regexp_replace(F.regexp_replace(CORRUPT, '"[^"]*"', ""), "[^,]", ""))
    day = F.col("_f")[f"f{names.index('FL_DATE')}"]
    reason = (F.when(commas != n - 1, "columns")
              .when(day.isNotNull() & F.try_to_timestamp(day, F.lit(date_format)).isNull(), "date").otherwise("value"))
    bad = scanned.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, fields.alias("_f"))
    rejects = bad.select(F.col("_f.f0").try_cast("long").alias("id"), reason.alias("reason"), F.col(CORRUPT).alias("line"))
    return scanned.filter(F.col(CORRUPT).isNull()).select(*names), rejects


def read_airports_csv(spark: SparkSession, path: str, reject_null_iata: bool = True) -> DataFrame:
    """S-02 (+P-14). Declared schema instead of inference; null IATA rows rejected."""
    df = (spark.read.schema(AIRPORTS)
          .option("header", "true").option("sep", ",")
          .csv(path))
    return df.filter(F.col("IATA").isNotNull()) if reject_null_iata else df


def read_csv(spark: SparkSession, path: str, header: bool = False, infer_schema: bool = True,
             sep: str = ",") -> DataFrame:
    """S-03. Inference costs an extra pass over the data; prefer a declared schema."""
    return (spark.read.format("csv").option("header", str(header).lower())
            .option("inferSchema", str(infer_schema).lower()).option("sep", sep).load(path))


def write_flights_csv(df: DataFrame, path: str, date_format: str = FLIGHT_DATE_FORMAT) -> None:
    """Write a raw-flight DataFrame in the S-01 file format (no header), one file per task."""
    (df.select(*FLIGHTS_RAW.fieldNames()).write.mode("errorifexists")
     .option("header", "false").option("dateFormat", date_format).csv(path))


def write_airports_csv(df: DataFrame, path: str) -> None:
    """Write an airport DataFrame in the S-02 file format (with header)."""
    df.select(*AIRPORTS.fieldNames()).write.mode("errorifexists").option("header", "true").csv(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """S-09. CSV with header, one file per task. ``single_file`` shuffles the finished
    rows to one writing task; everything before that write stays parallel."""
    out = df.repartition(1) if single_file else df
    out.write.mode("errorifexists").option("header", "true").csv(path)


def table_path(root: str, table: KeyedTable | str, version: int | str) -> str:
    """Location of one version of a stored table: ``<root>/<name>/v=<version>``.

    Every write makes a new version; a job never overwrites the path it is reading.
    """
    name = table.name if isinstance(table, KeyedTable) else table
    return f"{root.rstrip('/')}/{name}/v={version}"


def read_table(spark: SparkSession, path: str, table: KeyedTable,
               columns: list[str] | None = None) -> DataFrame:
    """S-04/S-05. Parquet scan with the declared schema (partition columns keep their
    declared type and position); ``columns`` narrows the ``ReadSchema``."""
    df = spark.read.schema(table.schema).parquet(path).select(*table.columns)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, table: KeyedTable,
                observe: tuple | None = None, keep_layout: bool = False) -> None:
    """S-06/S-08/S-10. Write one full version of a keyed table with its layout.

    Directory-partitioned tables (``partition_by``) go through an adaptive
    ``rebalance`` on the partition columns: AQE sizes the write tasks from the
    shuffle's runtime statistics, splitting a hot value (one origin holding a third
    of all rows) across many tasks and merging small ones, so files stay evenly
    sized without a sampling pass over the input. Rows are then sorted within each
    task by (partition, clustering) columns: few files per directory, clustering
    order inside each file (min/max row-group skipping on range filters). Tables
    without directory partitioning are dealt by ranges of their clustering columns, so a
    lookup opens the files of one range and a hot value of the first column can be split.
    ``keep_layout``: ``df`` is a narrow change of a stored table, whose distribution stays
    (no sampling pass, no shuffle; rows are only sorted inside each task). ``observe`` =
    (Observation, *metric columns) collects row metrics during the write itself.
    """
    out = df.select(*table.columns)
    if table.partition_by:
        out = out.hint("rebalance", *table.partition_by)
    elif table.cluster_by and not keep_layout:
        out = out.repartitionByRange(*table.cluster_by)
    order = list(table.partition_by) + list(table.cluster_by)
    if order:
        out = out.sortWithinPartitions(*order)
    if observe:
        observation, *metrics = observe
        out = out.observe(observation, *metrics)
    writer = out.write.mode("errorifexists")
    if table.partition_by:
        writer = writer.partitionBy(*table.partition_by)
    writer.parquet(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once as Parquet under ``path`` (a shared folder) and read it back.

    The lineage cut for results used by several downstream queries: later filters run
    against the stored columns instead of being pushed into (and re-evaluating) the
    expressions that produced them, and a lost executor recomputes nothing upstream.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
