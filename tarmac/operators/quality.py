"""C-01..C-09: data-quality checks. Each returns the offending rows (a filter over the
enriched flight frame of ``operators.enrich.enrich_flights``), so they push down and
run distributed; sort only where the check itself is an ordered listing (C-06).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.clock import HOUR_MS, elapsed_minutes

# The columns every check reports, lower-cased.
AUDIT_COLUMNS = {
    "id": "ID", "fl_date": "FL_DATE", "day_of_month": "DAY_OF_MONTH",
    "origin": "ORIGIN", "dest": "DEST", "dep_time": "DEP_TIME", "arr_time": "ARR_TIME",
    "origin_timezone_code": "ORIGIN_TIMEZONE_CODE", "dest_timezone_code": "DEST_TIMEZONE_CODE",
    "dep_time_utc_ms": "DEP_TIME_UTC_MS", "arr_time_utc_ms_tmp": "ARR_TIME_UTC_MS_TMP",
    "arr_time_utc_ms": "ARR_TIME_UTC_MS", "actual_elapsed_time": "ACTUAL_ELAPSED_TIME",
    "air_time": "AIR_TIME",
}


def audit_view(enriched: DataFrame) -> DataFrame:
    return enriched.select(*[F.col(src).alias(dst) for dst, src in AUDIT_COLUMNS.items()])


def elapsed_equals_air(enriched: DataFrame) -> DataFrame:
    """C-01: elapsed time equals air time (no taxi time: invalid record)."""
    return audit_view(enriched).filter(F.col("actual_elapsed_time") == F.col("air_time"))


def elapsed_below_air(enriched: DataFrame) -> DataFrame:
    """C-02: elapsed time shorter than air time."""
    return audit_view(enriched).filter(F.col("actual_elapsed_time") < F.col("air_time"))


def arrival_not_after_departure_raw(enriched: DataFrame) -> DataFrame:
    """C-03: arrival instant not after departure, before the arrival repair."""
    return audit_view(enriched).filter(F.col("arr_time_utc_ms_tmp") <= F.col("dep_time_utc_ms"))


def arrival_not_after_departure(enriched: DataFrame) -> DataFrame:
    """C-04: the same after the repair, among rows with elapsed != air time."""
    v = audit_view(enriched)
    return v.filter((F.col("arr_time_utc_ms") <= F.col("dep_time_utc_ms"))
                    & (F.col("actual_elapsed_time") != F.col("air_time")))


def short_flights(enriched: DataFrame, below_ms: int = HOUR_MS) -> DataFrame:
    """C-05: repaired duration under one hour."""
    v = audit_view(enriched)
    return v.filter((F.col("arr_time_utc_ms") - F.col("dep_time_utc_ms")) < below_ms)


def duration_mismatch(enriched: DataFrame, exclude_elapsed: int | None = None) -> DataFrame:
    """C-06: elapsed minutes differ from the clock difference before repair, ordered by
    that difference (descending). ``exclude_elapsed`` drops one elapsed value."""
    v = audit_view(enriched).withColumn(
        "diff_mins", elapsed_minutes("arr_time_utc_ms_tmp", "dep_time_utc_ms"))
    cond = F.col("actual_elapsed_time") != F.col("diff_mins")
    if exclude_elapsed is not None:
        cond = cond & (F.col("actual_elapsed_time") != exclude_elapsed)
    return v.filter(cond).orderBy(F.col("diff_mins").desc(), F.col("id").asc())


def day_of_month_mismatch(enriched: DataFrame) -> DataFrame:
    """C-08: the day-of-month field disagrees with the flight date."""
    v = audit_view(enriched)
    return v.filter(F.dayofmonth("fl_date") != F.col("day_of_month"))


def spot_check(enriched: DataFrame, **equals) -> DataFrame:
    """C-09: rows matching every ``column=value`` given (lower-case audit names), e.g.
    ``origin_timezone_code="Pacific/Guam", dest_timezone_code="Pacific/Honolulu"``."""
    v = audit_view(enriched)
    for col, value in equals.items():
        v = v.filter(F.col(col) == F.lit(value))
    return v


# Name of each check and its condition over the columns of :func:`audit_view`.
CHECKS = {
    "elapsed_eq_air": "actual_elapsed_time = air_time",
    "elapsed_lt_air": "actual_elapsed_time < air_time",
    "arr_before_dep_raw": "arr_time_utc_ms_tmp <= dep_time_utc_ms",
    "arr_before_dep_fixed": "arr_time_utc_ms <= dep_time_utc_ms AND actual_elapsed_time <> air_time",
    "short_flight": f"arr_time_utc_ms - dep_time_utc_ms < {HOUR_MS}",
    "duration_mismatch": "actual_elapsed_time <> (arr_time_utc_ms_tmp - dep_time_utc_ms) / 60000",
    "day_mismatch": "dayofmonth(fl_date) <> day_of_month",
    "origin_unmatched": "origin_timezone_code IS NULL",
    "dest_unmatched": "dest_timezone_code IS NULL",
}


def exceptions(enriched: DataFrame) -> DataFrame:
    """C-01..C-08 in one scan: a row (check_name and the audit columns) per failed check.
    Each row is tagged with the checks it fails before it is multiplied, so clean rows (and
    all their columns but the tested ones) never leave the scan's stage."""
    v = audit_view(enriched)
    tags = F.array_compact(F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in CHECKS.items()]))
    failed = v.withColumn("_failed", tags).filter(F.size("_failed") > 0)
    return failed.select(F.explode("_failed").alias("check_name"), *v.columns)


def repeated_loads(flights_raw: DataFrame, key: str = "ID") -> DataFrame:
    """Natural-key check: flights that differ in nothing but ``key``, found by a fingerprint
    of all other columns. One row per (copies, id step): how many flights are loaded that
    often at that constant step (null: the ids are not evenly spaced).

    Groups are summed map-side (count, least, greatest, sums of distances and squares), so
    a flight repeated any number of times is never gathered."""
    rest = [c for c in flights_raw.columns if c != key]
    spelled = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"),
                                   F.col(c).cast("string")), F.lit("-")) for c in rest]
    prints = flights_raw.select(F.col(key).cast("decimal(38,0)").alias("k"), F.sha2(F.concat(*spelled), 256).alias("print"))
    groups = prints.groupBy("print").agg(F.count(F.lit(1)).alias("copies"), F.min("k").alias("lo"), F.max("k").alias("hi"),
                                         F.sum("k").alias("s"), F.sum((F.col("k") * F.col("k")).cast("decimal(38,0)")).alias("q"))
    # n evenly spaced ids from lo: their sum and sum of squares are those of lo + i * step.
    groups = groups.filter("copies > 1").selectExpr("copies", "lo", "s", "q", "(hi - lo) div (copies - 1) AS step", "hi")
    even = """step > 0 AND lo + step * (copies - 1) = hi AND 2 * s = copies * (lo + hi)
              AND 6 * q = 6 * copies * lo * lo + 6 * lo * step * copies * (copies - 1)
                          + step * step * (copies - 1) * copies * (2 * copies - 1)"""
    return (groups.select("copies", F.expr(f"CASE WHEN {even} THEN step END").cast("long").alias("id_step"))
            .groupBy("copies", "id_step").agg(F.count(F.lit(1)).alias("flights")))


def layout_check(rows: DataFrame, table_name: str, order: list[str], ranged: bool) -> DataFrame:
    """O-06: the stored order as a checked property, one row: (table_name, rows,
    out_of_order_rows, overlapping_files). ``rows`` is a scan with ``_metadata``; a row is
    out of order if it is below the row before it in its file. ``ranged``: the files'
    ranges must not overlap either. Windows span one file, or one row per file."""
    key = F.struct(*order).alias("key")
    at = rows.select(key, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    in_file = Window.partitionBy("file").orderBy("place")
    at = at.withColumn("wrong", (F.lag("key").over(in_file) > F.col("key")).cast("long"))
    files = at.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.sum("wrong").alias("wrong"),
                                   F.min("key").alias("lo"), F.max("key").alias("hi"))
    across = Window.partitionBy(F.lit(0)).orderBy("lo")
    overlap = (F.lag("hi").over(across) > F.col("lo")) if ranged else F.lit(False)
    files = files.withColumn("overlap", F.coalesce(overlap, F.lit(False)).cast("long"))
    return files.agg(F.lit(table_name).alias("table_name"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                     F.coalesce(F.sum("wrong"), F.lit(0)).alias("out_of_order_rows"),
                     F.coalesce(F.sum("overlap"), F.lit(0)).alias("overlapping_files"))
