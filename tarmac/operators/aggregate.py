"""Counting, grouping and top-k helpers (A-01..A-07, O-01..O-05).

All return DataFrames; nothing is pulled to the driver. Grouped counts are planned
as partial + final hash aggregation around one exchange (map-side combine), so a key
holding a third of the rows is pre-counted in every task before the shuffle. Top-k
is ``orderBy(...).limit(k)``, which Spark plans as ``TakeOrderedAndProject`` (a
per-task bounded heap) instead of a global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A-01 as a one-row DataFrame (lazy, unlike ``df.count()``)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias(name))


def grouped_count(df: DataFrame, keys: Sequence[str | Column], counted: str | None = None,
                  name: str = "count") -> DataFrame:
    """A-02/A-03/A-04: count of non-null ``counted`` (or rows) per group."""
    what = F.col(counted) if counted else F.lit(1)
    return df.groupBy(*keys).agg(F.count(what).cast("long").alias(name))


def distinct_count(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """A-06: number of distinct non-null values (one row)."""
    return df.agg(F.countDistinct(F.col(column)).cast("long").alias(name))


def top_k(df: DataFrame, k: int, by: str, tie: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """O-01/O-02/O-03/O-05: the first ``k`` rows by ``by`` with a deterministic tie-break."""
    primary = F.col(by).desc() if descending else F.col(by).asc()
    return df.orderBy(primary, *[F.col(t).asc() for t in tie]).limit(k)
