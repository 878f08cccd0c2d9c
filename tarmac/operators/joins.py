"""Dimension joins with a checked broadcast.

A side is broadcast only after its row count has been measured against a bound;
above the bound the join is left to a shuffle (sort-merge) join, so a dimension that
grows unexpectedly never overloads the driver or executor memory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension (rows) broadcast to every task. An airport/zone lookup row is
# about 40 bytes, so this bound keeps a broadcast well under 100 MB.
BROADCAST_MAX_ROWS = 2_000_000


# Largest side sent to every task, by its schema's row width (tens of bytes to Spark's
# own estimate of a row; see ``fits_broadcast``).
BROADCAST_MAX_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, rows: int, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether ``rows`` rows of ``df`` stay within the row and the byte bound."""
    width = 16 + df._jdf.schema().defaultSize()
    return rows <= max_rows and rows * width <= BROADCAST_MAX_BYTES


@dataclass(frozen=True)
class DimensionStats:
    rows: int
    distinct_keys: int

    @property
    def duplicated_keys(self) -> int:
        return self.rows - self.distinct_keys


def dimension_stats(dim: DataFrame, key: str) -> DimensionStats:
    """One small aggregation over the dimension: row count and distinct key count."""
    row = dim.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.col(key)).alias("k")).first()
    return DimensionStats(int(row["n"]), int(row["k"]))


def checked_broadcast(dim: DataFrame, rows: int, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only when the measured rows are within ``max_rows`` and the byte bound."""
    return F.broadcast(dim) if fits_broadcast(dim, rows, max_rows) else dim


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (the multiplicity check behind C-07)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))
