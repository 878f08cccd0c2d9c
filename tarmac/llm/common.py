"""Helpers shared by the operators: table access, staging, running sums, components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.session import scratch_path

# Words are maximal runs of anything but ASCII white space (Java and RE2 syntax).
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session told to hand rows to Python in batches bounded by bytes:
    long texts would otherwise make batches, and off-heap buffers, of tens of megabytes."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))
    return df


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: computed once, its
    lineage cut, and safe against lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` plus columns that are computed once per row: as generated columns they are
    not copied into every expression that reads them."""
    for name, value in columns.items():
        df = df.select("*", F.explode(F.array(value)).alias(name))
    return df


# Most ids sent to every task by :func:`keep_ids` (8 bytes each, a few tens of MB hashed).
BROADCAST_IDS = 1_000_000


def keep_ids(df: DataFrame, key: Column, ids: DataFrame, ids_col: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (``left_anti``: is not) in ``ids``. The ids are counted
    first: up to ``BROADCAST_IDS`` they go to the rows and ``df`` is not shuffled, beyond
    it both sides are. The result is the same either way."""
    ids = staged(ids.select(ids_col), "ids")
    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, key == ids[ids_col], how)


def chunk_rows(n: int, least: int = 512) -> int:
    """Rows per chunk of a two-level running sum: about the square root of all rows, so
    neither a chunk nor the list of chunks of one group grows out of a task."""
    return max(least, math.isqrt(max(n, 1)))


def running_sum(df: DataFrame, group: list[str], chunk: str, order: list[str],
                value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one in its group.

    A group may hold any share of the rows, so no window spans a whole group: rows are
    summed inside (group, chunk), the chunk totals are summed over the group's chunks,
    and both are added. ``chunk`` must rise along ``order`` inside a group.
    """
    keys = [*group, chunk]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    chunks = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    totals = totals.select(*keys, F.coalesce(F.sum("_total").over(chunks), F.lit(0)).alias("_base"))
    summed = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (summed.join(totals, keys)
            .withColumn(out, F.col("_base") + F.col("_inside")).drop("_base", "_inside"))


def ranked(df: DataFrame, group: list[str], order: list[str], at: str = "at", size: str = "size",
           keep: list[str] | None = None) -> DataFrame:
    """Adds ``at``, a row's place (from 0) in its group along ``order`` (nulls first), and
    ``size``, the group's rows. Rows equal in all of ``order`` are told apart by their
    place in the input, which should be a stored table. ``keep``: the columns to return
    (all; those of ``group`` must be among them).

    A group may hold any share of the rows, so no window spans one: all rows are dealt by
    ranges of (group, order), numbered inside their range, and moved by the rows that
    earlier ranges have of the group. Windows only see one row per range and group.
    """
    keys = [*group, *order, "_row"]
    dealt = (df.withColumn("_row", F.monotonically_increasing_id())
             .repartitionByRange(*keys).sortWithinPartitions(*keys))
    keep = keep or df.columns
    dealt = staged(dealt.select(*keep, F.spark_partition_id().alias("_part"),
                                F.monotonically_increasing_id().alias("_mid")), "ranked")
    runs = dealt.groupBy(*group, "_part").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*[F.col(g) for g in group] or [F.lit(0)])
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_part").alias("_run"),
                       (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                       F.sum("_rows").over(whole).alias(size))
    same = reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group],
                  F.col("_part") == F.col("_run"))
    return dealt.join(runs, same).select(*keep, (F.col("_mid") + F.col("_shift")).alias(at), size)


# Most edges, and bytes of them, that a task of :func:`components` joins at once.
BLOCK_EDGES, BLOCK_BYTES = 1 << 18, 16 << 20


def _stars(edges: pa.Table) -> pa.Table:
    """Edges (a, b) that join what ``edges`` join: each node and the smallest node of its
    component in ``edges``; a node that is joined with nothing and itself."""
    nodes = pa.chunked_array(edges["a"].chunks + edges["b"].chunks, edges["a"].type).unique()
    nodes = nodes.take(pc.sort_indices(nodes))
    x, y = (pc.index_in(edges[c], nodes).to_numpy() for c in ("a", "b"))
    own = np.arange(len(nodes))
    root = own.copy()
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    joined = np.bincount(root, minlength=len(nodes))[root] > 1
    kept = np.flatnonzero((root != own) | ~joined)
    return pa.table({"a": nodes.take(pa.array(kept)), "b": nodes.take(pa.array(root[kept]))})


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, rows, size = [], 0, 0
    for batch in batches:
        block.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= BLOCK_EDGES or size >= BLOCK_BYTES:
            yield from _stars(pa.Table.from_batches(block)).to_batches()
            block, rows, size = [], 0, 0
    if rows:
        yield from _stars(pa.Table.from_batches(block)).to_batches()


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """Connected components of an undirected graph, stored: (node, component), the component
    being its smallest node; only nodes of ``edges`` appear. Null ends are ignored.

    Every round joins the edges of bounded blocks inside the tasks, so a node keeps at most
    one edge to a smaller node for each block. While these stars don't fit together, the
    large-star and small-star steps follow (a logarithmic number of rounds, also on long
    chains). A hub's edges are never gathered: smallest neighbours are a map-side combined
    minimum and a join, whose hot keys the adaptive planner may split; what is brought
    together by a node is its edges to smaller nodes, at most one for each block.
    """
    e = (edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
         .filter("a is not null and b is not null"))
    while True:
        e = staged(e.mapInArrow(_contracted, e.schema), "components")  # a >= b
        ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        near = staged(e.select(F.explode(ends).alias("e")).select("e.*").groupBy("a").agg(
            F.min("b").alias("lo"), F.max(F.expr("if(a <> b, b, null)")).alias("hi")), "components-near")
        # Done when every node has one smaller neighbour and no other, or larger ones only.
        if near.filter("lo < a and lo <> hi").isEmpty():
            return near.select(F.col("a").alias("node"), F.least("a", "lo").alias("component"))
        lower = near.filter("lo < a").select(F.col("a").alias("_node"), "lo")
        large = e.join(lower, F.col("b") == F.col("_node"), "left").select("a", F.coalesce("lo", "b").alias("b"))
        small = large.withColumn("m", F.min("b").over(Window.partitionBy("a")))
        ends = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        e = staged(small.select(F.explode(ends).alias("e")).select("e.*"), "components")


def native_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """As :func:`components`, by DataFrame operations only, for operators without Python tasks;
    not stored.

    Alternates the large-star and small-star steps until the edge set stops changing
    (a logarithmic number of rounds, also on long chains). A hub's edges are never
    gathered: each step is a map-side combined minimum per node and a join, whose hot
    keys the adaptive planner may split. Every round is stored.
    """
    e = (edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
         .filter("a is not null and b is not null"))
    nodes = e.select(F.col("a").alias("node")).union(e.select(F.col("b").alias("node"))).distinct()
    e = e.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = staged(e, "components")
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == seen:
            break
        seen = state
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.filter("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.least("m", "a").alias("b")).filter("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        e = staged(small, "components")
    roots = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    return (nodes.join(roots, "node", "left")
            .select("node", F.coalesce("m", "node").alias("component")))
