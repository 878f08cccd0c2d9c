"""op11: prefix trie of conversations in minimal-perfect-hash node tables.

A prefix of ``d`` turns is known by its digest, a hash of running sums of the hashes of
(position, turn): sums can be taken in parallel, so a conversation of any length is never
walked in one task. Each distinct digest is a node; its parent's digest is that of the
prefix without the last turn.

The trie is cut into shards of whole subtrees: a subtree's *top* is the first node on the
way from the root whose subtree holds at most ``SHARD_ROWS`` rows. A shard enumerates its
distinct digests, gives each a slot of a minimal perfect hash (every lookup is verified
against the digest stored in the slot, so a foreign digest, or a collision, finds none),
scatters the counts of its rows into flat numpy arrays by slot, and adds subtree sums up
through the array of parent slots, deepest level first. The nodes above the tops (the
*crown*: the root, and long beginnings that very many conversations share) are counted by
Spark with map-side sums: a top or crown node gives its sum to the prefixes of its
smallest member, one row for each, so every subtree is summed without a walk per level.

Rebuilding (:func:`rebuilt`): conversation ``c`` takes the first ``h`` turns of
``c - c % 5`` and then its own turns after its first ``h``, ``h`` = crc32(c) % 9.

Defined results: rows without a conversation id are no turns; turns are ordered by turn
(null first), then role and text; a null role or text is empty; repeated rows are turns of
their own; a rebuilt conversation without turns is a member of the root alone; a table
without conversations has no nodes. ``%`` keeps the sign of ``c``. Further columns are
ignored. Ids are numbers (text is cast).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import BROADCAST_IDS, keep_ids, ranked, running_sum, staged, table
from tarmac.llm.sqlforms import crc32_sql
from tarmac.llm.tokens import mix

SHARD_ROWS = 200_000  # most rows below a top
CHUNK = 4096          # turns that one window sums; conversation ids in one piece of a list
HEAD, STRIDE = 9, 5   # h = crc32 % HEAD turns come from conversation c - c % STRIDE
LANES = 4
ROOT = hashlib.sha256(":".join(["0"] * (LANES + 1)).encode()).digest()[:16]
NO_IDS = hashlib.sha256(b"").hexdigest()


class NodeTable:
    """Slots 0..m-1 of ``m`` distinct 128-bit digests, by a minimal perfect hash.

    Level by level the digests left are hashed into twice as many cells; those alone in
    their cell stay, and a digest's slot is the rank of its cell among all such cells.
    """

    def __init__(self, digests: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (taken cells, their ranks)
        left, used = digests, 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("digests are not distinct")
            cell = self._cells(left, len(self.levels), 2 * len(left) + 1)
            alone = np.bincount(cell, minlength=2 * len(left) + 1) == 1
            self.levels.append((alone, used + np.cumsum(alone) - 1))
            used += int(alone.sum())
            left = left[~alone[cell]]
        self.digests = np.zeros((used, 2), np.uint64)
        slots = self._slots(digests)
        self.digests[slots] = digests
        if used != len(digests) or (self.slots(digests) < 0).any():
            raise ValueError("digests are not distinct")

    @staticmethod
    def _cells(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = mix(digests[:, 0] + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) ^ digests[:, 1]
        return (mix(h) % np.uint64(size)).astype(np.int64)

    def _slots(self, digests: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(digests), -1, np.int64), np.arange(len(digests))
        for level, (taken, ranks) in enumerate(self.levels):
            cell = self._cells(digests[left], level, len(taken))
            hit = taken[cell]
            slots[left[hit]] = ranks[cell[hit]]
            left = left[~hit]
        return slots

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The verified slot of each digest, -1 for one that is not in the table."""
        slots = self._slots(digests)
        known = slots >= 0
        known[known] = (self.digests[slots[known]] == digests[known]).all(axis=1)
        return np.where(known, slots, -1)


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    """(n, 2) words of a column of 16-byte values."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = b"".join(array.to_pylist())
    return np.frombuffer(flat, np.uint64).reshape(-1, 2)


NODES = ("digest binary, parent binary, is_top boolean, conv_id long, depth long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long")


def _shard(rows: pa.Table) -> pa.Table:
    """The nodes of one shard's rows (conv, d, digest, parent, bytes)."""
    digests = _digests(rows["digest"])
    conv, depth_of, size_of = (rows[c].to_numpy() for c in ("conv", "d", "bytes"))
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    ordered = digests[order]
    first = order[np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1))]
    nodes = NodeTable(digests[first])
    slot, m = nodes.slots(digests), len(first)
    n_convs = np.bincount(slot, minlength=m)
    smallest = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(smallest, slot, conv)
    at = slot[first]
    depth, size, parent = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
    depth[at], size[at] = depth_of[first], size_of[first]
    parent[at] = nodes.slots(_digests(rows["parent"].take(pa.array(first))))
    inner = parent >= 0
    children = np.bincount(parent[inner], minlength=m)
    leaves = (children == 0).astype(np.int64)
    saved = (n_convs - 1) * size
    by_depth = np.argsort(-depth, kind="stable")
    for level in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
        level = level[inner[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    back = np.empty(m, np.int64)
    back[at] = first  # a row of each slot
    return pa.table({
        "digest": rows["digest"].take(pa.array(back)), "parent": rows["parent"].take(pa.array(back)),
        "is_top": pa.array(~inner), "conv_id": pa.array(smallest), "depth": pa.array(depth),
        "parent_conv_id": pa.array(smallest[np.where(inner, parent, 0)], mask=~inner),
        "n_convs": pa.array(n_convs), "n_children": pa.array(children), "n_leaves": pa.array(leaves),
        "saved_tokens": pa.array(saved)})


def head_length(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEAD


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): turns (conv, d, turn, bytes) of the rebuilt conversations with
    their place ``d`` from 1, and (conv, len) of all, turnless ones included."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"),
                                 text.alias("text")).filter("conv is not null")
    spelled = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    turns = turns.select("*", F.unhex(F.substring(F.sha2(spelled, 256), 1, 32)).alias("hash"),
                         F.octet_length("text").cast("long").alias("bytes"))
    placed = staged(ranked(turns, ["conv"], ["turn", "role", "text"], "i", "n", keep=["conv", "hash", "bytes"]),
                    "trie-turns")
    lengths = placed.groupBy("conv").agg(F.max("n").alias("n"))
    convs = lengths.select("conv", "n", head_length(F.col("conv")).alias("h"),
                           (F.col("conv") - F.col("conv") % STRIDE).alias("base"))
    bases = lengths.select(F.col("conv").alias("base"), F.col("n").alias("of_base"))
    taken = F.least("h", F.coalesce("of_base", F.lit(0)))
    convs = (convs.join(bases, "base", "left").select("conv", "base", "h", taken.alias("taken"),
             (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")))
    convs = staged(convs, "trie-convs")
    heads = placed.filter(F.col("i") < HEAD).select(F.col("conv").alias("base"), "i", "hash", "bytes")
    borrowed = (convs.join(heads, "base").filter("i < h")
                .select("conv", (F.col("i") + 1).alias("d"), "hash", "bytes"))
    own = (placed.filter(F.col("i") >= head_length(F.col("conv"))).join(convs, "conv")
           .select("conv", (F.col("taken") + F.col("i") - F.col("h") + 1).alias("d"), "hash", "bytes"))
    return borrowed.unionByName(own), convs.select("conv", "len")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, d, digest, parent, bytes, len), a row per conversation and prefix of 1 turn or more."""
    mark = F.sha2(F.concat(F.concat(F.col("d").cast("string"), F.lit(":")).cast("binary"), "hash"), 256)
    rows = turns.select("conv", "d", "bytes", F.expr(f"d div {CHUNK}").alias("chunk"), mark.alias("mark"))
    lanes = [f"l{k}" for k in range(LANES)]
    rows = rows.select("conv", "d", "bytes", "chunk", *[
        F.conv(F.substring("mark", 8 * k + 1, 8), 16, 10).cast("long").alias(lanes[k]) for k in range(LANES)])
    rows = staged(rows, "trie-marks")
    inside = Window.partitionBy("conv", "chunk").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("*", *[F.sum(x).over(inside).alias(f"s_{x}") for x in lanes])
    # Only conversations of several chunks have sums to carry over.
    long = convs.filter(F.col("len") >= CHUNK).select("conv")
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (rows.join(long, "conv", "left_semi").groupBy("conv", "chunk").agg(*[F.sum(x).alias(x) for x in lanes])
               .select("conv", "chunk", *[F.sum(x).over(earlier).alias(f"c_{x}") for x in lanes]))
    total = [F.col(f"s_{x}") + F.coalesce(F.col(f"c_{x}"), F.lit(0)) for x in lanes]

    def digest(d: Column, sums: list[Column]) -> Column:
        spelled = F.concat_ws(":", d.cast("string"), *[x.cast("string") for x in sums])
        return F.unhex(F.substring(F.sha2(spelled, 256), 1, 32))

    found = summed.join(carried, ["conv", "chunk"], "left").select(
        "conv", "d", digest(F.col("d"), total).alias("digest"),
        digest(F.col("d") - 1, [t - F.col(x) for t, x in zip(total, lanes)]).alias("parent"), "bytes")
    return staged(found.join(convs, "conv"), "trie-rows")


def _flag(rows: DataFrame, crown: DataFrame) -> DataFrame:
    """``rows`` with ``crown``: whether their digest is a crown node's."""
    known = crown.select(F.col("digest").alias("_digest"), F.lit(True).alias("crown"))
    known = F.broadcast(known) if crown.count() <= BROADCAST_IDS else known
    return (rows.join(known, F.col("digest") == F.col("_digest"), "left").drop("_digest")
            .withColumn("crown", F.coalesce("crown", F.lit(False))))


def _stream_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, ids) in order; the hash of each digest's joined ids, in constant memory."""
    now, state = None, None
    for batch in batches:
        done, hashes = [], []
        for digest, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest != now:
                if now is not None:
                    done.append(now)
                    hashes.append(state.hexdigest())
                now, state = digest, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary()), pa.array(hashes, pa.string())],
                                         names=["digest", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())],
                                         names=["digest", "ends_sha256"])


def ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of the nodes at which conversations end."""
    last = rows.filter("d = len").select("digest", "conv").unionByName(
        convs.filter("len = 0").select(F.lit(ROOT).alias("digest"), "conv"))
    pieces = (last.groupBy("digest", F.shiftright("conv", 12).alias("piece"))  # CHUNK ids at most
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",")
                   .alias("ids")))
    return (pieces.repartition("digest").sortWithinPartitions("digest", "piece").select("digest", "ids")
            .mapInArrow(_stream_ends, "digest binary, ends_sha256 string"))


def crown_nodes(rows: DataFrame, convs: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes (as :data:`NODES`) of the crown's rows and of the root, above ``tops``."""
    at_root = convs.select("conv", F.lit(0).cast("long").alias("d"), F.lit(ROOT).alias("digest"),
                           F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("bytes"))
    every = rows.select("conv", "d", "digest", "parent", "bytes").unionByName(at_root)
    nodes = every.groupBy("digest").agg(
        F.min("parent").alias("parent"), F.min("conv").alias("conv_id"), F.min("d").alias("depth"),
        F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("n_convs"))
    nodes = staged(nodes, "trie-crown")
    below = nodes.filter("depth > 0").select("parent").unionByName(tops.select("parent"))
    children = below.groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes.join(children, "digest", "left").fillna(0, ["n_children"]), "trie-crown")
    # A crown node's own part, and a top's whole sum, belong to their smallest member's path.
    own = nodes.select(F.col("conv_id").alias("conv"), F.col("depth").alias("d"),
                       (F.col("n_children") == 0).cast("long").alias("leaves"),
                       ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    own = staged(own.unionByName(tops.select(F.col("conv_id").alias("conv"), F.col("depth").alias("d"),
                                             F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))),
                 "trie-parts")
    owners = own.groupBy("conv").agg(F.sum("leaves").alias("all_leaves"), F.sum("saved").alias("all_saved"))
    path = keep_ids(every.select("conv", "d", "digest"), F.col("conv"),
                    own.select(F.col("conv").alias("_owner")).distinct(), "_owner")
    steps = (path.select("conv", "d", F.lit(0).alias("kind"), "digest", F.lit(0).cast("long").alias("leaves"),
                         F.lit(0).cast("long").alias("saved"))
             .unionByName(own.select("conv", "d", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("digest"),
                                     "leaves", "saved"))
             .withColumn("chunk", F.expr(f"d div {CHUNK}")))
    steps = staged(steps, "trie-steps")
    for value in ("leaves", "saved"):  # what belongs to shallower depths is no part of the subtree
        steps = running_sum(steps, ["conv"], "chunk", ["d", "kind"], value, f"before_{value}")
    sums = (steps.filter("kind = 0").join(owners, "conv").groupBy("digest").agg(
        F.sum(F.col("all_leaves") - F.col("before_leaves")).alias("n_leaves"),
        F.sum(F.col("all_saved") - F.col("before_saved")).alias("saved_tokens")))
    return nodes.join(sums, "digest").select(
        "digest", "parent", F.lit(True).alias("is_top"), "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(conversations)
    rows = prefixes(turns, convs)
    below = rows.groupBy("digest").agg(F.sum(F.col("len") - F.col("d") + 1).alias("below"))
    crown = staged(below.filter(F.col("below") > SHARD_ROWS).select("digest"), "trie-crowded")
    rows = _flag(rows, crown)
    high = rows.filter("crown")
    depth = high.groupBy("conv").agg(F.max("d").alias("high"))
    tops = (rows.filter("not crown").join(depth, "conv", "left")
            .filter(F.col("d") == F.coalesce("high", F.lit(0)) + 1).select("conv", F.col("digest").alias("top")))
    shards = max(1, -(-4 * rows.count() // SHARD_ROWS))
    dealt = (rows.filter("not crown").join(tops, "conv")
             .select("conv", "d", "digest", "parent", "bytes", F.pmod(F.xxhash64("top"), F.lit(shards)).alias("shard")))
    low = staged(dealt.groupBy("shard").applyInArrow(_shard, NODES), "trie-nodes")
    upper = staged(crown_nodes(high, convs, low.filter("is_top")), "trie-upper")
    # Parents of tops and of crown nodes are crown nodes.
    over = upper.select(F.col("digest").alias("_digest"), F.col("conv_id").alias("_conv"))
    over = F.broadcast(over) if upper.count() <= BROADCAST_IDS else over
    edge = low.filter("is_top").unionByName(upper).join(over, F.col("parent") == F.col("_digest"), "left")
    edge = edge.withColumn("parent_conv_id", F.col("_conv")).drop("_digest", "_conv")
    nodes = low.filter("not is_top").unionByName(edge)
    return nodes.join(ends(rows, convs), "digest", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


ORACLE = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1
           AS i
  FROM conversations WHERE conv_id IS NOT NULL),
lengths AS (SELECT c, count(*) AS n FROM turns GROUP BY c),
convs AS (
  SELECT l.c, {crc32_sql('l.c::VARCHAR')} % {HEAD} AS h, l.c - l.c % {STRIDE} AS base, coalesce(b.n, 0) AS of_base
  FROM lengths l LEFT JOIN lengths b ON b.c = l.c - l.c % {STRIDE}),
rebuilt AS (
  SELECT v.c, i + 1 AS d, role, text FROM convs v JOIN turns t ON t.c = v.base WHERE i < h
  UNION ALL
  SELECT v.c, least(h, of_base) + i - h + 1, role, text FROM convs v JOIN turns t ON t.c = v.c WHERE i >= h),
paths AS (
  SELECT c, 0 AS d, '' AS key, 0 AS bytes FROM convs
  UNION ALL
  SELECT c, d, string_agg(sha256(strlen(role)::VARCHAR || ':' || role || text), '') OVER (
           PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING), strlen(text)
  FROM rebuilt),
stops AS (SELECT key, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
          FROM (SELECT c, arg_max(key, d) AS key FROM paths GROUP BY c) e GROUP BY key),
members AS (SELECT key, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes
            FROM paths GROUP BY key),
children AS (SELECT left(key, -64) AS key, count(*) AS n FROM members WHERE depth > 0 GROUP BY 1),
nodes AS (SELECT m.*, coalesce(k.n, 0) AS n_children FROM members m LEFT JOIN children k USING (key)),
subtrees AS (
  SELECT a.key, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.bytes) AS saved
  FROM nodes a JOIN nodes b ON starts_with(b.key, a.key) GROUP BY a.key)
SELECT m.conv_id, m.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children,
       s.n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes m JOIN subtrees s USING (key) LEFT JOIN stops e USING (key)
LEFT JOIN members p ON m.depth > 0 AND p.key = left(m.key, -64)
"""
