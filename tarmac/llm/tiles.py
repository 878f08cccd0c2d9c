"""Size-banded tiles: comparing the sets of a cluster block by block.

A cluster (any group in which all links are to be found) is cut into blocks by size band
and size, each of about ``BLOCK`` shingles; every pair of blocks whose sizes allow a link
is a tile, and a small cluster is one tile. In a tile, pairs of different labels are held
against parity bitmaps (a bit per hash cell, flipped by every shingle in it): the bits in
which two bitmaps differ are no more than the shingles in which the sets differ, so their
count bounds the overlap from above. What is left is decided exactly, or passed on as
probable. A tile gives links that join all sets which its links join, not every link.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import BROADCAST_IDS, ranked, staged
from tarmac.llm.tokens import shingles, word_hashes

BAND = 1.5         # a size band ends at this multiple of its start
BLOCK = 1 << 20    # shingles of a block (8 MB as hashes), and
BLOCK_ROWS = 2048  # at most so many sets
MIN_BITS, MAX_BITS = 256, 1 << 16

_starts = [1]
while _starts[-1] < 1 << 40:
    _starts.append(int(_starts[-1] * BAND) + 1)
STARTS = np.array(_starts, np.int64)  # first size of each band


def band_of(n: int) -> int:
    return int(np.searchsorted(STARTS, n, "right")) - 1


def blocks(near: DataFrame) -> DataFrame:
    """Adds ``band`` and ``block`` to (doc_id, n_shingles, cluster, ...); small clusters are
    one block, of band -1."""
    starts = F.array(*[F.lit(int(s)) for s in STARTS])
    band = F.size(F.filter(starts, lambda s: s <= F.col("n_shingles"))) - 1
    whole = near.groupBy("cluster").agg(F.sum("n_shingles").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    small = whole.filter((F.col("_n") <= BLOCK) & (F.col("_rows") <= BLOCK_ROWS)).select("cluster", F.lit(1).alias("_small"))
    placed = near.join(small, "cluster", "left").withColumn("band", F.when(F.col("_small") == 1, -1).otherwise(band))
    placed = staged(placed.drop("_small"), "tiles-placed")
    lone = placed.filter("band < 0").withColumn("block", F.lit(0).cast("long"))
    large = ranked(placed.filter("band >= 0"), ["cluster", "band"], ["n_shingles", "doc_id"], "at", "_size")
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(BLOCK / (F.element_at(starts, F.col("band") + 2) - 1))))
    return lone.unionByName(large.withColumn("block", F.floor(F.col("at") / rows)).drop("at", "_size"))


def tiles(placed: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(cluster, band, block, tile, side): the tiles of every block; side 0 is the block with
    the smaller sets, a tile of one block has side 0 only."""
    num, den = threshold
    each = staged(placed.groupBy("cluster", "band", "block").agg(F.min("n_shingles").alias("least"),
                                                                 F.max("n_shingles").alias("most")), "tiles-blocks")
    x = each.select("cluster", *[F.col(c).alias(f"x_{c}") for c in ("band", "block", "least", "most")])
    y = each.select("cluster", *[F.col(c).alias(f"y_{c}") for c in ("band", "block", "least", "most")])
    pairs = x.join(y, "cluster").filter(
        "(x_band < y_band or x_band = y_band and x_block <= y_block)").filter(den * F.col("x_most") >= num * F.col("y_least"))
    tile = F.xxhash64("cluster", "x_band", "x_block", "y_band", "y_block").alias("tile")
    sides = [F.struct(F.col(f"{s}_band").alias("band"), F.col(f"{s}_block").alias("block"), F.lit(k).alias("side"))
             for k, s in enumerate("xy")]
    lone = (F.col("x_band") == F.col("y_band")) & (F.col("x_block") == F.col("y_block"))
    both = F.when(lone, F.array(sides[0])).otherwise(F.array(*sides))
    return pairs.select("cluster", tile, F.explode(both).alias("of")).select("cluster", "tile", "of.*")


def parity_bitmap(s: np.ndarray) -> np.ndarray:
    """The bitmap of a set, in words; sets of up to twice the size have one up to twice as wide."""
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (len(s) - 1).bit_length()))
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


class Bitmaps:
    """Bitmaps by width; a wider one is folded to half its width to meet a narrower one."""

    def __init__(self, maps: list[np.ndarray]):
        self.words = np.array([len(m) for m in maps], np.int64)
        self.place = np.zeros(len(maps), np.int64)
        self.own: dict[int, np.ndarray] = {}
        for w in np.unique(self.words):
            at = np.flatnonzero(self.words == w)
            self.place[at] = np.arange(len(at))
            self.own[int(w)] = np.stack([maps[i] for i in at])
        self.half = {w: m[:, :w // 2] ^ m[:, w // 2:] for w, m in self.own.items()}

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """Differing bits of set ``i`` and each of ``others``, as wide or twice as wide (a
        still wider one is not compared and counts 0)."""
        w = int(self.words[i])
        mine, out = self.own[w][self.place[i]], np.zeros(len(others), np.int64)
        for width, maps in ((w, self.own), (2 * w, self.half)):
            if width in maps:
                like = self.words[others] == width
                found = maps[width][self.place[others[like]]] ^ mine
                out[like] = np.bitwise_count(found).sum(axis=1, dtype=np.int64)
        return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays of distinct values."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def spanning_links(sizes: np.ndarray, maps: list[np.ndarray], threshold: tuple[int, int],
                   sets: list[np.ndarray] | None = None, labels: np.ndarray | None = None,
                   split: int | None = None) -> list[tuple[int, int]]:
    """Links (i, j) of a tile that, with equal ``labels``, join all sets which its links
    join. Without ``sets`` every pair that the bitmaps allow counts as a link. ``split``:
    only pairs with i < split <= j are compared; else all."""
    num, den = threshold
    bitmaps, links = Bitmaps(maps), []
    label = np.arange(len(sizes)) if labels is None else np.unique(labels, return_inverse=True)[1]
    order = np.argsort(sizes, kind="stable")
    ordered = sizes[order]
    for at, i in enumerate(order):
        # Larger (or as large) partners of set i, as far as sizes allow.
        others = order[at + 1:np.searchsorted(ordered, den * sizes[i] // num, "right")]
        if split is not None:
            others = others[(others < split) != (i < split)]
        others = others[label[others] != label[i]]
        if not len(others):
            continue
        both = sizes[others] + sizes[i]
        needed = -(-num * both // (num + den))  # least overlap of a link
        can = both - bitmaps.apart(i, others) >= 2 * needed
        others, needed = others[can], needed[can]
        while len(others):
            j = others[0]
            if sets is None or overlap(sets[i], sets[j]) >= needed[0]:
                links.append((int(i), int(j)))
                label[label == label[j]] = label[i]
            left = label[others] != label[i]
            left[0] = False
            others, needed = others[left], needed[left]
    return links


def _each_tile(pack: pa.Table, found: Callable[[pa.Table, int | None], list[tuple[int, int]]]) -> pa.Table:
    pack = pack.sort_by([("tile", "ascending"), ("side", "ascending")])
    tile, side, ids = (pack[c].to_numpy() for c in ("tile", "side", "doc_id"))
    cuts = np.flatnonzero(np.diff(tile, prepend=tile[0] - 1, append=tile[-1] - 1))
    a, b = [], []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        split = int(np.searchsorted(side[lo:hi], 1))
        for i, j in found(pack.slice(lo, hi - lo), split if split < hi - lo else None):
            a.append(min(ids[lo + i], ids[lo + j]))
            b.append(max(ids[lo + i], ids[lo + j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def exact(width: int, threshold: tuple[int, int]) -> Callable[[pa.Table], pa.Table]:
    """Decides the pairs of tiles whose rows have ``text``, by ``width``-word shingles."""

    def found(rows: pa.Table, split: int | None) -> list[tuple[int, int]]:
        words, at = word_hashes(rows["text"], lower=True)
        sets = [shingles(words[at[r]:at[r + 1]], width) for r in range(len(rows))]
        sizes = np.array([len(s) for s in sets], np.int64)
        return spanning_links(sizes, [parity_bitmap(s) for s in sets], threshold, sets,
                              rows["label"].to_numpy(), split)

    return lambda pack: _each_tile(pack, found)


def probable(threshold: tuple[int, int]) -> Callable[[pa.Table], pa.Table]:
    """Gives the pairs that the bitmaps allow, in tiles whose rows have ``n`` and ``bits``."""

    def found(rows: pa.Table, split: int | None) -> list[tuple[int, int]]:
        maps = [np.frombuffer(b, np.uint64) for b in rows["bits"].to_pylist()]
        return spanning_links(rows["n"].to_numpy(), maps, threshold, None, rows["label"].to_numpy(), split)

    return lambda pack: _each_tile(pack, found)


def met(near: DataFrame, payload: DataFrame, threshold: tuple[int, int],
        decide: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Links (a < b) of the clusters of ``near`` (cluster, doc_id, n_shingles, label), stored.
    ``payload`` has what ``decide`` needs of a document, a row or more per doc_id."""
    placed = staged(blocks(near), "tiles-blocked")
    spread = placed.join(tiles(placed, threshold), ["cluster", "band", "block"])
    spread = staged(spread.select(F.col("doc_id").alias("_id"), "n_shingles", "label", "tile", "side"), "tiles-spread")
    load = spread.agg(F.sum("n_shingles").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    packs = max(1, -(-(load["n"] or 0) // (2 * BLOCK)))
    to = spread.select("_id", "label", "tile", "side", F.pmod(F.xxhash64("tile"), F.lit(packs)).alias("pack")).distinct()
    dealt = payload.join(F.broadcast(to) if load["rows"] <= BROADCAST_IDS else to, F.col("doc_id") == F.col("_id"))
    return staged(dealt.drop("_id").groupBy("pack").applyInArrow(decide, "a long, b long"), "tiles-links")
