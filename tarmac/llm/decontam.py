"""op3: benchmark decontamination by spaced-seed hashing.

Texts and benchmark items become tokens (runs of ASCII letters/digits and non-ASCII
characters of the lower-cased text). An overlap of k equal tokens with m others between
them has a run of k / (m + 1) equal tokens; at identity ``IDENTITY`` that is four, or three
that a mask joins with two or three more (``MASKS``), so every overlap agrees with its item
on some mask. The item windows' hashes are joined with those of all document windows; at
each hit the item is laid over the text, and where enough tokens are equal the overlap of
most equal tokens at that identity is taken.

The benchmark is the query set: it is cut into blocks of about ``BLOCK_TOKENS`` tokens,
each block goes to every task as one hash index, and every block meets all documents in
one scan without any shuffle of the corpus. There is no cap on hits, items or text.

Defined results for odd input: null or blank texts and items match nothing; items of
fewer than ``MIN_TOKENS`` tokens match where the whole item stands unchanged;
an item of any length is laid whole and gives one row per document row; repeated document
rows, and repeated item rows, each give their rows; null ids stay null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import bounded_batches, staged, table
from tarmac.llm.tokens import ALNUM, POSITION, row_slices, word_hashes

# The last three are for items of so many tokens only.
MASKS = ("1111", "1110111", "111011", "111", "11", "1")
MIN_TOKENS = 8        # shorter items are searched exactly
MIN_MATCH = 12        # verified equal tokens (``IDENTITY`` of the item, if that is less)
IDENTITY = 0.8        # equal tokens / overlap
ENTRIES = 1 << 20     # index entries, or tokens to compare, looked at together
BLOCK_TOKENS = 500_000

_OFFSETS = [[i for i, c in enumerate(m) if c == "1"] for m in MASKS]


def mask_hashes(words: np.ndarray, mask: int) -> np.ndarray:
    offsets = _OFFSETS[mask]
    n = len(words) - len(MASKS[mask]) + 1
    h = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        with np.errstate(over="ignore"):
            for k, o in enumerate(offsets):
                h += words[o:o + n] * POSITION[8 * mask + k]
    return h


def mask_serves(mask: int, tokens: int) -> bool:
    return mask < 3 or tokens == len(MASKS[mask])


def needed(tokens: int) -> int:
    """Equal tokens that make a leak of an item of so many tokens."""
    return tokens if tokens < MIN_TOKENS else min(MIN_MATCH, -(-tokens * 4 // 5))


@dataclass
class Index:
    """Hash index of one block of items."""

    item: list          # id per item, may be None
    words: list         # token hashes per item
    flat: np.ndarray    # those of all items in a row
    start: np.ndarray   # where an item begins there (one more at the end)
    needed: np.ndarray  # equal tokens that make a leak, per item
    bits: int           # a window's top bits look up ``seen`` before ``keys``
    seen: list          # per mask: which top bits occur
    keys: list          # per mask: sorted distinct window hashes
    first: list         # per mask: where a key's entries start (one more at the end)
    row: list           # per mask: item and position of each entry
    at: list


def build_index(item: list, words: list[np.ndarray]) -> Index:
    length = [len(w) for w in words]
    total = sum(length)
    bits = int(np.clip(np.ceil(np.log2(64 * max(total, 1))), 16, 26))
    out = Index(item, words, np.concatenate([np.zeros(0, np.uint64), *words]),
                np.cumsum([0, *length], dtype=np.int64),
                np.array([needed(n) for n in length], np.int64), bits, [], [], [], [], [])
    for mask in range(len(MASKS)):
        hashes = [mask_hashes(w if mask_serves(mask, n) else w[:0], mask) for w, n in zip(words, length)]
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        row = np.repeat(np.arange(len(words)), [len(x) for x in hashes])
        at = np.concatenate([np.arange(len(x)) for x in hashes]) if hashes else np.zeros(0, int)
        order = np.argsort(h, kind="stable")
        keys, first = np.unique(h[order], return_index=True)
        seen = np.zeros(1 << bits if len(keys) else 0, bool)
        seen[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
        out.seen.append(seen)
        out.keys.append(keys)
        out.first.append(np.append(first, len(h)))
        out.row.append(row[order].astype(np.int32))
        out.at.append(at[order].astype(np.int32))
    return out


def _verify(doc: np.ndarray, item: np.ndarray, shift: int):
    """The overlap at ``IDENTITY`` of most equal tokens of the item laid at ``shift``:
    (matched, length, doc position)."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    good = doc[lo + shift:hi + shift] == item[lo:hi]
    # 5 * matched >= 4 * length means that matches less 4 per mismatch are not negative.
    score = np.concatenate([[0], np.cumsum(np.where(good, 1, -4))])
    count = np.concatenate([[0], np.cumsum(good)])
    first = np.searchsorted(-np.minimum.accumulate(score), -score)  # leftmost start for each end
    end = int((count - count[first]).argmax())
    inside = first[end] + np.flatnonzero(good[first[end]:end])
    if not len(inside):
        return 0, 0, 0
    return len(inside), int(inside[-1] - inside[0]) + 1, int(inside[0]) + lo + shift


def _ragged(n: np.ndarray) -> np.ndarray:
    """0 .. n[k] - 1 for every k in a row."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _chunks(n: np.ndarray) -> list[np.ndarray]:
    """Places of ``n`` in parts whose sums are about ``ENTRIES`` at most."""
    return np.split(np.arange(len(n)), np.flatnonzero(np.diff(np.cumsum(n) // ENTRIES)) + 1) if len(n) else []


def _hopeful(index: Index, words: np.ndarray, at: np.ndarray, laid: np.ndarray) -> np.ndarray:
    """Those of ``laid`` (row, item, shift) with enough equal tokens over the whole item."""
    laid = np.unique(laid, axis=1)
    row, item, shift = laid
    lo = np.maximum(0, -shift)
    n = np.minimum(np.diff(index.start)[item], at[row + 1] - at[row] - shift) - lo
    keep = np.zeros(len(n), bool)
    for k in _chunks(n):
        r = _ragged(n[k])
        in_item = np.repeat(index.start[item[k]] + lo[k], n[k]) + r
        in_text = np.repeat(at[row[k]] + shift[k] + lo[k], n[k]) + r
        equal = np.add.reduceat((index.flat[in_item] == words[in_text]).astype(np.int64), np.cumsum(n[k]) - n[k])
        keep[k] = equal >= index.needed[item[k]]
    return laid[:, keep]


def find_overlaps(index: Index, words: np.ndarray, at: np.ndarray) -> list[tuple]:
    """(row, item, matched, overlap, position, item tokens) of the rows whose words are
    ``words[at[row]:at[row + 1]]``; one per row and item, best overlap."""
    at = np.asarray(at, np.int64)
    found = [np.zeros((3, 0), np.int64)]
    for mask in range(len(MASKS)):
        if not len(index.keys[mask]):
            continue
        h = mask_hashes(words, mask)
        i = np.flatnonzero(index.seen[mask][(h >> np.uint64(64 - index.bits)).astype(np.int64)])
        if not len(i):
            continue
        k = np.searchsorted(index.keys[mask], h[i])
        k[k == len(index.keys[mask])] = 0
        same = index.keys[mask][k] == h[i]
        i, k = i[same], k[same]
        row = np.searchsorted(at, i, "right") - 1
        inside = i + len(MASKS[mask]) <= at[row + 1]
        i, k, row = i[inside], k[inside], row[inside]
        n = index.first[mask][k + 1] - index.first[mask][k]
        for c in _chunks(n):
            entry = np.repeat(index.first[mask][k[c]], n[c]) + _ragged(n[c])
            item, q = index.row[mask][entry].astype(np.int64), index.at[mask][entry]
            found.append(_hopeful(index, words, at, np.stack([
                np.repeat(row[c], n[c]), item, np.repeat(i[c] - at[row[c]], n[c]) - q])))
    best: dict[tuple[int, int], tuple] = {}
    for row, item, shift in np.unique(np.concatenate(found, axis=1), axis=1).T.tolist():
        got = _verify(words[at[row]:at[row + 1]], index.words[item], shift)
        if got[0] >= index.needed[item] and got[0] > best.get((row, item), (0,))[0]:
            best[row, item] = got
    return [(row, index.item[item], *got, len(index.words[item]))
            for (row, item), got in sorted(best.items())]


HITS = "array<struct<item_id:long,matched:long,overlap:long,position:long,item_words:long>>"


def _overlap_udf(index) -> Column:
    fields = pa.struct([(n, pa.int64()) for n in ("item_id", "matched", "overlap", "position", "item_words")])

    @F.arrow_udf(HITS)
    def overlaps(text: pa.Array) -> pa.Array:
        got = []
        for lo, hi in row_slices(text):
            words, at = word_hashes(text[lo:hi], ALNUM)
            got += [(lo + row, *rest) for row, *rest in find_overlaps(index.value, words, at)]
        ends = np.searchsorted([g[0] for g in got], np.arange(len(text) + 1)) if got else np.zeros(len(text) + 1)
        rows = [dict(zip(fields.names, g[1:])) for g in got]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(rows, fields))

    return overlaps


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, words) of the items that have a token."""
    for batch in batches:
        words, at = word_hashes(batch.column(1), ALNUM)
        rows = pa.array([words[a:b].view(np.int64) for a, b in zip(at[:-1], at[1:])], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), rows], names=["item_id", "words"]).filter(
            pa.array(np.diff(at) > 0))


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator:
    """One broadcast hash index per block of the benchmark; an item is in one block."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.lower(text_col).alias("text"))
    items = staged(items.mapInArrow(_token_rows, "item_id long, words array<long>"), "benchmark-tokens")
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // BLOCK_TOKENS)
    block = F.pmod(F.xxhash64("item_id", "words"), F.lit(max(blocks, 1)))
    for b in range(blocks):
        rows = items.filter(block == b).orderBy("item_id", "words").collect()
        yield items.sparkSession.sparkContext.broadcast(build_index(
            [r.item_id for r in rows], [np.array(r.words, np.int64).view(np.uint64) for r in rows]))


def with_overlaps(docs: DataFrame, benchmark: DataFrame, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus an array column of verified overlaps with benchmark items."""
    df = bounded_batches(docs)
    found = []
    for index in indexes(benchmark):
        found.append(_overlap_udf(index)(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    hits = F.concat(*found) if found else F.lit(None).cast(HITS)
    return df.withColumn(out, hits)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row and benchmark item it contains: (doc_id, item_id, matched,
    overlap, position, item_words); the longest verified overlap, word positions from 0."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hits = with_overlaps(narrow, benchmark, "hits").select("doc_id", F.explode("hits").alias("h"))
    return hits.select("doc_id", "h.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a verified overlap, all columns as they were."""
    marked = with_overlaps(docs, benchmark, "_benchmark_overlaps", text_col)
    return (marked.filter(F.coalesce(F.size("_benchmark_overlaps"), F.lit(0)) <= 0)
            .drop("_benchmark_overlaps"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
