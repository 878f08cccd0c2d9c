"""op12: exact Jaccard join of word 3-gram sets in size-banded tiles with bitmap signatures.

Sets are put into size bands (``BAND`` wide); two linked sets lie in one band or in
neighbouring ones. Candidates are found without loss: sets of a band that are linked
differ in at most D shingles, so of D + 1 + q slices of the hash range they agree on more
than q. Slices with very few shingles say little and are left out where a set has no more
than q of them; an agreed slice is then left over. Sets that agree on a slice meet in a
bucket; a bucket gives star edges only, and the connected buckets form clusters. No link
leaves a cluster.

Clusters are compared in size-banded tiles (:mod:`tarmac.llm.tiles`): bit counts of parity
bitmaps bound the overlap of two sets from above, and pairs that the bound leaves, and
that the links found in the tile so far don't join already, are decided by exact
intersection of the sorted hashes. A tile gives a spanning set of its links, from which
components follow; links inside a component are not listed one by one.

Equal sets are one class, named by its smallest id, before anything is compared.

Defined results: A-Z are lower-cased; a set shorter than 3 words is one shingle; null or
blank text has no shingles and links with nothing; rows with a null id link with nothing
(component null); rows that repeat an id are one document; an empty table gives no rows;
text lengths are unbounded (a set larger than a block is a block of its own); further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import bounded_batches, components, keep_ids, staged, table
from tarmac.llm.tiles import STARTS, band_of, exact, met
from tarmac.llm.tokens import mix, row_slices, shingles, word_hashes

WIDTH = 3
THRESHOLD = (90, 100)  # link when 100 * intersection >= 90 * union
SPARE, WEAK = 0.25, 2  # q is this share of D + 1; a slice of so few shingles may be left out

def slices(band: int) -> tuple[int, int]:
    """(number of slices, spare ones among them). One more than the shingles in which two
    linked sets can differ, neither larger than the band's largest, as
    |A| + |B| - 2 * overlap <= (|A| + |B|) * (1 - t) / (1 + t); and the spare ones."""
    num, den = THRESHOLD
    least = 2 * int(STARTS[band + 1] - 1) * (den - num) // (den + num) + 1
    spare = int(np.ceil(SPARE * least)) if least > 1 else 0
    return least + spare, spare


def strong(counts: np.ndarray, spare: int) -> np.ndarray:
    """The slices to use of a set with these counts: those above the largest bound, up to
    ``WEAK``, that at most ``spare`` slices don't exceed. Of two linked sets the one with
    the higher bound has an agreed slice above it, and so has the other."""
    for bound in range(WEAK, -1, -1):
        if (counts <= bound).sum() <= spare:
            return counts > bound
    return np.ones(len(counts), bool)


def slice_keys(hashes: np.ndarray) -> np.ndarray:
    """A key per slice of a sorted set, for its band and, where a partner can lie there, the
    next one. Sets that can only be linked when equal (one slice) have none."""
    num, den = THRESHOLD
    own = band_of(len(hashes))
    out = []
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A5)), dtype=np.uint64)])
        for band in (own, own + 1):
            k, spare = slices(band)
            if k == 1 or band > own and den * len(hashes) < num * int(STARTS[band]):
                continue
            edges = -(-(np.arange(1, k, dtype=np.int64) << 32) // k)  # rounded up
            cuts = np.concatenate([[0], np.searchsorted(hashes >> np.uint64(32), edges.astype(np.uint64)), [len(hashes)]])
            part = sums[cuts[1:]] - sums[cuts[:-1]]
            keys = mix(part + mix(np.arange(k, dtype=np.uint64) + np.uint64((band + 1) << 40)))
            out.append(keys[strong(np.diff(cuts), spare)])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _prints(sets: list[np.ndarray]) -> list[pa.Array]:
    with np.errstate(over="ignore"):
        sums = [(s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)) for s in sets]
    both = np.array(sums, np.uint64).reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(both[:, k]).view(np.int64)) for k in (0, 1)]


SKETCH = ["doc_id", "n_shingles", "print_a", "print_b", "keys"]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in row_slices(batch.column(1)):
            part = batch.slice(lo, hi - lo)
            words, at = word_hashes(part.column(1), lower=True)
            sets = [shingles(words[at[i]:at[i + 1]], WIDTH) for i in range(len(part))]
            n = pa.array([len(s) for s in sets], pa.int64())
            keys = _lists([slice_keys(s) if len(s) else s for s in sets])
            yield pa.RecordBatch.from_arrays([part.column(0), n, *_prints(sets), keys], names=SKETCH)


ROW = "doc_id long, n_shingles long, print_a long, print_b long"


def given(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def clusters(sets: DataFrame) -> DataFrame:
    """(doc_id, cluster) of the sets (doc_id, keys) that share a slice with another one."""
    rows = sets.select(F.explode("keys").alias("key"), "doc_id")
    stars = (rows.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
             .filter("lo < hi").select("key", "lo"))
    edges = rows.join(stars, "key").select("doc_id", "lo").filter("doc_id <> lo").distinct()
    found = components(staged(edges, "join-edges"), "doc_id", "lo")
    return found.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))


def links(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """Verified links (a, b) that join all documents which links join; ``sets``: rows as
    :data:`SKETCH`, ``docs``: (doc_id, text). The tiles get texts, which are smaller than
    sets, and hash them again."""
    known = clusters(sets)
    near = staged(sets.select(*SKETCH[:4]).join(known, "doc_id"), "join-near")
    distinct = staged(near.distinct().withColumn("label", F.col("doc_id")), "join-distinct")
    texts = docs.filter("text is not null")
    if near.count() > distinct.count():  # repeated rows
        texts = keep_ids(texts, F.col("doc_id"), known.select(F.col("doc_id").alias("_wanted")), "_wanted")
        texts = texts.dropDuplicates()
    return met(distinct, texts, THRESHOLD, exact(WIDTH, THRESHOLD))


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id)."""
    docs = given(docs, id_col, text_col)
    sketch = staged(docs.mapInArrow(_sketch, ROW + ", keys array<long>"), "join-sketch")
    of_set = ["print_a", "print_b", "n_shingles"]
    linkable = sketch.filter("n_shingles > 0 and doc_id is not null")
    classes = staged(linkable.groupBy(*of_set).agg(F.min("doc_id").alias("least")), "join-classes")
    first = keep_ids(linkable, F.col("doc_id"), classes.select(F.col("least").alias("_least")), "_least")
    found = links(first, docs)
    named = staged(sketch.drop("keys").join(classes, of_set, "left").select("doc_id", "n_shingles", "least"), "join-named")
    # Ids on rows of several classes tie those classes together.
    tied = (named.filter("doc_id is not null").groupBy("doc_id")
            .agg(F.min("least").alias("a"), F.max("least").alias("b")).filter("a < b").select("a", "b"))
    groups = components(found.unionByName(staged(tied, "join-tied")))
    return named.join(groups, F.col("least") == F.col("node"), "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "least", "doc_id")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents"))


# All pairs that share a shingle; for small tables (the check runs it on sf0.01).
ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents) t),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM words WHERE doc_id IS NOT NULL),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
           FROM each a JOIN each b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (SELECT a, b FROM common WHERE 100 * c >= 90 * (na + nb - c)),
both_ways AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (
  SELECT DISTINCT doc_id AS a, doc_id AS b FROM words WHERE doc_id IS NOT NULL
  UNION
  SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b)
SELECT w.doc_id, len(w.s) AS n_shingles, c.component_id
FROM words w LEFT JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = w.doc_id
"""
