"""op6: near-duplicate groups by one-permutation hashing with optimal densification.

Every document's set of distinct word shingles is hashed once; the hash range is cut
into ``BINS`` bins and each bin keeps its smallest hash (one permutation). An empty bin
copies a bin chosen by a fixed probe sequence until a filled one is met (optimal
densification). ``ROWS`` neighbouring bins form a band; documents that agree on a band
meet in a bucket. A bucket of any size yields star edges only: from each member to the
bucket's smallest and to its largest document, so candidates grow with the members and
not with their pairs. Candidates are confirmed on the full shingle sets.

With 40 bands of 4 bins a pair at similarity 0.75 shares no bucket with probability
(1 - 0.75**4) ** 40 = 2.5e-7. A pair that does share buckets is compared directly where
one of the two is a centre; other pairs matter only where their bucket still holds more
than one group afterwards. Those are compared in size-banded tiles, first by bitmaps, then
on the full sets (:mod:`tarmac.llm.tiles`), so all pairs that share a band bucket are decided.

Defined results for odd input: null or blank text has no shingles, links with nothing and
is its own component; rows with a null id link with nothing (component null, kept); rows
that repeat an id are one node; ties go to the smallest id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import bounded_batches, components, keep_ids, staged, table
from tarmac.llm.tiles import exact, met, parity_bitmap, probable
from tarmac.llm.tokens import mix, row_slices, shingles, word_hashes

WIDTH = 5             # words per shingle
THRESHOLD = (75, 100)  # link when 100 * intersection >= 75 * union
BINS, ROWS = 160, 4    # 40 bands of 4 bins
PROBES = 64

_probe = np.random.Generator(np.random.PCG64(7)).integers(0, BINS, (PROBES, BINS))


def one_permutation(hashes: np.ndarray) -> np.ndarray:
    """The densified signature (``BINS`` values) of a sorted, non-empty set of hashes."""
    bins = (((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    filled = np.zeros(BINS, bool)
    filled[bins[first]] = True
    sig = np.zeros(BINS, np.uint64)
    sig[bins[first]] = hashes[first]
    empty = np.flatnonzero(~filled)
    if len(empty):
        hit = filled[_probe[:, empty]]
        found = hit.any(axis=0)
        sig[empty[found]] = sig[_probe[hit.argmax(axis=0)[found], empty[found]]]
        rest = empty[~found]
        if len(rest):  # very small sets: go on with the next filled bin
            at = np.flatnonzero(filled)
            sig[rest] = sig[at[np.searchsorted(at, rest) % len(at)]]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    bands = sig.reshape(-1, ROWS)
    with np.errstate(over="ignore"):
        key = np.arange(1, len(bands) + 1, dtype=np.uint64)
        for k in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, k])
    return key


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in row_slices(batch.column(1)):
            yield batch.slice(lo, hi - lo)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n_bands = BINS // ROWS
    for batch in _sliced(batches):
        words, at = word_hashes(batch.column(1), lower=True)
        size = np.zeros(len(batch), np.int64)
        prints = np.zeros((2, len(batch)), np.uint64)
        keys, ends = [], np.zeros(len(batch) + 1, np.int32)
        for i in range(len(batch)):
            s = shingles(words[at[i]:at[i + 1]], WIDTH)
            size[i] = len(s)
            ends[i + 1] = ends[i]
            if len(s):
                with np.errstate(over="ignore"):
                    prints[0, i], prints[1, i] = s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)
                keys.append(band_keys(one_permutation(s)))
                ends[i + 1] += n_bands
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size), pa.array(prints[0].view(np.int64)),
             pa.array(prints[1].view(np.int64)),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))],
            names=["doc_id", "n_shingles", "print_a", "print_b", "bands"])


SKETCH = "doc_id long, n_shingles long, print_a long, print_b long, bands array<long>"


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: set size, a 128-bit fingerprint of the whole set, and the band keys."""
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(_sketch, SKETCH)


def bucket_members(sets: DataFrame) -> DataFrame:
    """(key, doc_id, members, lo, hi) of the buckets that hold two documents or more."""
    rows = sets.select(F.explode("bands").alias("key"), "doc_id")
    stars = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("lo"),
                                     F.max("doc_id").alias("hi")).filter("lo < hi"))
    return rows.join(stars, "key")  # a hot bucket is a skewed join, which AQE splits


def star_candidates(members: DataFrame) -> DataFrame:
    """Distinct pairs (a < b): every member of a bucket with its ``lo`` and ``hi`` centre."""
    pairs = (members.select("doc_id", F.explode(F.array("lo", "hi")).alias("centre"))
             .filter("doc_id <> centre")
             .select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")))
    return pairs.distinct()


def left_open(rows: DataFrame) -> DataFrame:
    """The rows (key, label, ...) of the buckets whose members bear more than one label."""
    several = (rows.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"))
               .filter("least < most").select("key"))
    return rows.join(several, "key", "left_semi")


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches):
        words, at = word_hashes(batch.column(1), lower=True)
        sets = [shingles(words[at[i]:at[i + 1]], WIDTH) for i in range(len(batch))]
        full = [i for i, s in enumerate(sets) if len(s)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(full, pa.int64())), pa.array([len(sets[i]) for i in full], pa.int64()),
             pa.array([parity_bitmap(sets[i]).tobytes() for i in full], pa.binary())], names=["doc_id", "n", "bits"])


def linked_groups(reps: DataFrame, members: DataFrame, docs: DataFrame, sizes: DataFrame, shared: DataFrame,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, component) of every document of ``reps`` (column ``node``).

    The buckets' stars and the edges ``shared`` give first groups. Buckets with more than
    three members that then still hold several groups are open: their members of different
    groups are held against bitmaps, which bound the similarity from above, in tiles of
    bounded size. The groups that this joins are clusters; no link of an open bucket leaves
    one, and all pairs of different groups inside are decided on full sets. The number of
    jobs does not depend on the data.
    """
    links = staged(confirmed(star_candidates(members), docs, sizes, id_col, text_col), "neardup-links")
    first = staged(components(links.unionByName(shared)), "neardup-groups")
    groups = (reps.join(first, "node", "left")
              .select("node", F.coalesce("component", "node").alias("component")))
    rows = members.filter("members > 3").select("key", F.col("doc_id").alias("node"))
    rows = left_open(rows.join(groups, "node").withColumnRenamed("component", "label"))
    rows = staged(rows.join(sizes.select(F.col("doc_id").alias("node"), F.col("n").alias("n_shingles")), "node")
                  .select(F.col("key").alias("cluster"), F.col("node").alias("doc_id"), "n_shingles", "label"),
                  "neardup-open")
    if rows.isEmpty():
        return groups
    open_docs = staged(rows.select("doc_id", "n_shingles", "label").distinct(), "neardup-open")
    texts = keep_ids(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                     F.col("doc_id"), open_docs.select(F.col("doc_id").alias("_wanted")).distinct(), "_wanted")
    bits = staged(texts.mapInArrow(_bits, "doc_id long, n long, bits binary").distinct(), "neardup-bits")
    # What the bitmaps allow inside a bucket makes clusters of groups; all links are in them.
    may = between(met(rows, bits, THRESHOLD, probable(THRESHOLD)), open_docs)
    whole = staged(components(may).select(F.col("node").alias("label"), F.col("component").alias("cluster")),
                   "neardup-clusters")
    near = open_docs.join(whole, "label")
    more = between(met(near, texts.filter("text is not null").distinct(), THRESHOLD, exact(WIDTH, THRESHOLD)),
                   open_docs)
    merged = components(more).toDF("component", "whole")
    return (groups.join(staged(merged, "neardup-merged"), "component", "left")
            .select("node", F.coalesce("whole", "component").alias("component")))


def between(links: DataFrame, labelled: DataFrame) -> DataFrame:
    """The links (a, b) of documents as distinct links of their labels, stored."""
    label = labelled.select("doc_id", "label").distinct()
    pairs = links.join(label.toDF("a", "la"), "a").join(label.toDF("b", "lb"), "b").filter("la <> lb")
    return staged(pairs.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(),
                  "neardup-between")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches):
        words, at = word_hashes(batch.column(1), lower=True)
        sets = [shingles(words[at[i]:at[i + 1]], WIDTH) for i in range(len(batch))]
        ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))],
            names=["doc_id", "shingles"])


def confirmed(pairs: DataFrame, docs: DataFrame, sizes: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The candidate pairs that reach the threshold on their full shingle sets.

    Set sizes alone rule out most false candidates before any set is moved
    (similarity is at most smaller size / larger size); the sets of the documents still
    in question are hashed again from their texts instead of being kept for all.
    """
    num, den = THRESHOLD
    possible = (pairs.join(sizes.select(F.col("doc_id").alias("a"), F.col("n").alias("na")), "a")
                .join(sizes.select(F.col("doc_id").alias("b"), F.col("n").alias("nb")), "b")
                .filter(den * F.least("na", "nb") >= num * F.greatest("na", "nb")))
    possible = staged(possible.select("a", "b"), "neardup-pairs")
    wanted = possible.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    return verified(possible, shingle_sets(docs, wanted, id_col, text_col))


def shingle_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, shingles) of the documents whose id is in ``ids``, stored."""
    texts = keep_ids(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                     F.col("doc_id"), ids.select(F.col("doc_id").alias("_wanted")), "_wanted")
    sets = staged(texts.mapInArrow(_sets, "doc_id long, shingles array<long>"), "neardup-sets")
    return sets.dropDuplicates()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the threshold on their full sets."""
    num, den = THRESHOLD
    both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (both.filter(den * common >= num * (F.size("sa") + F.size("sb") - common))
            .select("a", "b").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: (doc_id, n_shingles, component_id, kept)."""
    sketch = staged(sketches(docs, id_col, text_col), "neardup-sketch")
    prints = ["print_a", "print_b", "n_shingles"]
    linkable = sketch.filter("n_shingles > 0 and doc_id is not null")
    # Equal sets are one class, named by its smallest id; only classes are compared.
    classes = linkable.groupBy(*prints).agg(F.min("doc_id").alias("rep"))
    classes = staged(classes, "neardup-classes")
    reps = linkable.join(classes.withColumnRenamed("rep", "doc_id"), [*prints, "doc_id"], "left_semi")
    members = staged(bucket_members(reps), "neardup-buckets")
    sizes = classes.groupBy(F.col("rep").alias("doc_id")).agg(F.max("n_shingles").alias("n"))
    # Ids on rows of several classes tie those classes together.
    shared = (linkable.select(*prints, "doc_id").join(classes, prints)
              .groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
              .filter("a < b").select("a", "b"))
    groups = linked_groups(classes.select(F.col("rep").alias("node")).distinct(), members, docs, sizes, shared,
                           id_col, text_col)
    classes = (classes.join(groups, classes.rep == groups.node, "left")
               .select(*prints, F.coalesce("component", "rep").alias("component")))
    # Blank texts and null ids have no class; a hot class is a skewed join, which AQE splits.
    return (sketch.drop("bands").join(classes, prints, "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were: one document of each
    group, documents without shingles, and rows with a null id. Of several rows with one
    kept id, the one with the smallest text stays."""
    found = staged(near_duplicates(docs, id_col, text_col), "neardup-result")
    key = F.col(id_col).cast("long")
    gone = found.filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    repeated = staged(found.filter("kept and doc_id is not null").groupBy(F.col("doc_id").alias("_repeated"))
                      .count().filter("count > 1").select("_repeated"), "neardup-repeated")
    kept = keep_ids(docs, key, gone, "_gone", "left_anti")
    if repeated.isEmpty():
        return kept
    one = (keep_ids(kept, key, repeated, "_repeated").groupBy(key.alias("_key"))
           .agg(F.min_by(F.struct(*docs.columns), F.struct(F.col(text_col).isNull(), text_col)).alias("_row"))
           .select("_row.*"))
    return keep_ids(kept, key, repeated, "_repeated", "left_anti").unionByName(one)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


# All pairs that share a shingle; for small tables (the check runs it on sf0.01).
ORACLE = r"""
with recursive sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end s
  from (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents) t),
members as (select doc_id, len(s) n, unnest(s) g from sets where doc_id is not null),
shared as (
  select a.doc_id a, b.doc_id b, any_value(a.n + b.n) n, count(*) c
  from members a join members b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (
  select unnest([a, b]) a, unnest([b, a]) b from shared where 100 * c >= 75 * (n - c)),
reach as (
  select distinct doc_id a, doc_id b from sets where doc_id is not null
  union
  select reach.a, links.b from reach join links on links.a = reach.b),
named as (select a doc_id, min(b) component_id from reach group by a)
select doc_id, len(s)::bigint n_shingles, component_id,
       component_id is not null and doc_id = component_id kept
from sets left join named using (doc_id)
"""
