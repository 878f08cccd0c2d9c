"""op4: mixing sources to target weights on a low-discrepancy schedule.

The mix is a sequence of slots of ``BLOCK`` words. Slot n is given to the source in whose
share of the unit interval the golden-ratio point frac(n / phi) lies, so every source
comes around evenly at every scale. A source's documents are put in a fixed shuffled
order (md5 of the id), and its word stream is cut into blocks of ``BLOCK`` words; the
source's k-th slot takes its k-th block, starting over when the stream ends. Slots past
a source's target are left out, slots that the schedule's small unevenness left it short
of follow at the end, and the last one is cut, so a source's taken words are its target
rounded down.

Targets: the weights 5, 2, 1 in turn over the sources by code point (null last) share all
words; a target stops at ``REPEAT`` times its source's words, and the excess is shared
again by weight until no target is above. A document is never taken more than ``REPEAT``
times, since a stream is read at most so often.

DataFrame functions only. Sources may be many and one may hold any share: ranks and running
sums go over two levels (:func:`running_sum`), points find their source through a grid.

Defined results for odd input: a null or blank text has size 0 and is never taken; rows
that repeat an id are documents of their own, in a fixed order; an empty table gives no
rows; when no source has words all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import WORD_RE, chunk_rows, running_sum, staged, table

WEIGHTS = (5, 2, 1)  # by rank of the source, in turn
REPEAT = 3
BLOCK = 1024         # words of a slot
# frac(n / phi) in whole numbers: n * STEP mod 2**40, STEP the odd number next to 2**40 / phi.
STEP, MODULUS = 679541651741, 1 << 40
SEED = "tarmac-mix:"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD_RE)), F.lit(0))
                       .cast("long").alias("size"))


def ranked_sources(docs: DataFrame) -> DataFrame:
    """(source, source_size, rank): rank from 0 by code point, null last."""
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Dealt by range, written with the part's number, then counted part by part.
    dealt = sources.repartitionByRange(F.col("source").asc_nulls_last())
    dealt = staged(dealt.withColumn("part", F.spark_partition_id()).withColumn("one", F.lit(1).cast("long"))
                   .withColumn("none", F.col("source").isNull()).withColumn("all", F.lit(0)), "sources")
    return running_sum(dealt, ["all"], "part", ["none", "source"], "one", "rank").select(
        "source", "source_size", "rank")


def weighted(ranked: DataFrame) -> DataFrame:
    turn = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    return ranked.withColumn("weight", turn.cast("long"))


def with_targets(sources: DataFrame) -> DataFrame:
    """Adds ``target``: weight * level, but at most ``REPEAT`` * source_size; the level is
    raised until the targets add up to all words."""
    limit = F.col("source_size") * REPEAT
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        over = F.col("weight") * F.lit(level) > limit
        row = sources.agg(F.sum(F.when(over, limit).otherwise(0)).alias("full"),
                          F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weight")).first()
        if not row["weight"]:
            break
        raised = (total - row["full"]) / row["weight"]
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), limit.cast("double")))


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """The slots (slot, rank, nth, block, cut): in (slot, rank) order, source ``rank`` gives
    its ``nth`` block of the mix, its stream's ``block``, of which ``cut`` words are taken.

    ``targets`` has rank, source_size and target. A source needs blocks for its whole
    passes and for the rest of its target.
    """
    size, want = F.col("source_size"), F.floor("target").cast("long")
    blocks = F.ceil(size / F.lit(block)).cast("long")
    needed = (targets.filter("source_size > 0").withColumn("want", want).withColumn("blocks", blocks)
              .withColumn("passes", F.expr("want div source_size"))
              .withColumn("rest", F.expr("want % source_size"))
              .withColumn("need", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / F.lit(block)).cast("long")))
    needed = staged(needed.select("rank", "source_size", "blocks", "passes", "rest", "need"), "mix-sources")
    sums = needed.agg(F.sum("need").alias("slots"), F.count(F.lit(1)).alias("sources")).first()
    slots, n_sources = sums["slots"] or 0, sums["sources"]

    # Shares of [0, MODULUS) in proportion to the blocks needed, cut at whole numbers.
    parted = (needed.withColumn("all", F.lit(0))
              .withColumn("part", F.expr(f"rank div {chunk_rows(n_sources)}")))
    shares = running_sum(parted, ["all"], "part", ["rank"], "need", "before")
    edge = lambda c: F.floor(c.cast("decimal(38,0)") * F.lit(MODULUS) / F.lit(max(slots, 1))).cast("long")
    shares = shares.select("rank", edge(F.col("before")).alias("low"),
                           edge(F.col("before") + F.col("need")).alias("high"))
    # A point meets the shares that touch its grid cell; there are as many cells as sources.
    grid = 1 << max(10, (n_sources - 1).bit_length())
    cell = MODULUS // grid
    touched = shares.filter("low < high").withColumn("cell", F.explode(F.sequence(
        F.expr(f"low div {cell}"), F.expr(f"(high - 1) div {cell}"))))
    n = F.col("slot") + 1
    high, low = F.expr("(slot + 1) div 1048576") % (1 << 20), n % (1 << 20)
    point = ((high * F.lit(STEP) % (1 << 20)) * (1 << 20) + low * F.lit(STEP)) % F.lit(MODULUS)
    points = (slot_range(needed, slots).withColumn("point", point)
              .withColumn("cell", F.expr(f"point div {cell}")))
    given = points.join(touched, "cell").filter("low <= point and point < high").select("slot", "rank")

    # Rank of each slot among its source's, over chunks of the schedule.
    chunked = staged(given.withColumn("chunk", F.expr(f"slot div {chunk_rows(slots)}"))
                     .withColumn("one", F.lit(1).cast("long")), "mix-slots")
    nth = running_sum(chunked, ["rank"], "chunk", ["slot"], "one", "nth").select("slot", "rank", "nth")
    got = chunked.groupBy("rank").agg(F.count(F.lit(1)).alias("got"))
    late = (needed.join(got, "rank", "left").withColumn("got", F.coalesce("got", F.lit(0)))
            .filter("got < need").withColumn("nth", F.explode(F.sequence(F.col("got"), F.col("need") - 1)))
            .select((F.lit(slots) + F.col("nth")).alias("slot"), "rank", "nth"))
    # Slots of a source are narrow rows; its one row of facts is sent to them by a join
    # whose hot keys the adaptive planner splits.
    facts = nth.unionByName(late).join(needed, "rank").filter("nth < need")
    last = (F.col("nth") == F.col("need") - 1) & (F.col("rest") > 0)
    cut = F.when(last, F.col("rest") - (F.col("nth") - F.col("passes") * F.col("blocks")) * block)
    return facts.select("slot", "rank", "nth", (F.col("nth") % F.col("blocks")).alias("block"),
                        F.coalesce(cut, F.lit(block)).alias("cut"))


def slot_range(df: DataFrame, n: int) -> DataFrame:
    return df.sparkSession.range(n).withColumnRenamed("id", "slot")


def streams(docs: DataFrame, n_docs: int) -> DataFrame:
    """Adds ``start``: the words of the same source that come before the document in the
    source's shuffled order. ``docs`` has doc_id, rank and size."""
    order = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    bits = (n_docs // chunk_rows(n_docs)).bit_length()  # about so many buckets: 2 ** bits
    bucket = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    placed = docs.withColumn("order", order).withColumn("bucket", F.shiftright(bucket, 32 - min(bits, 32)))
    return running_sum(placed, ["rank"], "bucket", ["order", "doc_id", "size"], "size", "start").drop("order", "bucket")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, slots, parts) of the mix.

    documents: every row with its rank, start, size, source_size and target. parts: what
    the mix reads, in slot order: words ``first`` to ``end`` (exclusive, counted from 0) of
    the document at ``start`` of source ``rank``.
    """
    rows = staged(sized(docs, id_col, text_col, source_col), "mix-documents")
    sources = staged(with_targets(weighted(ranked_sources(rows))), "mix-targets")
    named = sources.select(F.col("source").alias("_source"), "rank", "source_size", "target")
    placed = streams(rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source"),
                     rows.count())
    placed = staged(placed, "mix-streams")
    slots = staged(schedule(sources, block), "mix-schedule")
    pieces = placed.filter("size > 0").select(
        "doc_id", "rank", "start", "size", F.explode(F.sequence(
            F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"))
    first = F.greatest(F.lit(0).cast("long"), F.col("block") * block - F.col("start"))
    end = F.least(F.col("size"), F.col("block") * block + F.col("cut") - F.col("start"))
    parts = (pieces.join(slots, ["rank", "block"]).withColumn("first", first).withColumn("end", end)
             .filter("first < end").select("slot", "rank", "start", "doc_id", "first", "end"))
    return placed, slots, parts


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          block: int = BLOCK) -> DataFrame:
    """Per document row: (doc_id, size, source_size, target, taken, first_slot, n_slots).

    ``taken`` counts the words that the mix takes of it, repeats included; ``first_slot``
    (null: none) and ``n_slots`` are the schedule's slots that read some of them.
    """
    placed, _, parts = mix(docs, id_col, text_col, source_col, block)
    taken = parts.select("rank", "start", (F.col("end") - F.col("first")).alias("taken"), "slot",
                         F.lit(1).cast("long").alias("n_slots"))
    # A document of some words is known by its place; blank ones are taken from nowhere.
    facts = ("doc_id", "size", "source_size", "target")
    none = F.lit(0).cast("long")
    worded = placed.filter("size > 0").select("rank", "start", *facts, none.alias("taken"), none.alias("n_slots"))
    some = (worded.unionByName(taken, allowMissingColumns=True).groupBy("rank", "start")
            .agg(*[F.max(c).alias(c) for c in facts], F.sum("taken").alias("taken"),
                 F.min("slot").alias("first_slot"), F.sum("n_slots").alias("n_slots")).drop("rank", "start"))
    blank = placed.filter("size = 0").select(*facts, none.alias("taken"), F.lit(None).cast("long").alias("first_slot"),
                                             none.alias("n_slots"))
    return some.unionByName(blank)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


ORACLE = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size
  from documents),
sources as (
  select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) - 1 r
  from sized group by source),
weighted as (select *, ([5, 2, 1])[(r % 3 + 1)::int]::bigint w, 3 * source_size cap from sources),
ordered as (
  select *, row_number() over by_need pos, sum(source_size) over () total,
         coalesce(sum(cap) over (by_need rows between unbounded preceding and 1 preceding), 0) before,
         sum(w) over (by_need rows between current row and unbounded following) open_w
  from weighted window by_need as (order by cap::double / w, r)),
levels as (select *, (total - before)::double / open_w::double lev from ordered),
chosen as (select coalesce(arg_min(lev, pos) filter (where w * lev <= cap), 0) lev from levels),
targets as (
  select source, source_size, least(w * chosen.lev, cap::double) target from weighted, chosen),
wanted as (
  select *, row_number() over (order by source nulls last) - 1 r, (source_size + 1023) // 1024 blocks,
         case when source_size > 0 then floor(target)::bigint // source_size else 0 end passes,
         case when source_size > 0 then floor(target)::bigint % source_size else 0 end rest
  from targets),
needs as (select *, passes * blocks + (rest + 1023) // 1024 need from wanted),
shares as (
  select *, sum(need) over ()::hugeint slots, coalesce(sum(need) over (
           order by r rows between unbounded preceding and 1 preceding), 0)::hugeint before
  from needs where source_size > 0),
points as (
  select slot, ((slot + 1)::hugeint * 679541651741) % 1099511627776 point
  from (select unnest(range(coalesce(max(slots), 0)::bigint)) slot from shares)),
given as (
  select slot, r, row_number() over (partition by r order by slot) - 1 nth
  from points, shares
  where point >= before * 1099511627776 // slots and point < (before + need) * 1099511627776 // slots),
got as (select r, count(given.slot) got, max(need) need, max(slots)::bigint slots
        from shares left join given using (r) group by r),
turns as (
  select slot, r, nth from given
  union all
  select slots + nth, r, nth from (select *, unnest(range(got, need::bigint)) nth from got)),
slots as (
  select slot, r, nth % blocks block,
         case when nth = need - 1 and rest > 0 then rest - (nth - passes * blocks) * 1024 else 1024 end cut
  from turns join needs using (r) where nth < need),
streams as (
  select *, row_number() over () row_id, coalesce(sum(size) over (
           partition by source order by md5('tarmac-mix:' || doc_id), doc_id, size
           rows between unbounded preceding and 1 preceding), 0) start
  from sized),
pieces as (
  select row_id, r, start, size, unnest(range(start::bigint // 1024, (start + size - 1)::bigint // 1024 + 1)) block
  from streams join wanted on streams.source is not distinct from wanted.source where size > 0),
used as (
  select row_id, min(slot) first_slot, count(*) n_slots
  from pieces join slots using (r, block)
  where least(size, block * 1024 + cut - start) > greatest(0, block * 1024 - start)
  group by row_id)
select doc_id, size, source_size, target,
       (passes * size + greatest(0, least(size, rest - start)))::bigint taken,
       first_slot::bigint first_slot, coalesce(n_slots, 0)::bigint n_slots
from streams join wanted on streams.source is not distinct from wanted.source left join used using (row_id)
"""
