"""Keyed-table semantics as DataFrame operators.

The original store treats every append as an upsert by primary key: written columns
replace the stored ones (a written null included), columns not written keep their
value, and a key seen for the first time becomes a new row. These operators compute
the next version of a table; ``sources.files.write_table`` writes it.

D-01 ``upsert`` (partial-column upsert) and ``update_where`` (its narrow special case)
D-02 ``dedupe_keys`` (primary-key uniqueness)
D-03 ``rekey`` (change a key column: copy under the new key, delete the old rows)
D-04 ``delete_where`` (delete by key value)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.joins import BROADCAST_MAX_ROWS, fits_broadcast
from tarmac.session import scratch_path
from tarmac.sources.files import materialize

_HIT = "__written"


def dedupe_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                descending: bool = False) -> DataFrame:
    """D-02: one row per key — the first by ``order_by`` then all remaining columns
    (ascending, nulls first; ``descending=True`` keeps the last).

    Expressed as a grouped min/max of a struct, so Spark combines rows map-side before
    the shuffle: a key repeated across a third of the table is reduced to one row per
    task first instead of being sorted in one task as a window would.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by or [])
    ranked = order + [c for c in rest if c not in order]
    if not ranked:
        return df.select(*keys).distinct()
    pick = F.max if descending else F.min
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(ranked)]
    best = df.groupBy(*keys).agg(pick(F.struct(*fields)).alias("_best"))
    back = {c: F.col(f"_best._o{i}").alias(c) for i, c in enumerate(ranked)}
    return best.select(*[F.col(c) if c in keys else back[c] for c in df.columns])


def dedupe_keys_measured(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                         descending: bool = False,
                         max_broadcast_keys: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """D-02 for a stored table (cheap to read twice): same result as :func:`dedupe_keys`.

    First counts rows per key reading only the key columns (hash partial aggregation)
    and measures how many keys repeat (stored, so that this runs once). None: the table is returned as is, no shuffle.
    Up to ``max_broadcast_keys`` (and the byte bound): only rows of repeated keys are deduplicated; all other
    rows pass through a broadcast anti join. More: the full :func:`dedupe_keys`.
    Keys are matched null-safely, so null keys are grouped as in :func:`dedupe_keys`.
    """
    keys = list(keys)
    repeated = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > 1).select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
    repeated = materialize(repeated, scratch_path(df.sparkSession, "repeated-keys"))
    n = repeated.count()
    if n == 0:
        return df
    if not fits_broadcast(repeated, n, max_broadcast_keys):
        return dedupe_keys(df, keys, order_by, descending)
    b = F.broadcast(repeated)
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(b[f"_k_{k}"])
        cond = c if cond is None else cond & c
    single = df.join(b, cond, "left_anti")
    multi = dedupe_keys(df.join(b, cond, "left_semi"), keys, order_by, descending)
    return single.unionByName(multi.select(*df.columns))


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Column | object]) -> DataFrame:
    """D-01 when the written rows are selected from the table itself.

    ``select(keys).filter(pred).withColumn(c, v)`` appended as an upsert only touches
    keys already present, so with unique keys the result equals an in-place
    conditional update: one narrow projection, no join and no shuffle.
    """
    out = []
    for c in df.columns:
        if c in assignments:
            v = assignments[c]
            v = v if isinstance(v, Column) else F.lit(v)
            out.append(F.when(predicate, v.cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    unknown = set(assignments) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    return df.select(*out)


def upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], *,
           max_broadcast_rows: int = BROADCAST_MAX_ROWS, delta_rows: int | None = None) -> DataFrame:
    """D-01: apply ``delta`` (keys + any subset of columns) to ``base``.

    Written columns win even when null; unwritten columns keep the base value; new
    keys become rows with nulls in unwritten columns. ``delta`` must be unique on
    ``keys`` (run :func:`dedupe_keys` first otherwise).

    Null key parts are refused (the store refuses them).

    Strategy: the delta is stored once and measured. Within ``max_broadcast_rows`` and
    the byte bound it is broadcast: base rows stream through a broadcast left join (no
    shuffle of the base), and brand-new keys are those not among the base's distinct
    keys that the delta has, which are no more than the delta's rows. A larger delta uses
    a full outer join that shuffles both sides on the keys.
    """
    keys = list(keys)
    written = [c for c in delta.columns if c not in keys]
    unknown = set(delta.columns) - set(base.columns)
    if unknown:
        raise ValueError(f"delta has columns not in base: {sorted(unknown)}")
    delta = materialize(delta, scratch_path(delta.sparkSession, "upsert-delta"))
    d = delta.select(*keys, *[F.col(c).alias(f"_d_{c}") for c in written], F.lit(True).alias(_HIT))
    bad = [F.count(F.when(F.col(k).isNull(), 1)).alias(k) for k in keys]
    seen = delta.agg(F.count(F.lit(1)).alias("_rows"), *bad).first()
    if any(seen[k] for k in keys):
        raise ValueError(f"delta has null key parts: {', '.join(keys)}")
    n = seen["_rows"] if delta_rows is None else delta_rows

    def merged(src: DataFrame) -> DataFrame:
        cols = []
        for c in base.columns:
            if c in written:
                cols.append(F.when(F.col(_HIT), F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c))
            else:
                cols.append(F.col(c))
        return src.select(*cols)

    if fits_broadcast(delta, n, max_broadcast_rows):
        small = F.broadcast(d)
        updated = merged(base.join(small, keys, "left").fillna(False, subset=[_HIT]))
        present = base.select(*keys).join(F.broadcast(d.select(*keys)), keys, "left_semi").distinct()
        fresh = d.join(F.broadcast(present), keys, "left_anti")
        inserted = fresh.select(*[
            (F.col(c) if c in keys else F.col(f"_d_{c}") if c in written
             else F.lit(None).cast(base.schema[c].dataType)).alias(c)
            for c in base.columns])
        return updated.unionByName(inserted)

    joined = base.withColumn("_in_base", F.lit(True)).join(d, keys, "full_outer")
    cols = []
    for c in base.columns:
        if c in written:
            cols.append(F.when(F.col(_HIT).isNotNull(), F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return joined.select(*cols)


def delete_where(df: DataFrame, column: str, value) -> DataFrame:
    """D-04: drop rows whose ``column`` equals ``value`` (null-safe)."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def rekey(df: DataFrame, keys: Sequence[str], column: str, src, tgt, *,
          max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """D-03 + D-04: move rows with ``column == src`` to ``column = tgt`` (a key column).

    Moved rows overwrite rows already stored under the new key. Only rows whose
    ``column`` is ``src`` or ``tgt`` can collide; every other row passes through
    untouched without a shuffle. The rows already under ``tgt`` are measured: when
    they fit the broadcast bound (the usual case — a new code has few or no rows),
    the colliding keys are found by streaming the moved keys through a broadcast semi
    join, so the moved rows (possibly a third of the table) are never shuffled.
    Otherwise an anti join shuffles both sides on the full key (high-cardinality).
    """
    keys = list(keys)
    if column not in keys:
        raise ValueError(f"{column} is not a key column; use update_where")
    if src == tgt:
        return df
    c = F.col(column)
    untouched = df.filter(~(c.eqNullSafe(F.lit(src)) | c.eqNullSafe(F.lit(tgt))))
    moved = df.filter(c.eqNullSafe(F.lit(src))).withColumn(column, F.lit(tgt).cast(df.schema[column].dataType))
    existing = df.filter(c.eqNullSafe(F.lit(tgt)))
    def same(a: DataFrame, b: DataFrame) -> Column:  # null key parts are equal
        return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys])

    def named(x: DataFrame) -> DataFrame:
        return x.select(*[F.col(k).alias(f"_k_{k}") for k in keys])

    if fits_broadcast(existing.select(*keys), existing.count(), max_broadcast_rows):
        there = F.broadcast(named(existing).distinct())
        met = moved.select(*keys)
        colliding = named(met.join(there, same(met, there), "left_semi").distinct())
        survivors = existing.join(F.broadcast(colliding), same(existing, colliding), "left_anti")
    else:
        gone = named(moved)
        survivors = existing.join(gone, same(existing, gone), "left_anti")
    return untouched.unionByName(survivors.select(*df.columns)).unionByName(moved.select(*df.columns))


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null key part (the store refuses them; R3)."""
    cond = None
    for k in keys:
        cond = F.col(k).isNull() if cond is None else cond | F.col(k).isNull()
    return df.filter(cond)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.filter(cond)
