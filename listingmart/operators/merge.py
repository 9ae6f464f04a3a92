"""Upsert and insert-if-absent over immutable parquet tables.

Parquet has no row-level MERGE, so each operator returns the new content as a
DataFrame; ``sources.store.TableStore`` writes it to a new version (or
overwrites only the touched date partitions) and never overwrites what is
being read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingmart.operators.lookup import fits


def _key_cond(t: DataFrame, s: DataFrame, keys: list[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = t[k].eqNullSafe(s[k]) if null_safe else (t[k] == s[k])
        cond = c if cond is None else cond & c
    return cond


def _merge_rows(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
                null_safe: bool) -> DataFrame:
    cols = target.columns
    t = target.select(*cols, F.lit(True).alias("_t"))
    s = source.select(*cols, F.lit(True).alias("_s"))
    j = t.alias("t").join(s.alias("s"), _key_cond(t, s, keys, null_safe), "full_outer")
    s_present, t_present = F.col("s._s").isNotNull(), F.col("t._t").isNotNull()
    out = []
    for c in cols:
        if c in keys or c in update_cols:
            out.append(F.when(s_present, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(t_present, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*out)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
           null_safe: bool = False, max_broadcast_keys: int = 5_000_000) -> DataFrame:
    """M1: insert new keys; on a key match overwrite only ``update_cols``.

    Columns not listed keep the target's value (T16). With ``null_safe=False``
    (default, as the reference's UNIQUE constraint) a NULL key part never
    matches, so such source rows are always inserted (T9). ``source`` must be
    unique on ``keys``. Running the same upsert twice changes nothing.

    Plan: when the batch's keys are proven to be at most ``max_broadcast_keys``
    (and within the broadcast's byte bound), they are broadcast and the target is split map-side
    into untouched rows (left-anti, no shuffle) and touched rows (left-semi);
    only the touched rows meet the batch in a full outer join. Beyond the
    bound, one full outer join of target and batch (sort-merge; a full outer join's
    skewed keys are not split).
    """
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise KeyError(f"source lacks {missing}")
    source = source.select(*cols)
    src_keys = source.select(*keys)
    if not fits(src_keys, max_broadcast_keys):
        return _merge_rows(target, source, keys, update_cols, null_safe)
    bk = F.broadcast(src_keys.dropDuplicates())
    cond = _key_cond(target, bk, keys, null_safe)
    touched = target.join(bk, cond, "left_semi")
    untouched = target.join(bk, cond, "left_anti")
    return untouched.unionByName(_merge_rows(touched, source, keys, update_cols, null_safe))


def upsert_in_place(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
                    max_broadcast_keys: int = 5_000_000) -> DataFrame:
    """M1 that leaves the target's rows where they are: ``upsert`` without a shuffle of the target.

    For a source proven small: the target's rows meet the broadcast source in a left join, and the
    source's new rows are those whose key the target lacks (its keys that the
    source has too, so at most one for each source row as keys are unique in
    the target, are broadcast back). Beyond the bound: one full outer join. NULL key parts never match (T9).
    """
    cols = target.columns
    source = source.select(*cols)
    if not fits(source, max_broadcast_keys):
        return _merge_rows(target, source, keys, update_cols, False)
    s = F.broadcast(source.select(*cols, F.lit(True).alias("_s"))).alias("s")
    t = target.alias("t")
    met = F.col("s._s").isNotNull()
    old = t.join(s, _key_cond_named(keys), "left").select(*[
        (F.when(met, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in update_cols else F.col(f"t.{c}")).alias(c) for c in cols])
    shared = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi")
    return old.unionByName(source.join(F.broadcast(shared), keys, "left_anti").select(*cols))


def _key_cond_named(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    return cond


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str],
                     null_safe: bool = False, max_broadcast_keys: int = 5_000_000, distinct: bool = False) -> DataFrame:
    """Only the source rows whose key is not yet in the target (distinct).

    Returns the rows to append (ON CONFLICT DO NOTHING): a de-duplication of
    the source plus a left-anti join on the keys. When the batch's keys are
    proven bounded they are broadcast first, so the (growing) target is only
    filtered map-side and just its matching rows meet the batch. ``distinct``: the
    source is known to be distinct on ``keys``.
    """
    src = source if distinct else source.dropDuplicates(keys)
    tk = target.select(*keys)
    if not null_safe:
        tk = tk.dropna()
    src_keys = src.select(*keys)
    if fits(src_keys, max_broadcast_keys):
        tk = tk.join(F.broadcast(src_keys), _key_cond(tk, src_keys, keys, null_safe), "left_semi")
    if null_safe:
        return src.join(tk, _key_cond(src, tk, keys, True), "left_anti")
    return src.join(tk, keys, "left_anti")


def upsert_location_region(dim_location: DataFrame, members: DataFrame,
                           overwrite_region: bool, unknown: str = "Inconnu") -> DataFrame:
    """M3: new (city, state, country) members and region updates.

    ``members`` has city, state, region, country. One row per place is kept
    first (T14: ``max(region)`` ignoring the unknown label). With
    ``overwrite_region`` (source B) an existing place takes the new region;
    otherwise (source A) existing places are left alone. Returns the rows to
    write: updated existing members plus new members without ids.
    """
    keys = ["city", "state", "country"]
    region = F.when(F.col("region") != unknown, F.col("region"))
    per_place = (members.groupBy(*keys)
                 .agg(F.coalesce(F.max(region), F.max("region"), F.lit(unknown)).alias("region")))
    existing = dim_location.alias("d").join(per_place.alias("m"), keys, "inner")
    updated = existing.select(
        "d.location_id", *keys,
        (F.col("m.region") if overwrite_region else F.col("d.region")).alias("region"))
    new = per_place.join(dim_location.select(*keys), keys, "left_anti")
    return updated, new
