"""Id -> label lookups and label translation.

A lookup list is small (hundreds to ten thousand entries) but not fixed, so it
is broadcast only after its rows and bytes were summed; beyond the bound the
join is left to the planner (sort-merge, or AQE's runtime broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.functions.arrays import all_in_language, struct_labels

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame):
    """Estimated bytes of a row: 8 per column and the text of strings and nested values."""
    atomic = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz")
    out = F.lit(8 * max(1, len(df.columns))).cast("long")
    for i, (_, kind) in enumerate(df.dtypes):
        if kind not in atomic:
            out = out + F.coalesce(F.octet_length(F.col(f"_{i}").cast("string")), F.lit(0))
    return out


def _sized(df: DataFrame) -> DataFrame:
    """One row (n, bytes): a partial sum per task, so no task sees more than one row of each other."""
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(plain)), F.lit(0)).alias("bytes"))


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    r = _sized(df).first()
    return r["n"] <= max_rows and r["bytes"] <= max_bytes


def fits_many(frames: dict[str, DataFrame], max_rows: int = BROADCAST_MAX_ROWS,
              max_bytes: int = BROADCAST_MAX_BYTES) -> dict[str, bool]:
    """``fits`` for several frames in one Spark job (one row per frame)."""
    from functools import reduce
    parts = [_sized(df).withColumn("_name", F.lit(name)) for name, df in frames.items()]
    sizes = {r["_name"]: r for r in reduce(lambda a, b: a.unionByName(b), parts).collect()}
    return {name: sizes[name]["n"] <= max_rows and sizes[name]["bytes"] <= max_bytes for name in frames}


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint for a side whose size is proven bounded, else unchanged."""
    return F.broadcast(df) if fits(df, max_rows) else df


def dedupe_lookup(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """One label per id (the smallest), NULL ids dropped, so a join cannot fan out."""
    return (lookup.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.min(value).alias(value)))


def replace_ids(df: DataFrame, lookup: DataFrame, df_key: str, lookup_key: str, source_name: str,
                final_name: str, how: str = "left", bounded: bool = True) -> DataFrame:
    """Replace an id column by the lookup's label; both key columns are dropped.

    A NULL id gets a NULL label (never matches).
    """
    raw = lookup.select(lookup_key, source_name)
    small = bounded and fits(raw)  # the raw list bounds the de-duplicated one
    lk = dedupe_lookup(raw, lookup_key, source_name)
    lk = lk.withColumnRenamed(lookup_key, "_lk_key").withColumnRenamed(source_name, final_name)
    if small:
        lk = F.broadcast(lk)
    out = df.join(lk, df[df_key] == lk["_lk_key"], how)
    return out.drop("_lk_key", df_key)


def regroup_array(exploded: DataFrame, key: list[str], pos: str, value: str,
                  out: str | None = None) -> DataFrame:
    """Collect exploded values back into a list, in position order, NULLs kept.

    A group is one row's list, so its size is bounded by the list length.
    """
    out = out or value
    collected = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))))
    return exploded.groupBy(*key).agg(F.transform(collected, lambda x: x["v"]).alias(out))


def label_translation(df: DataFrame, key: str, attributes: dict[str, DataFrame],
                      lang: str = "fr", null_as_null_element: bool = True) -> DataFrame:
    """Lists of ``{id, label, lang}`` -> lists of labels in ``lang``, order kept.

    For each attribute, a row whose elements are all in ``lang`` (P13) just
    takes the labels (F18). The other rows (P14) are exploded with positions
    (F16), their ids looked up in the attribute's list (J10, left join, so an
    unknown id gives a NULL label) and regrouped (A9). All attributes are
    handled in one explode, one broadcast join and one regroup, then joined back
    on the (unique) row key. The input is read twice (elements, join back):
    callers should pass a materialised frame.

    ``null_as_null_element``: a NULL or empty list becomes a list holding one
    NULL (the reference's explode/regroup path, trap T2); otherwise it is kept.
    """
    names = list(attributes)
    flags = {a: all_in_language(a, lang) for a in names}
    # Long form of the elements that need the lookup, all attributes in one pass.
    el = "array<struct<_attr:string,_pos:int,_id:string>>"

    def tag(a):
        return lambda x, i: F.struct(F.lit(a).alias("_attr"), i.alias("_pos"),
                                     x["id"].cast("string").alias("_id"))

    tagged = F.concat(*[F.when(~flags[a], F.transform(F.col(a), tag(a))).otherwise(F.array().cast(el))
                        for a in names])
    todo = df.select(F.col(key), F.explode(tagged).alias("_e")).select(key, "_e.*")
    raw = None
    for a, lk in attributes.items():
        one = lk.select(F.lit(a).alias("_attr"), F.col("id").cast("string").alias("_id"),
                        F.col("label").alias("_tr"))
        raw = one if raw is None else raw.unionByName(one)
    # The raw lists bound the de-duplicated one: prove the bound without a shuffle.
    bounded = fits(raw)
    lookups = raw.where(F.col("_id").isNotNull()).groupBy("_attr", "_id").agg(F.min("_tr").alias("_tr"))
    if bounded:
        lookups = F.broadcast(lookups)
    joined = todo.join(lookups, (todo["_attr"] == lookups["_attr"]) & (todo["_id"] == lookups["_id"]), "left") \
        .select(todo[key], todo["_attr"], "_pos", "_tr")
    # collect_list drops the NULLs produced for the other attributes.
    regrouped = joined.groupBy(key).agg(*[
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_attr") == a, F.struct("_pos", "_tr")))),
                    lambda x: x["_tr"]).alias(f"_{a}_tr")
        for a in names])
    out = df.join(regrouped, key, "left")
    sel = []
    for c in df.columns:
        if c in flags:
            labels = struct_labels(c)
            if null_as_null_element:
                labels = F.when(F.col(c).isNull() | (F.size(c) == 0),
                                F.array(F.lit(None).cast("string"))).otherwise(labels)
            sel.append(F.when(flags[c], labels).otherwise(F.col(f"_{c}_tr")).alias(c))
        else:
            sel.append(F.col(c))
    return out.select(*sel)
