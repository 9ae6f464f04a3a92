"""Two-source value standardisation (C8: S7, A14, F5, F1, J11, F6, F24, F16, J12,
U3, O5, A13, P17, K9, U4, P16, O2).

Two lists of labels for the same attribute, one per source, are matched by the
names they share: each label is split into names, the name lists are
exploded and joined, and a pair of labels that shares at least two names
(counted with repetition, T25) is a match. The standard label of a match is
the sorted union of both name sets. The result is two mapping tables
(label -> standard label, only where the label changes) and a review table
of the labels left unmatched.

Scale: a label's names are few, so its 2-token keys are bounded per row; the
match is an equi-join on those keys, so a name shared by many labels never
produces the pairs of its whole group (see ``candidate_pairs``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.functions.arrays import set_differs, set_union, sorted_join, token_set
from listingmart.functions.text import split_names


def prepare(values: DataFrame, col: str, name: str) -> DataFrame:
    """A14 + F6 + F24: distinct labels, their names and name sets."""
    v = values.select(F.col(col).alias(name)).where(F.col(name).isNotNull()).distinct()
    return (v.withColumn(f"{name}_names", split_names(name))
            .withColumn(f"{name}_set", token_set(f"{name}_names")))


def outer_match(a: DataFrame, b: DataFrame, a_col: str, b_col: str) -> DataFrame:
    """Full outer match of the two label lists on equal text (NULL-safe)."""
    return a.select(a_col).join(b.select(b_col), F.col(a_col).eqNullSafe(F.col(b_col)), "full_outer")


def _token_counts(df: DataFrame, col: str) -> DataFrame:
    """(label, token, multiplicity) for one side."""
    return (df.select(col, F.explode(f"{col}_names").alias("_t"))
            .groupBy(col, "_t").agg(F.count(F.lit(1)).alias("_c")))


def _pair_keys(df: DataFrame, col: str, with_repeats: bool) -> DataFrame:
    """Every 2-token key of a label: (t1 < t2) over its distinct tokens, plus (t, t)
    for a token it repeats. A label has few tokens, so this is bounded per row."""
    d = F.array_sort(F.array_distinct(F.col(f"{col}_names")))
    pairs = F.flatten(F.transform(d, lambda x, i: F.transform(
        F.slice(d, i + 2, F.greatest(F.size(d), F.lit(1))), lambda y: F.struct(x.alias("t1"), y.alias("t2")))))
    if with_repeats:
        names = F.col(f"{col}_names")
        rep = F.transform(F.filter(d, lambda x: F.size(F.filter(names, lambda y: y == x)) >= 2),
                          lambda x: F.struct(x.alias("t1"), x.alias("t2")))
        pairs = F.concat(pairs, rep)
    return df.select(col, F.explode(pairs).alias("_k")).select(col, "_k.t1", "_k.t2")


def candidate_pairs(a: DataFrame, b: DataFrame, a_col: str, b_col: str,
                    distinct_names: bool = False) -> DataFrame:
    """Label pairs that can share >= 2 names, found without listing every pair
    that shares a single name.

    Route 1: equal 2-token keys (two distinct shared names, or a name repeated
    on both sides). Route 2 (repetitions counted, T25): a name one side
    repeats, shared once by the other. Every candidate is a true match, so the
    work grows with the output, not with the size of a common name's group.
    """
    ka, kb = _pair_keys(a, a_col, not distinct_names), _pair_keys(b, b_col, not distinct_names)
    out = ka.join(kb, ["t1", "t2"]).select(a_col, b_col)
    if not distinct_names:
        ca, cb = _token_counts(a, a_col), _token_counts(b, b_col)
        heavy_a = ca.where("_c >= 2").select(a_col, "_t").join(cb.select(b_col, "_t"), "_t")
        heavy_b = cb.where("_c >= 2").select(b_col, "_t").join(ca.select(a_col, "_t"), "_t")
        out = out.unionByName(heavy_a.select(a_col, b_col)).unionByName(heavy_b.select(a_col, b_col))
    return out.distinct()


def matched_pairs(a: DataFrame, b: DataFrame, a_col: str, b_col: str, min_shared: int = 2,
                  distinct_names: bool = False) -> DataFrame:
    """J12 + A13 + U3 + O5 + P17: label pairs sharing at least ``min_shared`` (>= 2) names.

    The shared count is the number of rows the reference's token join gives a
    pair: the sum over common names of their multiplicities' product (T25);
    with ``distinct_names`` the number of distinct common names.
    """
    if min_shared < 2:
        raise ValueError("min_shared must be at least 2")
    cand = candidate_pairs(a, b, a_col, b_col, distinct_names)
    ca, cb = _token_counts(a, a_col), _token_counts(b, b_col)
    if distinct_names:
        ca, cb = ca.withColumn("_c", F.lit(1)), cb.withColumn("_c", F.lit(1))
    shared = (cand.join(ca, a_col).join(cb.withColumnRenamed("_c", "_cb"), [b_col, "_t"])
              .groupBy(a_col, b_col).agg(F.sum(F.col("_c") * F.col("_cb")).alias("shared_names"))
              .where(F.col("shared_names") >= min_shared))
    pairs = shared.join(a, a_col).join(b, b_col)
    union = set_union(f"{a_col}_set", f"{b_col}_set")
    return pairs.select(
        a_col, b_col, "shared_names",
        sorted_join(union).alias("union_str"),
        set_differs(union, f"{a_col}_set").alias(f"replace_{a_col}"),
        set_differs(union, f"{b_col}_set").alias(f"replace_{b_col}"),
    )


def matched_token_rows(a: DataFrame, b: DataFrame, a_col: str, b_col: str) -> DataFrame:
    """J12 as the reference keeps it: the token-join rows of matched pairs only
    (label pair, shared name, rows it contributes)."""
    m = matched_pairs(a, b, a_col, b_col).select(a_col, b_col)
    ca, cb = _token_counts(a, a_col), _token_counts(b, b_col)
    return (m.join(ca, a_col).join(cb.withColumnRenamed("_c", "_cb"), [b_col, "_t"])
            .select(a_col, b_col, F.col("_t").alias("name"), (F.col("_c") * F.col("_cb")).alias("n")))


def mapping_table(pairs: DataFrame, col: str) -> DataFrame:
    """K9: label -> standard label where the label changes (distinct pairs)."""
    return (pairs.where(F.col(f"replace_{col}"))
            .select(F.col(col).alias("old_value"), F.col("union_str").alias("new_value"))
            .distinct())


def unmatched(a: DataFrame, b: DataFrame, map_a: DataFrame, map_b: DataFrame,
              a_col: str, b_col: str) -> DataFrame:
    """P16 + U4: labels of each side not in its mapping, matched outer on equal text."""
    ua = a.select(a_col).join(map_a.select(F.col("old_value").alias(a_col)), a_col, "left_anti")
    ub = b.select(b_col).join(map_b.select(F.col("old_value").alias(b_col)), b_col, "left_anti")
    return outer_match(ua, ub, a_col, b_col)


def standardise_values(values_a: DataFrame, col_a: str, values_b: DataFrame, col_b: str,
                       name_a: str = "source_a", name_b: str = "source_b",
                       min_shared: int = 2) -> dict[str, DataFrame]:
    """C8 end to end: returns ``pairs``, ``map_a``, ``map_b`` and ``unmatched`` frames."""
    a = prepare(values_a, col_a, name_a)
    b = prepare(values_b, col_b, name_b)
    pairs = matched_pairs(a, b, name_a, name_b, min_shared)
    map_a, map_b = mapping_table(pairs, name_a), mapping_table(pairs, name_b)
    return {"pairs": pairs.orderBy(name_a), "map_a": map_a, "map_b": map_b,
            "unmatched": unmatched(a, b, map_a, map_b, name_a, name_b)}
