"""Near matches of labels (U4): set-similarity join on character q-grams.

Labels that no shared name matches ("Réseaux" and "Réseau") are compared by the
Jaccard similarity of their sets of q-grams, without a cross join: grams
are ordered from rare to frequent over both sides, and two sets that are
similar enough must share one of their first few grams (their prefix), so only
labels with a common prefix gram, and with sizes that allow the similarity, meet.
Frequent grams stand at the end of the order and never lead a
pair to be compared; no gram is dropped by a count. Each pair is met at its first common
prefix gram alone, then verified exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of a gram; least similarity in percent.
Q, LEAST = 3, 60


def grams(label: Column | str, q: int = Q) -> Column:
    """Distinct q-grams of the lower-cased label, its ends padded."""
    c = F.col(label) if isinstance(label, str) else label
    s = F.concat(F.lit("#" * (q - 1)), F.lower(c), F.lit("#" * (q - 1)))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - (q - 1)), lambda i: F.substring(s, i, F.lit(q))))


def _sided(df: DataFrame, col: str, side: str, q: int) -> DataFrame:
    labels = df.select(F.col(col).alias("label")).dropna().where("label <> ''").distinct()
    return labels.select("label", F.lit(side).alias("side"), grams("label", q).alias("grams"))


def near_matches(a: DataFrame, a_col: str, b: DataFrame, b_col: str, least: int = LEAST, q: int = Q) -> DataFrame:
    """(a_col, b_col, shared, total): all pairs of different labels with 100 * shared >= least * total grams."""
    if not 0 < least <= 100:
        raise ValueError("least must be a percentage above 0")
    both = _sided(a, a_col, "a", q).unionByName(_sided(b, b_col, "b", q))
    each = both.select("label", "side", F.explode("grams").alias("gram"))
    frequency = each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    ordered = (each.join(frequency, "gram").groupBy("side", "label")  # a label's own grams: bounded by its length
               .agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("g")))
    size = F.size("g")
    # two sets of that similarity share at least ceil(least % of the size) grams of either
    prefix = size - F.ceil(size * least / F.lit(100)).cast("int") + 1
    sets = ordered.select("side", "label", "g", F.slice("g", F.lit(1), prefix).alias("prefix"))

    def met(side: str, name: str) -> DataFrame:
        return sets.where(F.col("side") == side).select(
            F.col("label").alias(name), F.col("g").alias(f"g_{side}"), F.col("prefix").alias(f"p_{side}"), F.explode("prefix").alias("gram"))

    na, nb = F.size("g_a"), F.size("g_b")
    pairs = (met("a", a_col).join(met("b", b_col), "gram")
             .where((100 * F.least(na, nb) >= least * F.greatest(na, nb)) & (F.col(a_col) != F.col(b_col)))
             .where(F.element_at(F.array_intersect("p_a", "p_b"), 1) == F.col("gram"))
             .withColumn("shared", F.size(F.array_intersect("g_a", "g_b")))
             .withColumn("total", na + nb - F.col("shared")))
    return pairs.where(100 * F.col("shared") >= least * F.col("total")).select(a_col, b_col, "shared", "total")
