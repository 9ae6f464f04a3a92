"""Label classes (K9, F23): connected components of the match graph, one standard label each.

Pairwise matches give a label several standard labels (one for each partner), so
a table of pairs is no mapping. Here matched labels form classes: the
components of the graph whose edges are the matched pairs. A class's standard
label is the sorted union of its labels' names, so every label has one
target, a standard label maps to itself, and applying the mapping never multiplies rows.
Labels that had several pairwise targets are listed for review.

Components are found by alternating large and small stars: in each round every
label links its neighbours to the least label it knows, so a class of any
shape shrinks to a star in a number of rounds that grows with the logarithm
of its size. A round is two aggregations and two joins on labels and is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.functions.arrays import sorted_join
from listingmart.functions.text import split_names
from listingmart.operators.lookup import fits
from listingmart.session import cut_lineage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round on edges (u, v), u < v: link every label's larger (or smaller) neighbours to its least one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:
        linked = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v")
    else:
        linked = (both.where("v < u").join(least, "u").select(F.col("m").alias("u"), "v")
                  .unionByName(least.where("m < u").select(F.col("m").alias("u"), F.col("u").alias("v"))))
    return linked.where("u < v").distinct()


def _state(edges: DataFrame) -> tuple:
    """What tells two rounds' edges apart: their number and two order-free hashes."""
    h = [F.xxhash64("u", "v").cast("decimal(20, 0)"), F.hash("u", "v").cast("decimal(20, 0)")]
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h[0]), F.sum(h[1])).first())


def components(pairs: DataFrame, a_col: str, b_col: str) -> DataFrame:
    """(label, root): every label of ``pairs`` with the least label of its component."""
    ends = pairs.select(F.col(a_col).alias("a"), F.col(b_col).alias("b")).dropna()
    edges = cut_lineage(ends.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    before, now = None, _state(edges)
    while before != now:
        edges = cut_lineage(_stars(_stars(edges, True), False))
        before, now = now, _state(edges)
    alone = ends.select(F.explode(F.array("a", "b")).alias("label")).distinct()
    return alone.join(edges.select(F.col("v").alias("label"), "u"), "label", "left").select(
        "label", F.coalesce("u", "label").alias("root"))


def label_classes(pairs: DataFrame, a_col: str, b_col: str, target: str = "union_str") -> DataFrame:
    """(label, root, standard, targets): class, standard label, and how many pairwise targets the label had."""
    found = components(pairs, a_col, b_col)
    names = found.select("label", "root", F.explode(split_names("label")).alias("name"))
    standard = names.groupBy("root").agg(sorted_join(F.collect_set("name")).alias("standard"))
    sides = pairs.select(F.col(a_col).alias("label"), F.col(target)).unionByName(pairs.select(F.col(b_col).alias("label"), F.col(target)))
    targets = sides.groupBy("label").agg(F.count_distinct(target).alias("targets"))
    return found.join(standard, "root").join(targets, "label").select("label", "root", "standard", "targets")


def class_mapping(classes: DataFrame) -> DataFrame:
    """K9: (old_value, new_value), one row for each label that changes."""
    return classes.where("label <> standard").select(F.col("label").alias("old_value"), F.col("standard").alias("new_value"))


def ambiguous_labels(classes: DataFrame) -> DataFrame:
    """For review: labels with several pairwise targets, with the class they came to."""
    return classes.where("targets > 1").select("label", "standard", "targets")


def apply_mapping(df: DataFrame, col: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    """``col`` through the mapping, unmapped and NULL values unchanged; never more or fewer rows.

    A mapping that is proven small is broadcast; beyond that rows and mapping meet in
    a sort-merge join, whose hot labels adaptive execution splits.
    """
    old, new = "_old_value", "_new_value"
    while {old, new} & set(df.columns):
        old, new = "_" + old, "_" + new
    m = mapping.select(F.col("old_value").alias(old), F.col("new_value").alias(new))
    if fits(m):
        m = F.broadcast(m)
    return df.join(m, F.col(col) == F.col(old), "left").withColumn(out or col, F.coalesce(F.col(new), F.col(col))).drop(old, new)
