"""The corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``: the first, second and fourth drop rows, the third
takes repeated passages out of the texts (a text that loses everything stays as
an empty document). The last returns the packed pieces. The results of each
stage for NULLs, empty tables and repeated rows are those of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listingmart.llm import decontaminate, packing, simhash, substrings, toxicity
from listingmart.llm.common import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the training share of the labels and drop documents that score as toxic."""
    model = toxicity.fit_toxicity(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least id."""
    return simhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a window that starts in a document with a smaller id leave the text."""
    return substrings.drop_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Learned scores, automata and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
