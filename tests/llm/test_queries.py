"""The registered corpus queries and the pipeline on the smallest supplied tables."""

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from listingmart.llm import registry
from listingmart.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_toxicity", "op10_quality_model"])
def test_held_out(spark, name):
    got = registry.QUERIES[name](spark, "/root/testdata/sf0.01").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    label = "toxic" if name.startswith("op3") else "quality"
    met = got[got["held_out"]].merge(labels, on="doc_id")
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert (met["predicted"] == met[label]).mean() >= 0.93


def test_hmm_beats_base(spark):
    got = registry.QUERIES["op7_hmm"](spark, "/root/testdata/sf0.01").toPandas()
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()


def test_url_oracle(spark):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SF}/pages.parquet'")
    want = con.sql(registry.ORACLE["op9_url_rules"]).df().sort_values("page_id", ignore_index=True)
    got = registry.QUERIES["op9_url_rules"](spark, SF).toPandas().sort_values("page_id", ignore_index=True)
    assert got.astype(object).where(got.notna(), None).equals(want[got.columns].astype(object).where(want[got.columns].notna(), None))


def test_pipeline(spark):
    docs, names = table(spark, SF, "documents"), [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "substrings", "decontamination", "packing"]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns
        kept = spark.createDataFrame(out.toPandas(), out.schema)
    assert 0 < kept.count() < docs.count()
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert set(got["doc_id"]) == {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048
    empty = [s(spark, docs.limit(0), SF).count() for _, s in corpus_pipeline.STAGES]
    assert empty == [0] * 5
