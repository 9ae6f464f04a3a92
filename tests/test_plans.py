"""Plan shapes that the scale design relies on (checked on the physical plan text)."""

import datetime as dt

from pyspark.sql import functions as F

from listingmart.functions import dates as D
from listingmart.operators import dedup as DD
from listingmart.operators import keys as KY
from listingmart.operators import merge as MG
from listingmart.plans import silver as SV
from listingmart.plans import snapshot as SN
from listingmart.schemas import BRIDGES, DIM_LOCATION, LABEL_DIMS, STG_B, bridge_schema, label_dim_schema
from listingmart.sources.store import TableStore


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    p = plan(DD.first_per_key(df, ["k"], ["v"]))
    assert "WindowGroupLimit" in p and "Partial" in p  # a hot key ships one row per map task


def test_merge_is_partially_aggregated(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"),
                                  F.col("id").cast("int").alias("v"), F.lit("x").alias("s"))
    p = plan(DD.merge_duplicates(df, ["k"], ["v"], "pos"))
    assert p.count("Aggregate") >= 2  # partial + final


def test_bounded_upsert_broadcasts_batch_keys(spark):
    t = spark.range(10000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    s = spark.range(5).select(F.col("id").alias("k"), F.lit("b").alias("v"))
    p = plan(MG.upsert(t, s, ["k"], ["v"]))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p and "LeftSemi" in p


def test_day_read_prunes_partitions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.createDataFrame([], STG_B)
    rows = rows.unionByName(spark.range(4).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in STG_B.fields if f.name != "date_scraped"],
        F.date_add(F.lit(dt.date(2025, 6, 1)), F.col("id").cast("int")).alias("date_scraped")))
    store.overwrite_partitions("stg_emploi_partner", rows, "date_scraped", reads_self=False)
    day = store.read_partition("stg_emploi_partner", STG_B, "date_scraped", dt.date(2025, 6, 3))
    p = plan(day)
    assert "PartitionFilters: [isnotnull(date_scraped" in p
    assert day.count() == 1


def test_time_window_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "ev")
    spark.range(10).select(F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("ts")) \
        .write.parquet(path)
    p = plan(spark.read.parquet(path).where(D.daily_window("ts", "1970-01-05")))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_key_assignment_has_no_single_partition_exchange(spark):
    new = spark.range(1000).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("label"))
    out = KY.assign_keys(new, ["label"], "id")
    lines = plan(out).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # only the per-partition count table (one row per partition) meets in one task
            assert "HashAggregate(keys=[_pid" in lines[i + 1]
    ids = sorted(r.id for r in out.collect())
    assert ids == list(range(1, 1001))


def test_grouped_key_assignment(spark):
    new = spark.createDataFrame([("d1", "b"), ("d1", "a"), ("d2", "z"), ("d2", "y"), ("d3", "q")],
                                "_dim string, label string")
    cur = spark.createDataFrame([("d1", -1), ("d1", 4), ("d2", -1)], "_dim string, id long")
    got = {(r._dim, r.label): r.id for r in KY.assign_keys(new, ["label"], "id", start=cur, group="_dim").collect()}
    assert got == {("d1", "a"): 5, ("d1", "b"): 6, ("d2", "y"): 1, ("d2", "z"): 2, ("d3", "q"): 1}


def test_bridges_compute_the_snapshot_once(spark, tmp_path):
    rows, seen = 40, spark.sparkContext.accumulator(0)
    read = F.udf(lambda i: seen.add(1) or f"job-{i % 30}")  # ten jobs have two rows, with the same labels but one
    labels = {col: F.lit("l1") for _, _, col in LABEL_DIMS.values()}
    labels["contract_type"] = F.when(F.col("id") < 30, "l1").otherwise("l2")
    labels["job_level"] = F.when(F.col("id") % 30 < 5, "not a member").when(F.col("id") % 30 > 5, "l2")
    snap = spark.range(rows).withColumns(labels | {"city": F.lit("c"), "state": F.lit("s"), "country": F.lit("x")})
    snap = snap.repartition(2).withColumn("job_id", read("id"))
    dims = {n: spark.createDataFrame([(-1, "Inconnu"), (1, "l1"), (2, "l2")], label_dim_schema(n)) for n in LABEL_DIMS}
    dims["dim_location"] = spark.createDataFrame([(7, "c", "s", "r", "x"), (8, "c", "s", "r", "y")], DIM_LOCATION)
    dims["_bounded"] = {n: True for n in dims}
    store = TableStore(spark, str(tmp_path))
    SV.load_bridges(store, None, snap, dims)
    assert seen.value <= 2 * rows  # not once for each bridge and once more for the bound of its keys
    want = {n: 30 for n in BRIDGES} | {"br_job_contract_type": 40, "br_job_job_level": 24}
    got = {n: {tuple(r) for r in store.read(n, bridge_schema(n)).collect()} for n in BRIDGES}
    assert {n: len(r) for n, r in got.items()} == want
    assert {i for _, i in got["br_job_location"]} == {7} and {i for _, i in got["br_job_job_level"]} == {2}
    SV.load_bridges(store, snap, snap, dims)  # nothing new
    assert {n: store.read(n, bridge_schema(n)).count() for n in BRIDGES} == want


def test_snapshot_of_one_file_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(SN, "DEALT_ROWS", 10, raising=False)
    day = spark.range(35).select(*[(F.col("id") if f.name == "job_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in STG_B.fields])
    p = plan(SN.snapshot_b(day.coalesce(1)))
    assert p.index("Generate") < p.index("hashpartitioning(job_id")  # below the explode
    assert ", 4), REPARTITION_BY_NUM" in p
