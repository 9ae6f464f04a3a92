"""Star schema from the daily snapshots of both sources.

One run for both sources (T20): new dimension members of A and B are unioned
and keyed once; then the fact is upserted per source and the bridges get
their new pairs. Dimensions, lookups and label maps are small and broadcast
only after a bounded count; the fact and bridges are joined by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.functions.dates import _date_lit
from listingmart.operators.dedup import distinct_members, first_per_key
from listingmart.operators.delta import counter_delta, counter_delta_interval, metrics_location_join
from listingmart.operators.keys import assign_keys, seed_unknown
from listingmart.operators.lookup import fits_many, small_side
from listingmart.session import cut_lineage, stored_by
from listingmart.operators.merge import insert_if_absent, upsert
from listingmart.schemas import (BRIDGES, DIM_LOCATION, FCT_A_UPDATE, FCT_B_UPDATE, FCT_DAILY,
                                 FCT_DAILY_KEYS, FCT_JOBS, LABEL_DIMS, LOCATION_KEYS, UNKNOWN, UNKNOWN_ID,
                                 bridge_schema, label_dim_schema)
from listingmart.sources.store import TableStore

# Source B inserts members without a NOT NULL filter for company and function.
B_UNFILTERED = {"company", "function"}


def bootstrap(store: TableStore) -> None:
    """K6 + M8: create absent dimensions with their unknown member (idempotent).

    A dimension that does not exist yet is written with its seed row; an
    existing one is probed for id -1 with a pushed-down filter (reads one row).
    """
    spark = store.spark
    for name in list(LABEL_DIMS) + ["dim_location"]:
        schema = DIM_LOCATION if name == "dim_location" else label_dim_schema(name)
        id_col = schema.fields[0].name
        seed = seed_unknown(spark, schema)
        if not store.exists(name):
            store.append(name, seed) if name != "dim_location" else store.replace(name, seed)
        elif store.read(name, schema).where(F.col(id_col) == UNKNOWN_ID).isEmpty():
            if name == "dim_location":
                store.replace(name, store.read(name, schema).unionByName(seed))
            else:
                store.append(name, seed)


def _label_members(snap_a: DataFrame | None, snap_b: DataFrame | None, col: str) -> DataFrame:
    parts = []
    if snap_a is not None:
        parts.append(distinct_members(snap_a, [col]))
    if snap_b is not None:
        parts.append(distinct_members(snap_b, [col], drop_nulls=col not in B_UNFILTERED))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def load_label_dimensions(store: TableStore, snap_a, snap_b) -> dict[str, DataFrame]:
    """A1 x14 -> M2 -> M7: add new labels to the seven label dimensions.

    All seven are handled in one pass: members of every dimension in one
    frame ``(_dim, _label)``, one anti-join against the current members, one
    key assignment numbered per dimension, then one append per dimension.
    """
    members, current = None, None
    for name, (id_col, label_col, snap_col) in LABEL_DIMS.items():
        m = _label_members(snap_a, snap_b, snap_col).select(F.lit(name).alias("_dim"),
                                                             F.col(snap_col).alias("_label"))
        c = store.read(name, label_dim_schema(name)).select(
            F.lit(name).alias("_dim"), F.col(label_col).alias("_label"), F.col(id_col).alias("_id"))
        members = m if members is None else members.unionByName(m)
        current = c if current is None else current.unionByName(c)
    new = members.distinct().join(current.select("_dim", "_label"), ["_dim", "_label"], "left_anti")
    keyed = assign_keys(new, ["_label"], "_id", start=current, group="_dim")
    out = {}
    for name, (id_col, label_col, _) in LABEL_DIMS.items():
        store.append(name, keyed.where(F.col("_dim") == name)
                     .select(F.col("_id").alias(id_col), F.col("_label").alias(label_col)))
        out[name] = store.read(name, label_dim_schema(name))
    return out


def load_location_dimension(store: TableStore, snap_a, snap_b) -> DataFrame:
    """A2 x2 -> M3 -> M7: places (city, state, country); B overwrites region."""
    cur = store.read("dim_location", DIM_LOCATION)
    parts = []
    if snap_a is not None:  # A: all three parts present, region default, never overwritten
        parts.append(distinct_members(snap_a, LOCATION_KEYS)
                     .withColumn("region", F.lit(UNKNOWN)).withColumn("_b", F.lit(False)))
    if snap_b is not None:
        parts.append(snap_b.select(*LOCATION_KEYS, "region").distinct().withColumn("_b", F.lit(True)))
    members = parts[0]
    for p in parts[1:]:
        members = members.unionByName(p)
    known = F.when(F.col("_b") & (F.col("region") != UNKNOWN), F.col("region"))
    per_place = members.groupBy(*LOCATION_KEYS).agg(
        F.coalesce(F.max(known), F.max(F.when(F.col("_b"), F.col("region"))), F.lit(UNKNOWN))
        .alias("region"), F.max(F.col("_b").cast("int")).alias("_from_b"))
    upd = cur.alias("d").join(per_place.alias("m"), LOCATION_KEYS, "left")
    updated = upd.select(
        "d.location_id", *LOCATION_KEYS,
        F.when(F.col("m._from_b") == 1, F.col("m.region")).otherwise(F.col("d.region")).alias("region"))
    new = per_place.join(cur.select(*LOCATION_KEYS), LOCATION_KEYS, "left_anti")
    keyed = assign_keys(new, LOCATION_KEYS, "location_id", start=cur.select("location_id"))
    result = updated.unionByName(keyed.select("location_id", *LOCATION_KEYS, "region"))
    store.replace("dim_location", result.select(*[f.name for f in DIM_LOCATION.fields]))
    return store.read("dim_location", DIM_LOCATION)


def _hinted(dims: dict[str, DataFrame], name: str) -> DataFrame:
    """A dimension with a broadcast hint when its size was proven bounded (``_bounded``)."""
    bounded = dims.get("_bounded", {})
    if name in bounded:
        return F.broadcast(dims[name]) if bounded[name] else dims[name]
    return small_side(dims[name])


def _fact_rows(snap: DataFrame, dims: dict[str, DataFrame], order) -> DataFrame:
    """J1 + A3/A4: one row per job with company and sector ids (inner joins by label)."""
    comp = _hinted(dims, "dim_company")
    sect = _hinted(dims, "dim_sector")
    j = (snap.join(comp, snap["company"] == comp["company_name"], "inner")
         .join(sect, snap["sector"] == sect["sector_description"], "inner"))
    return first_per_key(j, ["job_id"], order)


def fact_rows_a(snap_a: DataFrame, dims) -> DataFrame:
    f = _fact_rows(snap_a, dims, [F.col("job_id")])
    return f.select("job_id", "title", "company_id", "sector_id", F.col("positions").alias("m_positions"),
                    "datetime_published", F.lit(None).cast("timestamp_ntz").alias("expire_date"),
                    "is_anonymous", "work_mode", F.lit(False).alias("has_salary"),
                    F.lit(None).cast("int").alias("min_salary"), F.lit(None).cast("int").alias("max_salary"),
                    "job_source", "date_scraped")


def fact_rows_b(snap_b: DataFrame, dims) -> DataFrame:
    f = _fact_rows(snap_b, dims, [F.col("expire_date").asc_nulls_last()])
    return f.select("job_id", "title", "company_id", "sector_id", F.col("positions").alias("m_positions"),
                    "datetime_published", "expire_date", "is_anonymous", "work_mode", "has_salary",
                    "min_salary", "max_salary", "job_source", "date_scraped")


def load_fact(store: TableStore, snap_a, snap_b, dims) -> DataFrame:
    """M4/M5: upsert fct_jobs; title and datetime_published are never changed.

    The fact is bucketed by job_id: both sources' days rewrite only the buckets they touch, in one version.
    """
    batches = [(rows(snap, dims), update) for snap, rows, update in (
        (snap_a, fact_rows_a, FCT_A_UPDATE), (snap_b, fact_rows_b, FCT_B_UPDATE)) if snap is not None]
    store.upsert_buckets("fct_jobs", FCT_JOBS, ["job_id"], batches)
    return store.read("fct_jobs", FCT_JOBS)


def bridge_ids(snap: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Each row's job_id and its member id in every bridge's dimension, by label (NULL: no such member)."""
    rows = snap.select("job_id", *LOCATION_KEYS, *[col for _, _, col in BRIDGES.values() if col])
    for dim_name, id_col, snap_col in BRIDGES.values():
        dim = _hinted(dims, dim_name)
        if snap_col is None:
            rows = rows.join(dim.select(id_col, *LOCATION_KEYS), LOCATION_KEYS, "left")
        else:
            label = dim.select(F.col(LABEL_DIMS[dim_name][1]).alias(snap_col), id_col)
            rows = rows.join(label, snap_col, "left")
    return rows.select("job_id", *[id_col for _, id_col, _ in BRIDGES.values()])


def bridge_pairs(ids: DataFrame) -> DataFrame:
    """Distinct (_br, job_id, _id) of the rows of ``bridge_ids``, all bridges in one pass.

    Rows are dealt by job before they are spread out over the bridges: one narrow row
    each crosses the network, and a job's pairs are already together.
    """
    each = F.array(*[F.struct(F.lit(name).alias("_br"), F.col(id_col).alias("_id")) for name, (_, id_col, _) in BRIDGES.items()])
    return (ids.repartition("job_id").select("job_id", F.explode(each).alias("_p")).select("_p._br", "job_id", "_p._id")
            .where(F.col("_id").isNotNull()).distinct())


def load_bridges(store: TableStore, snap_a, snap_b, dims) -> None:
    """M2 x12: append the new pairs of each bridge.

    Today's pairs of all bridges are computed once and written by bridge; each bridge
    then reads its own, less those it has (its rows are filtered map-side to today's pairs).
    """
    ids = None
    for s in (snap_a, snap_b):
        if s is not None:
            ids = bridge_ids(s, dims) if ids is None else ids.unionByName(bridge_ids(s, dims))
    pairs, current = stored_by(bridge_pairs(ids), "_br"), None
    for name, (_, id_col, _) in BRIDGES.items():
        c = store.read(name, bridge_schema(name)).select(F.lit(name).alias("_br"), "job_id",
                                                         F.col(id_col).alias("_id"))
        current = c if current is None else current.unionByName(c)
    new = insert_if_absent(current, pairs, ["_br", "job_id", "_id"], distinct=True)
    for name, (_, id_col, _) in BRIDGES.items():
        store.append(name, new.where(F.col("_br") == name).select("job_id", F.col("_id").alias(id_col)))


def build_silver(store: TableStore, snap_a: DataFrame | None, snap_b: DataFrame | None) -> dict:
    """Dimensions, fact and bridges for one day of both sources."""
    bootstrap(store)
    for s in (snap_a, snap_b):
        if s is not None:
            s.persist()
    dims = load_label_dimensions(store, snap_a, snap_b)
    dims["dim_location"] = load_location_dimension(store, snap_a, snap_b)
    dims["_bounded"] = fits_many({k: v for k, v in dims.items() if k != "_bounded"})  # one job
    fact = load_fact(store, snap_a, snap_b, dims)
    load_bridges(store, snap_a, snap_b, dims)
    for s in (snap_a, snap_b):
        if s is not None:
            s.unpersist()
    return {"dims": dims, "fact": fact}


def daily_metrics(store: TableStore, stg_b_day: DataFrame, ds) -> DataFrame:
    """J4 -> J5 -> J6 -> A10 -> J7 -> W4 -> M6 for one day of source B.

    Reads staging (not the exploded snapshot: one row per job and place),
    computes today's changes and overwrites the ``date = ds`` partition of
    the daily fact, keeping an existing days_since_published (T16). Returns
    the day's change ``(rows before, rows after, ds)`` for the summaries.
    """
    br = store.read("br_job_location", bridge_schema("br_job_location"))
    dim = store.read("dim_location", DIM_LOCATION)
    today = metrics_location_join(stg_b_day, br, dim).select(
        "job_id", "location_id", "datetime_published", "nb_applicants", "nb_views")
    today = first_per_key(today, ["job_id", "location_id"],
                          [F.col("datetime_published").asc_nulls_last()])
    history = store.read("fct_job_performance_daily", FCT_DAILY)
    # A job's counters start at its publication: older partitions cannot hold
    # history of today's jobs, so they are pruned (one scalar to the driver).
    # A job without a publication time may have history of any age: then nothing is pruned.
    published = today.agg(F.min(F.to_date("datetime_published")).alias("first"),
                          F.count_if(F.col("datetime_published").isNull()).alias("unknown")).first()
    since = None if published["unknown"] else published["first"]
    delta = counter_delta(today, history, ["job_id", "location_id"], ["nb_applicants", "nb_views"],
                          ds, "date", "datetime_published", since=since)
    # The day's rows before this run (empty on a first run), materialised before
    # the partition is replaced: the summaries are refreshed from this change.
    old_day = cut_lineage(history.where(F.col("date") == _date_lit(ds)))
    merged = upsert(old_day, delta.select(*[f.name for f in FCT_DAILY.fields]), FCT_DAILY_KEYS,
                    ["nb_applicants", "nb_views"])
    store.overwrite_partitions("fct_job_performance_daily", merged, "date")
    new_day = store.read("fct_job_performance_daily", FCT_DAILY).where(F.col("date") == _date_lit(ds))
    return old_day, new_day, ds


def daily_metrics_interval(store: TableStore, stg_b_days: DataFrame, start, end) -> None:
    """C6 for all days of a backfilled interval in one plan, with repair of later days.

    ``stg_b_days``: staging rows of source B scraped from ``start`` to ``end``.
    Rewrites the ``date`` partitions that hold a new or changed row and no
    other; an existing days_since_published is kept (T16). The summaries are
    to be refreshed from the fact afterwards (``refresh_summaries`` without a day's change).
    """
    metrics = ["nb_applicants", "nb_views"]
    places = metrics_location_join(stg_b_days, store.read("br_job_location", bridge_schema("br_job_location")),
                                   store.read("dim_location", DIM_LOCATION))
    batch = first_per_key(places.withColumnRenamed("date_scraped", "date").select(*FCT_DAILY_KEYS, "datetime_published", *metrics),
                          FCT_DAILY_KEYS, [F.col("datetime_published").asc_nulls_last()])
    history = store.read("fct_job_performance_daily", FCT_DAILY)
    changed = cut_lineage(counter_delta_interval(batch, history, ["job_id", "location_id"], metrics, start, end,
                                                 "date", "datetime_published"))
    days = [r["date"] for r in changed.select("date").distinct().collect()]  # one row per day from ``start`` on
    if days:
        held = cut_lineage(store.read("fct_job_performance_daily", FCT_DAILY).where(F.col("date").isin(days)))
        merged = upsert(held, changed.select(*[f.name for f in FCT_DAILY.fields]),
                        FCT_DAILY_KEYS, metrics)
        store.overwrite_partitions("fct_job_performance_daily", merged, "date")
