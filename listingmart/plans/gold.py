"""Gold layer: bridge views and stored summaries (C7: J8 x6, A11, J9, A12, P19, K7, K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.operators.lookup import small_side
from listingmart.schemas import (BRIDGES, DIM_LOCATION, FCT_DAILY, FCT_JOBS, bridge_schema,
                                 label_dim_schema)
from listingmart.sources.store import TableStore

VIEW_NAMES = {
    "br_job_function": "vw_job_function",
    "br_job_location": "vw_job_location",
    "br_job_job_level": "vw_job_level",
    "br_job_contract_type": "vw_job_contract_type",
    "br_job_education_level": "vw_job_education_level",
    "br_job_experience_requirements": "vw_job_experience_requirements",
}


def bridge_view(bridge: DataFrame, dim: DataFrame, id_col: str) -> DataFrame:
    """Bridge joined to its dimension (inner), dimension columns after the ids."""
    return bridge.join(small_side(dim), id_col, "inner").select("job_id", id_col,
                                                                *[c for c in dim.columns if c != id_col])


def job_performance_summary(daily: DataFrame) -> DataFrame:
    """Per job, total views and applicants, first and last day with a row."""
    return daily.groupBy("job_id").agg(
        F.sum("nb_views").cast("long").alias("total_views"),
        F.sum("nb_applicants").cast("long").alias("total_applicants"),
        F.min("date").alias("first_active_day"),
        F.max("date").alias("last_active_day"))


def first_last_application_days(daily: DataFrame, fact: DataFrame) -> DataFrame:
    """J9 + A12 + P19: days from publication to the first / last day with applicants.

    The daily rows are reduced per job before the join, so the join sees one
    row per job on each side.
    """
    has_apps = F.col("nb_applicants") > 0
    per_job = daily.groupBy("job_id").agg(
        F.min(F.when(has_apps, F.col("date"))).alias("_first"),
        F.max(F.when(has_apps, F.col("date"))).alias("_last"))
    j = per_job.join(fact.select("job_id", "datetime_published"), "job_id", "inner")
    pub = F.to_date("datetime_published")
    return j.select("job_id", F.datediff("_first", pub).alias("days_to_first_applicant"),
                    F.datediff("_last", pub).alias("days_to_last_applicant"))


def build_gold(store: TableStore, day_change: tuple | None = None) -> dict[str, DataFrame]:
    """Publish the six views (temp views) and refresh the two summaries (K7, K8).

    With ``day_change`` (from ``daily_metrics``) and a stored state, the
    summaries are updated from that day's change only (see
    ``refresh_summaries``); otherwise they are rebuilt from the daily fact.
    """
    spark = store.spark
    out = {}
    for br, view in VIEW_NAMES.items():
        dim_name, id_col, _ = BRIDGES[br]
        schema = DIM_LOCATION if dim_name == "dim_location" else label_dim_schema(dim_name)
        dim = store.read(dim_name, schema)
        v = bridge_view(store.read(br, bridge_schema(br)), dim, id_col)
        v.createOrReplaceTempView(view)
        out[view] = v
    refresh_summaries(store, day_change)
    for name in ["mv_job_performance_summary", "mv_job_first_last_application_days"]:
        out[name] = spark.read.parquet(store.current_path(name))
        out[name].createOrReplaceTempView(name)
    return out


__all__ = ["bridge_view", "job_performance_summary", "first_last_application_days", "build_gold"]


# -- incremental refresh of the two summaries --------------------------------------

def _day_contrib(day: DataFrame) -> DataFrame:
    """Per job, one day's contribution: sums, non-NULL counts, any applicants."""
    return day.groupBy("job_id").agg(
        F.sum("nb_views").cast("long").alias("sv"), F.count("nb_views").alias("nv"),
        F.sum("nb_applicants").cast("long").alias("sa"), F.count("nb_applicants").alias("na"),
        F.max((F.col("nb_applicants") > 0).cast("int")).alias("app"))


def summary_state_full(daily: DataFrame) -> DataFrame:
    """The per-job state of both summaries, from the whole daily fact."""
    has_apps = F.col("nb_applicants") > 0
    return daily.groupBy("job_id").agg(
        F.coalesce(F.sum("nb_views"), F.lit(0)).cast("long").alias("total_views"),
        F.count("nb_views").alias("n_views"),
        F.coalesce(F.sum("nb_applicants"), F.lit(0)).cast("long").alias("total_applicants"),
        F.count("nb_applicants").alias("n_applicants"),
        F.min("date").alias("first_active_day"), F.max("date").alias("last_active_day"),
        F.min(F.when(has_apps, F.col("date"))).alias("first_app_day"),
        F.max(F.when(has_apps, F.col("date"))).alias("last_app_day"))


def summary_state_apply_day(state: DataFrame, old_day: DataFrame, new_day: DataFrame, ds,
                            history: DataFrame) -> DataFrame:
    """The state after day ``ds`` was (re)written: ``old_day`` are its rows before the
    write (empty on a first run), ``new_day`` after. Rows are never removed by
    the daily upsert, so active days only grow; the sums change by new - old.
    A job whose only applicant row of a first/last applicant day ``ds`` lost
    its applicants is recomputed from its own history (broadcast-filtered).
    """
    from listingmart.functions.dates import _date_lit
    from listingmart.operators.lookup import fits
    d = _date_lit(ds)
    o = _day_contrib(old_day).select("job_id", *[F.col(c).alias("o_" + c) for c in ("sv", "nv", "sa", "na", "app")])
    n = _day_contrib(new_day).select("job_id", *[F.col(c).alias("n_" + c) for c in ("sv", "nv", "sa", "na", "app")])
    ch = n.join(o, "job_id", "full_outer")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    j = state.join(ch, "job_id", "full_outer")
    touched = F.col("n_nv").isNotNull()  # the job has rows on ds after the write
    gained = z("n_app") == 1
    lost = (z("o_app") == 1) & ~gained & ((F.col("first_app_day") == d) | (F.col("last_app_day") == d))
    upd = j.select(
        "job_id",
        (z("total_views") - z("o_sv") + z("n_sv")).alias("total_views"),
        (z("n_views") - z("o_nv") + z("n_nv")).alias("n_views"),
        (z("total_applicants") - z("o_sa") + z("n_sa")).alias("total_applicants"),
        (z("n_applicants") - z("o_na") + z("n_na")).alias("n_applicants"),
        F.when(touched, F.least("first_active_day", d)).otherwise(F.col("first_active_day")).alias("first_active_day"),
        F.when(touched, F.greatest("last_active_day", d)).otherwise(F.col("last_active_day")).alias("last_active_day"),
        F.when(gained, F.least("first_app_day", d)).otherwise(F.col("first_app_day")).alias("first_app_day"),
        F.when(gained, F.greatest("last_app_day", d)).otherwise(F.col("last_app_day")).alias("last_app_day"),
        lost.alias("_lost"))
    lost_ids = upd.where("_lost").select("job_id")
    if fits(lost_ids):
        lost_ids = F.broadcast(lost_ids)
    redo = (history.join(lost_ids, "job_id", "left_semi").groupBy("job_id")
            .agg(F.min(F.when(F.col("nb_applicants") > 0, F.col("date"))).alias("r_first"),
                 F.max(F.when(F.col("nb_applicants") > 0, F.col("date"))).alias("r_last")))
    out = upd.join(redo, "job_id", "left")
    return out.select(
        "job_id", "total_views", "n_views", "total_applicants", "n_applicants", "first_active_day",
        "last_active_day",
        F.when(F.col("_lost"), F.col("r_first")).otherwise(F.col("first_app_day")).alias("first_app_day"),
        F.when(F.col("_lost"), F.col("r_last")).otherwise(F.col("last_app_day")).alias("last_app_day"))


def summaries_from_state(state: DataFrame, fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two published summaries (A11, A12) from the per-job state.

    A sum over only NULL values is NULL, as SUM is (kept by the non-NULL counts).
    """
    perf = state.select(
        "job_id",
        F.when(F.col("n_views") > 0, F.col("total_views")).alias("total_views"),
        F.when(F.col("n_applicants") > 0, F.col("total_applicants")).alias("total_applicants"),
        "first_active_day", "last_active_day")
    j = state.select("job_id", "first_app_day", "last_app_day").join(
        fact.select("job_id", "datetime_published"), "job_id", "inner")
    pub = F.to_date("datetime_published")
    days = j.select("job_id", F.datediff("first_app_day", pub).alias("days_to_first_applicant"),
                    F.datediff("last_app_day", pub).alias("days_to_last_applicant"))
    return perf, days


def refresh_summaries(store: TableStore, day_change: tuple | None = None) -> dict[str, DataFrame]:
    """K8, incremental: update the per-job state with one day's change and
    publish both summaries from it; without a stored state (or a day change)
    the state is built from the whole daily fact once."""
    from listingmart.session import cut_lineage
    daily = store.read("fct_job_performance_daily", FCT_DAILY)
    if day_change is not None and store.exists("summary_state"):
        old_day, new_day, ds = day_change
        state = store.read("summary_state", _STATE_SCHEMA)
        state = summary_state_apply_day(state, old_day, new_day, ds, daily)
    else:
        state = summary_state_full(daily)
    state = cut_lineage(state)
    store.replace("summary_state", state)
    perf, days = summaries_from_state(store.read("summary_state", _STATE_SCHEMA),
                                      store.read("fct_jobs", FCT_JOBS))
    store.replace("mv_job_performance_summary", perf)
    store.replace("mv_job_first_last_application_days", days)
    return {"mv_job_performance_summary": perf, "mv_job_first_last_application_days": days}


def _state_schema():
    from pyspark.sql import types as T
    L, D = T.LongType(), T.DateType()
    return T.StructType([T.StructField("job_id", T.StringType()), T.StructField("total_views", L),
                         T.StructField("n_views", L), T.StructField("total_applicants", L),
                         T.StructField("n_applicants", L), T.StructField("first_active_day", D),
                         T.StructField("last_active_day", D), T.StructField("first_app_day", D),
                         T.StructField("last_app_day", D)])


_STATE_SCHEMA = _state_schema()
