"""Changes of a backfilled interval in one plan: equal to the day-by-day rule on the corrected series."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fixtures import b_listing, land_b, land_lookups
from listingmart.operators import delta as DL
from listingmart.plans.daily_run import run_day
from listingmart.plans.silver import daily_metrics_interval
from listingmart.schemas import FCT_DAILY, STG_B
from listingmart.sources.store import TableStore


def _changes(series):
    """{day: value} -> {day: change}: value less the last earlier value that is not NULL."""
    out, last = {}, 0
    for day in sorted(series):
        value = series[day]
        out[day] = None if value is None else value - last
        last = last if value is None else value
    return out


def _day(d):
    return dt.date(2025, 6, d)


def test_interval_equals_day_by_day(spark):
    rnd = random.Random(11)
    stored, batch, want = [], [], {}
    for key in range(60):
        old = {d: rnd.choice([None, rnd.randint(0, 40)]) for d in range(1, 15) if rnd.random() < 0.7}
        new = {d: rnd.choice([None, rnd.randint(0, 40), old.get(d)]) for d in range(5, 10) if rnd.random() < 0.6}
        before, after = _changes(old), _changes(old | new)
        stored += [(key, _day(d), v) for d, v in before.items()]
        batch += [(key, _day(d), v) for d, v in new.items()]
        if new:  # keys without a batch row stay as they are
            want |= {(key, d): v for d, v in after.items() if d in new or v != before.get(d)}
    schema = "k int, date date, v int"
    history, rows = spark.createDataFrame(stored, schema), spark.createDataFrame(batch, schema)
    got = DL.counter_delta_interval(rows, history, ["k"], ["v"], "2025-06-05", "2025-06-09")
    assert got.schema["v"].dataType.simpleString() == "int"
    assert {(r.k, r.date.day): r.v for r in got.collect()} == want
    assert any(d > 9 for _, d in want)
    # no history, nothing to do, and rows outside the interval
    none = history.where("false")
    assert DL.counter_delta_interval(rows.where("false"), history, ["k"], ["v"], "2025-06-05", "2025-06-09").count() == 0
    assert DL.counter_delta_interval(rows, none, ["k"], ["v"], "2025-06-05", "2025-06-09").count() == len(batch)
    assert DL.counter_delta_interval(rows, history, ["k"], ["v"], "2025-06-20", "2025-06-21").count() == 0


def test_interval_shuffles_days_once(spark):
    rows = spark.createDataFrame([(1, _day(5), 3)], "k int, date date, v int")
    plan = DL.counter_delta_interval(rows, rows, ["k"], ["v"], "2025-06-05", "2025-06-09")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Expand" not in plan


def test_late_correction_moves_the_next_day(spark, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "wh")
    land_lookups(landing)
    for ds, applicants, views in (("2025-06-02", 5, 35), ("2025-06-03", 9, 50), ("2025-06-04", 9, 60)):
        land_b(landing, ds, [[b_listing("Juriste senior", "Gamma", "2025-06-01T08:00:00", applicants=applicants, views=views)]])
        run_day(spark, landing, path, ds)
    store = TableStore(spark, path)

    def fact():
        rows = store.read("fct_job_performance_daily", FCT_DAILY).orderBy("date").collect()
        return [(r.date.day, r.nb_applicants, r.nb_views, r.days_since_published) for r in rows]

    assert fact() == [(2, 5, 35, 1), (3, 4, 15, 2), (4, 0, 10, 3)]
    days = store.read("stg_emploi_partner", STG_B).where(F.col("date_scraped").between("2025-06-02", "2025-06-03"))
    second = F.col("date_scraped") == "2025-06-03"
    late = days.withColumn("nb_applicants", F.when(second, 7).otherwise(6).cast("int"))
    daily_metrics_interval(store, late, "2025-06-02", "2025-06-03")
    assert fact() == [(2, 6, 35, 1), (3, 1, 15, 2), (4, 2, 10, 3)]
    daily_metrics_interval(store, late, "2025-06-02", "2025-06-03")  # again: nothing changes
    assert fact() == [(2, 6, 35, 1), (3, 1, 15, 2), (4, 2, 10, 3)]
