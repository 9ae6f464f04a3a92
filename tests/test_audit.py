from listingmart.plans.audit import star_report
from listingmart.schemas import (BRIDGES, DIM_LOCATION, FCT_DAILY, FCT_JOBS, LABEL_DIMS, bridge_schema,
                                 label_dim_schema)
from listingmart.sources.store import TableStore


def test_star_report_finds_violations(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for name in LABEL_DIMS:
        store.append(name, spark.createDataFrame([(-1, "Inconnu"), (1, "A")], label_dim_schema(name)))
    store.append("dim_company", spark.createDataFrame([(2, "A")], label_dim_schema("dim_company")))  # dup label
    store.replace("dim_location", spark.createDataFrame([(1, "Oran", "Oran", "Ouest", "DZ")], DIM_LOCATION))
    row = ("j1", "t", 1, 7, None, None, None, None, None, None, None, None, None, None)  # sector 7: orphan
    store.replace("fct_jobs", spark.createDataFrame([row], FCT_JOBS))
    for name in BRIDGES:
        store.append(name, spark.createDataFrame([("j1", 1)], bridge_schema(name)))
    store.append("fct_job_performance_daily", spark.createDataFrame([], FCT_DAILY))
    bad = {(r.table, r.check): r.violations for r in star_report(store).collect() if r.violations}
    assert bad == {("dim_company", "unique company_name"): 1,
                   ("dim_location", "unknown member missing"): 1,
                   ("fct_jobs", "sector_id references dim_sector"): 1}
