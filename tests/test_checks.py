"""The daily checks stop a run on a repeated key, a missing value or a wrong type."""

import pytest
from pyspark.sql import functions as F

from listingmart.plans.daily_run import A_KEY, checked
from listingmart.schemas import STG_A


def _day(spark, rows):
    df = spark.createDataFrame(rows, "job_id string, title string, datetime_published timestamp_ntz")
    have = set(df.columns)
    return df.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in STG_A.fields])


def test_checked(spark):
    import datetime as dt
    t = dt.datetime(2025, 6, 1)
    assert checked(_day(spark, [("a", "x", t), ("b", "y", t)]), STG_A, A_KEY, "A").count() == 2
    with pytest.raises(AssertionError, match="repeated"):
        checked(_day(spark, [("a", "x", t), ("a", "y", t)]), STG_A, A_KEY, "A")
    for bad in ((None, "x", t), ("a", None, t), ("a", "x", None)):
        with pytest.raises(AssertionError, match="without a value"):
            checked(_day(spark, [bad]), STG_A, A_KEY, "A")
    with pytest.raises(AssertionError, match="wrong or missing"):
        checked(_day(spark, [("a", "x", t)]).drop("title"), STG_A, A_KEY, "A")
