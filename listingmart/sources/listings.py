"""Landed listing pages -> rows.

Each HTTP response is landed as one JSON file (one page); a directory of pages
is read in parallel with an explicit schema. Source A's six criteria have no
fixed JSON type (a list, one object, or null), so they are declared as STRING
and parsed with ``from_json`` into ``array<struct<id,label,lang>>``: a lone
object becomes a one-element array.

Every row carries ``_page`` and ``_pos`` (its position in the page) so that
"first" is defined without relying on file order (O3, T6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ITEM = _st(("id", S), ("label", S), ("lang", S))
ITEM_ARRAY = T.ArrayType(ITEM, containsNull=True)

# Field names as they appear in source A's responses (fixed values).
A_CRITERIA = {"location": "location", "function": "profession", "job_level": "jobLevel",
              "education_level": "educationLevel", "experience_years": "experienceYears",
              "contract_type": "contractType"}

PAGE_A = _st(
    ("pagination", _st(("total", L), ("totalPages", L))),
    ("results", T.ArrayType(_st(
        ("title", S), ("openPositions", I), ("publishedAt", S), ("workMode", S),
        ("isAnonymous", B),
        ("company", _st(("name", S), ("sector", ITEM))),
        ("criteria", _st(*[(v, S) for v in A_CRITERIA.values()])),
    ))),
)

_NAME = _st(("name", S))
PAGE_B = _st(
    ("hydra:totalItems", L),
    ("hydra:view", _st(("hydra:next", S), ("hydra:last", S))),
    ("hydra:member", T.ArrayType(_st(
        ("title", S), ("companyName", S), ("nbPosition", I), ("publishedDate", S),
        ("expireDate", S), ("nbApplicant", I), ("nbView", I), ("hideCompany", B),
        ("nbMonthExperience", S), ("city", _NAME), ("region", _st(("name", S), ("cardinal", S))),
        ("country", _NAME), ("sectorGroup", _st(("id", S))), ("function", _st(("id", S))),
        ("careerLevel", _NAME), ("studyLevel", _NAME), ("workplace", _NAME),
        ("contractTypes", T.ArrayType(_NAME)), ("salary", S),
    ))),
)

SALARY = _st(("min", I), ("max", I))


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every landed page file under ``path``, one row per page, in parallel.

    ``_page`` is the file path, the page's identity for ordering.
    """
    return (spark.read.schema(schema).option("multiLine", True).json(path)
            .withColumn("_page", F.col("_metadata.file_path")))


def pages_from_text(df: DataFrame, text_col: str, schema: T.StructType, page_col: str) -> DataFrame:
    """The same page rows from JSON text already in a table (one page per row)."""
    return df.select(F.col(page_col).alias("_page"),
                     F.from_json(F.col(text_col), schema).alias("_p")).select("_page", "_p.*")


def criteria_items(c) -> Column:
    """A criterion as JSON text (list, object or null) -> ``array<struct<id,label,lang>>``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.from_json(c, ITEM_ARRAY)


def flatten_a(pages: DataFrame) -> DataFrame:
    """S3: source A pages -> one row per listing.

    contract_type keeps labels only; ``function`` is read from ``profession``;
    sector stays a ``{id,label,lang}`` struct for the language step.
    """
    rows = pages.select("_page", F.posexplode("results").alias("_pos", "r"))
    crit = {k: criteria_items(F.col("r.criteria")[v]) for k, v in A_CRITERIA.items()}
    return rows.select(
        F.col("r.title").alias("title"),
        F.col("r.openPositions").alias("positions"),
        F.col("r.publishedAt").alias("datetime_published"),
        F.col("r.workMode").alias("work_mode"),
        F.col("r.company.name").alias("company"),
        F.col("r.company.sector").alias("sector"),
        F.col("r.isAnonymous").alias("is_anonymous"),
        crit["location"].alias("location"),
        crit["function"].alias("function"),
        crit["job_level"].alias("job_level"),
        crit["education_level"].alias("education_level"),
        crit["experience_years"].alias("experience_years"),
        F.transform(crit["contract_type"], lambda x: x["label"]).alias("contract_type"),
        "_page", "_pos",
    )


def salary_unpack(raw) -> dict[str, Column]:
    """has_salary / min / max from an optional salary object; ``{}`` is no salary."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    parsed = F.from_json(raw, SALARY)
    present = raw.isNotNull() & (F.regexp_replace(raw, r"\s", "") != "{}") & (raw != "null")
    return {"has_salary": present,
            "min_salary": F.when(present, parsed["min"]),
            "max_salary": F.when(present, parsed["max"])}


def flatten_b(pages: DataFrame) -> DataFrame:
    """Source B pages -> one row per listing (9 first-level, 8 nested fields)."""
    rows = pages.select("_page", F.posexplode(F.col("`hydra:member`")).alias("_pos", "r"))
    sal = salary_unpack(F.col("r.salary"))
    ct = F.col("r.contractTypes")
    return rows.select(
        F.col("r.title").alias("title"),
        F.col("r.companyName").alias("company"),
        F.col("r.nbPosition").alias("positions"),
        F.col("r.publishedDate").alias("datetime_published"),
        F.col("r.expireDate").alias("expire_date"),
        F.col("r.nbApplicant").alias("nb_applicants"),
        F.col("r.nbView").alias("nb_views"),
        F.col("r.hideCompany").alias("is_anonymous"),
        F.col("r.nbMonthExperience").alias("experience_years_id"),
        F.col("r.city.name").alias("city"),
        F.col("r.region.name").alias("state"),
        F.col("r.region.cardinal").alias("region"),
        F.col("r.country.name").alias("country"),
        F.col("r.sectorGroup.id").alias("sector_id"),
        F.col("r.function.id").alias("function_id"),
        F.col("r.careerLevel.name").alias("job_level"),
        F.col("r.studyLevel.name").alias("education_level"),
        F.col("r.workplace.name").alias("work_mode"),
        F.transform(ct, lambda x: x["name"]).alias("contract_type"),
        sal["has_salary"].alias("has_salary"),
        sal["min_salary"].alias("min_salary"),
        sal["max_salary"].alias("max_salary"),
        "_page", "_pos",
    )


def page_totals_a(pages: DataFrame) -> DataFrame:
    """S12 input for A: one row per page with the announced total and its rows."""
    return pages.select(F.col("pagination.total").alias("announced_total"),
                        F.coalesce(F.col("results"), F.array()).alias("rows"))


def page_totals_b(pages: DataFrame) -> DataFrame:
    """S12 input for B."""
    return pages.select(F.col("`hydra:totalItems`").alias("announced_total"),
                        F.coalesce(F.col("`hydra:member`"), F.array()).alias("rows"))
