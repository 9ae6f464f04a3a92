"""Explicit schemas for every stored table (K6, M8, M9); nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values (must equal the reference's): the unknown member.
UNKNOWN = "Inconnu"
UNKNOWN_ID = -1

# The two source tags written to job_source.
SOURCE_A = "Emploitic"
SOURCE_B = "EmploiPartner"

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
TS, D = T.TimestampNTZType(), T.DateType()
SA = T.ArrayType(T.StringType(), containsNull=True)


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Bronze
STG_A = _st(
    ("job_id", S, False), ("title", S, False), ("company", S, True), ("location", SA, True),
    ("job_level", SA, True), ("positions", I, True), ("datetime_published", TS, False),
    ("sector", S, True), ("function", SA, True), ("contract_type", SA, True),
    ("education_level", SA, True), ("experience_years", SA, True), ("is_anonymous", B, True),
    ("work_mode", S, True), ("date_scraped", D, True), ("job_source", S, True),
)
STG_A_KEYS = ["job_id"]

STG_B = _st(
    ("job_id", S, False), ("title", S, False), ("company", S, True), ("positions", I, True),
    ("datetime_published", TS, False), ("expire_date", TS, True), ("city", S, True),
    ("state", S, True), ("region", S, True), ("country", S, True), ("job_level", S, True),
    ("sector", S, True), ("function", S, True), ("contract_type", SA, True),
    ("education_level", S, True), ("experience_years", S, True), ("is_anonymous", B, True),
    ("work_mode", S, True), ("has_salary", B, True), ("min_salary", I, True),
    ("max_salary", I, True), ("nb_applicants", I, True), ("nb_views", I, True),
    ("date_scraped", D, True), ("job_source", S, True),
)
STG_B_KEYS = ["date_scraped", "job_id", "city", "state", "region", "country"]

# Columns each staging upsert overwrites on a key match (T16: title, company and
# datetime_published are kept in A; B sets 20 columns).
STG_A_UPDATE = ["location", "job_level", "positions", "sector", "function", "contract_type",
                "education_level", "experience_years", "is_anonymous", "work_mode",
                "date_scraped", "job_source"]
STG_B_UPDATE = ["positions", "expire_date", "city", "state", "region", "country", "job_level",
                "sector", "function", "contract_type", "education_level", "experience_years",
                "work_mode", "is_anonymous", "has_salary", "min_salary", "max_salary",
                "nb_applicants", "nb_views", "job_source"]

# Silver: label dimensions. name -> (id column, label column, snapshot column)
LABEL_DIMS = {
    "dim_company": ("company_id", "company_name", "company"),
    "dim_sector": ("sector_id", "sector_description", "sector"),
    "dim_job_level": ("job_level_id", "job_level_description", "job_level"),
    "dim_function": ("function_id", "function_description", "function"),
    "dim_contract_type": ("contract_type_id", "contract_type_description", "contract_type"),
    "dim_education_level": ("education_level_id", "education_level_description", "education_level"),
    "dim_experience_requirements": ("experience_requirements_id",
                                    "experience_requirements_description", "experience_years"),
}
DIM_LOCATION = _st(("location_id", L, False), ("city", S, False), ("state", S, False),
                   ("region", S, False), ("country", S, False))
LOCATION_KEYS = ["city", "state", "country"]


def label_dim_schema(name: str) -> T.StructType:
    id_col, label_col, _ = LABEL_DIMS[name]
    return _st((id_col, L, False), (label_col, S, False))


FCT_JOBS = _st(
    ("job_id", S, False), ("title", S, True), ("company_id", L, True), ("sector_id", L, True),
    ("m_positions", I, True), ("datetime_published", TS, True), ("expire_date", TS, True),
    ("is_anonymous", B, True), ("work_mode", S, True), ("has_salary", B, True),
    ("min_salary", I, True), ("max_salary", I, True), ("job_source", S, True),
    ("date_scraped", D, True),
)
FCT_A_UPDATE = ["company_id", "sector_id", "m_positions", "is_anonymous", "work_mode",
                "has_salary", "job_source", "date_scraped"]
FCT_B_UPDATE = ["company_id", "sector_id", "m_positions", "expire_date", "is_anonymous",
                "work_mode", "has_salary", "min_salary", "max_salary", "job_source",
                "date_scraped"]

# Bridges: name -> (dimension, id column, snapshot column or location keys)
BRIDGES = {
    "br_job_location": ("dim_location", "location_id", None),
    "br_job_job_level": ("dim_job_level", "job_level_id", "job_level"),
    "br_job_function": ("dim_function", "function_id", "function"),
    "br_job_contract_type": ("dim_contract_type", "contract_type_id", "contract_type"),
    "br_job_education_level": ("dim_education_level", "education_level_id", "education_level"),
    "br_job_experience_requirements": ("dim_experience_requirements",
                                       "experience_requirements_id", "experience_years"),
}


def bridge_schema(name: str) -> T.StructType:
    return _st(("job_id", S, False), (BRIDGES[name][1], L, False))


FCT_DAILY = _st(("job_id", S, False), ("location_id", L, False), ("date", D, False),
                ("nb_applicants", I, True), ("nb_views", I, True),
                ("days_since_published", I, True))
FCT_DAILY_KEYS = ["job_id", "location_id", "date"]


def all_tables() -> dict[str, T.StructType]:
    """The 18 stored tables of K6."""
    out = {"stg_emploitic": STG_A, "stg_emploi_partner": STG_B,
           "dim_location": DIM_LOCATION, "fct_jobs": FCT_JOBS,
           "fct_job_performance_daily": FCT_DAILY}
    out.update({n: label_dim_schema(n) for n in LABEL_DIMS})
    out.update({n: bridge_schema(n) for n in BRIDGES})
    return out
