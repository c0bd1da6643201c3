"""Schemas of the landed data, the listing rows and the logs."""

from pyspark.sql import types as T

from vacanta.fixed_values import LIST_COLUMNS, LISTING_COLUMNS

TASK_KEYS = ["run", "kw", "city"]

RESPONSE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("run", T.LongType()),
    T.StructField("kw", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("body", T.StringType()),
])

REQUEST_EVENT = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("source", T.LongType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("response_time", T.DoubleType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("jobs_count", T.LongType()),
])

CHECK_EVENT = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("source", T.LongType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("response_time", T.DoubleType()),
    T.StructField("error", T.StringType()),
])

TASK_EVENT = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("source", T.LongType()),
    T.StructField("kw", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("success", T.BooleanType()),
])

# Stored listings, one folder per province.
STORED_LISTING = (
    "page_id bigint, pos int, job_id string, job_title string, company_name string,"
    " company_type string, company_size string, salary_min int, salary_max int,"
    " salary_range string, location_code string, city_name string, district string,"
    " job_describe string, work_experience string, degree_requirement string,"
    " publish_date timestamp_ntz, update_date timestamp_ntz, created_at timestamp,"
    " job_url string, company_url string, province_code string"
)

# The days in the files beside them: Spark sends comparisons of dates to Parquet,
# of moments without zone it does not.
STORED_DAYS = STORED_LISTING + ", publish_day date, update_day date"

# What an item carries itself; search_kw and search_city come from the task.
ITEM_COLUMNS = [c for c in LISTING_COLUMNS if c not in ("search_kw", "search_city")]


def item_schema(columns: list[str] | None = None) -> T.StructType:
    """Item struct limited to ``columns``; list columns stay untyped (VARIANT)."""
    wanted = ITEM_COLUMNS if columns is None else [c for c in ITEM_COLUMNS if c in columns]
    return T.StructType([
        T.StructField(c, T.VariantType() if c in LIST_COLUMNS else T.StringType())
        for c in wanted
    ])


def envelope_schema(columns: list[str] | None = None) -> T.StructType:
    """``{status, resultbody: {job: {items: [...]}}}``"""
    job = T.StructType([T.StructField("items", T.ArrayType(item_schema(columns)))])
    return T.StructType([
        T.StructField("status", T.VariantType()),
        T.StructField("resultbody", T.StructType([T.StructField("job", job)])),
    ])
