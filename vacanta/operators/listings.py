"""Cleaning exploded items into listing rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacanta.fixed_values import LIST_COLUMNS, LISTING_COLUMNS, SALARY_COLUMNS
from vacanta.functions.text import blank_to_null, is_bad_number, list_as_text, to_number

REQUIRED_COLUMNS = ["job_id", "job_title", "company_name", "location_code"]


def decode_area(df: DataFrame, areas: DataFrame, code: str, name: str) -> DataFrame:
    """Area name of ``code``, or the code itself where the dimension lacks it.

    The dimension has 32 rows, which Spark broadcasts by its own size check.
    """
    names = areas.select(F.col("code").alias("_code"), F.col("name").alias("_name"))
    return (
        df.join(names, F.col(code) == F.col("_code"), "left")
        .withColumn(name, F.coalesce("_name", code))
        .drop("_code", "_name")
    )


def select_expected(df: DataFrame, also: list[str] | None = None) -> DataFrame:
    """The expected listing columns that exist, in their fixed order."""
    return df.select(*(also or []), *[c for c in LISTING_COLUMNS if c in df.columns])


def flatten_lists(df: DataFrame) -> DataFrame:
    """List columns (VARIANT) as comma text."""
    return df.withColumns({c: list_as_text(F.col(c)) for c in LIST_COLUMNS if c in df.columns})


def cast_salary(df: DataFrame) -> DataFrame:
    """Salary text as double; empty and unreadable text becomes NULL."""
    return df.withColumns(
        {c: to_number(blank_to_null(F.col(c))) for c in SALARY_COLUMNS if c in df.columns}
    )


def cast_salary_by_page(df: DataFrame) -> DataFrame:
    """All-or-nothing cast: one unreadable value leaves its page's column as text.

    Wants items exploded with ``page_flags``. Adds ``<column>_text`` (the
    untouched column, empty as NULL) where the page could not be cast; the
    double is NULL there.
    """
    columns = {}
    for c in SALARY_COLUMNS:
        if c in df.columns:
            page_bad = F.col(f"{c}_page_bad")
            columns[f"{c}_text"] = F.when(page_bad, blank_to_null(F.col(c)))
            columns[c] = F.when(~page_bad, to_number(blank_to_null(F.col(c))))
    return df.withColumns(columns).drop(*[f"{c}_page_bad" for c in SALARY_COLUMNS])


def cast_salary_rejects(df: DataFrame) -> DataFrame:
    """One row per salary value that is neither empty nor a number."""
    present = [c for c in SALARY_COLUMNS if c in df.columns]
    values = F.array(
        *[
            F.when(
                is_bad_number(F.col(c)),
                F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")),
            )
            for c in present
        ]
    )
    kept = [c for c in df.columns if c not in present]
    return df.select(*kept, F.inline(F.array_compact(values)))


def clean_items(items: DataFrame, areas: DataFrame) -> DataFrame:
    """Listing rows: ``page_id``, ``pos`` and the 49 listing columns."""
    tagged = decode_area(
        items.withColumn("search_kw", F.col("kw")), areas, code="city", name="search_city"
    )
    return select_expected(cast_salary(flatten_lists(tagged)), also=["page_id", "pos"])


def union_pages(frames: list[DataFrame]) -> DataFrame:
    """Append frames with different columns; what a frame lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def known_columns(items: DataFrame, groups: list[tuple[Column, list[str]]]) -> DataFrame:
    """Items of one scan as if each group of pages had been read on its own, with the
    columns it knows, and the frames appended: ``groups`` are (rule, columns).

    An item belongs to the first group whose rule holds and has NULL in the
    columns that group does not know; items of no group are left out.
    """
    number = F.lit(None).cast("int")
    for n, (rule, _) in reversed(list(enumerate(groups))):
        number = F.when(rule, n).otherwise(number)
    wanted = list(dict.fromkeys(c for _, columns in groups for c in columns))
    others = [c for c in items.columns if c not in wanted]
    marked = items.withColumn("_group", number).where(F.col("_group").isNotNull())
    return marked.select(
        *others,
        *[
            F.when(F.col("_group").isin([n for n, (_, columns) in enumerate(groups) if c in columns]), F.col(c)).alias(c)
            for c in wanted
        ],
    )



def dedupe_latest(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each ``key`` by ``order``; rows without a key are no entity.

    Spark limits ``row_number() = 1`` per task before the shuffle, so a key with
    most of the rows sends one row per task.
    """
    place = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.where(F.col(key).isNotNull()).withColumn("_place", place).where(
        "_place = 1"
    ).drop("_place")


def listing_view(listings: DataFrame, created_at: Column | None = None) -> DataFrame:
    """The declared 20-column form, plus ``page_id`` and ``pos`` where present.

    ``created_at`` defaults to the load time. Area text is split at its first
    ``·`` or ``-``. Dates that do not parse are NULL.
    """
    area = F.split("jobAreaString", "[·-]", 2)
    also = [c for c in ("page_id", "pos") if c in listings.columns]
    return listings.select(
        *also,
        F.col("jobId").alias("job_id"),
        F.col("jobName").alias("job_title"),
        F.coalesce("fullCompanyName", "companyName").alias("company_name"),
        F.col("companyTypeString").alias("company_type"),
        F.col("companySizeString").alias("company_size"),
        F.col("jobSalaryMin").try_cast("int").alias("salary_min"),
        F.col("jobSalaryMax").try_cast("int").alias("salary_max"),
        F.col("provideSalaryString").alias("salary_range"),
        F.col("jobAreaCode").alias("location_code"),
        F.concat(F.substring("jobAreaCode", 1, 2), F.lit("0000")).alias("province_code"),
        area.getItem(0).alias("city_name"),
        F.get(area, F.lit(1)).alias("district"),
        F.col("jobDescribe").alias("job_describe"),
        F.col("workYearString").alias("work_experience"),
        F.col("degreeString").alias("degree_requirement"),
        F.col("issueDateString").try_cast("timestamp_ntz").alias("publish_date"),
        F.col("updateDateTime").try_cast("timestamp_ntz").alias("update_date"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        F.col("jobHref").alias("job_url"),
        F.col("companyHref").alias("company_url"),
    )


def not_null_rejects(view: DataFrame) -> DataFrame:
    """Per required column, how many rows lack it."""
    counted = view.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED_COLUMNS])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("rule"), F.col(c).alias("rejected"))
                    for c in REQUIRED_COLUMNS
                ]
            )
        )
    )


def storable(view: DataFrame) -> DataFrame:
    """Rows with every required column."""
    return view.dropna(subset=REQUIRED_COLUMNS)


def newest_first() -> list[Column]:
    """Total order of the copies of one job in a listing view."""
    return [
        F.col("update_date").desc_nulls_last(),
        F.col("page_id").desc(),
        F.col("pos").desc(),
    ]
