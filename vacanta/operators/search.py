"""Lookups and searches on stored listings.

All are plain filters, so they reach the parquet scan: province folders are
pruned; location, salary and date filters skip row groups by their statistics
and company filters by Bloom filters (``sources/store.py`` says how the store is
laid out). ``sources/title_index.py`` narrows a keyword search to some files.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import PAGE_SIZE

# Search slot -> column compared for equality: in the declared form of a
# listing, then in the form the pages carry.
SEARCH_SLOTS = {
    "salary": ("salary_range", "provideSalaryString"),
    "workYear": ("work_experience", "workYear"),
    "degree": ("degree_requirement", "degreeString"),
    "companyType": ("company_type", "companyTypeString"),
    "companySize": ("company_size", "companySizeCode"),
    "issueDate": ("publish_date", "issueDateString"),
    "jobType": ("jobType",),
    "industry": ("industryType1",),
}


def _column(df: DataFrame, *names: str) -> str:
    for name in names:
        if name in df.columns:
            return name
    raise ValueError(f"no column to search: {names}")


def _in_area(view: DataFrame, code: str) -> Column:
    """A province code (``050000``) covers its province, any other code its district."""
    location = F.col(_column(view, "location_code", "jobAreaCode"))
    if code.endswith("0000"):
        if "province_code" in view.columns:
            return F.col("province_code") == code
        return F.startswith(location, F.lit(code[:2]))
    if "province_code" in view.columns:  # names the folder to read
        return (F.col("province_code") == f"{code[:2]}0000") & (location == code)
    return location == code


def by_company(view: DataFrame, company: str) -> DataFrame:
    return view.where(F.col("company_name") == company)


def by_location(view: DataFrame, location: str) -> DataFrame:
    """Listings of one location; its province names the folder to read."""
    return view.where(
        (F.col("province_code") == f"{location[:2]}0000") & (F.col("location_code") == location)
    )


def after_row(view: DataFrame, update_date: str | None, job_id: str) -> DataFrame:
    """Rows that follow a result row in search order, to page on from it.

    A page is then its first ``page_size`` rows, however deep it lies; an offset
    would carry all rows before it through one task.
    """
    later = F.col("job_id") > job_id
    if update_date is None:
        return view.where(F.col("update_date").isNull() & later)
    at = F.lit(update_date).cast("timestamp_ntz")
    older = F.col("update_date").isNull() | (F.col("update_date") < at)
    return view.where(older | ((F.col("update_date") == at) & later))


def by_salary_range(view: DataFrame, low: int, high: int) -> DataFrame:
    """Listings whose whole salary span lies in ``low`` ... ``high``."""
    return view.where((F.col("salary_min") >= low) & (F.col("salary_max") <= high))


def _on_days(view: DataFrame, day: str, low: Column, high: Column | None = None) -> DataFrame:
    """The stored day, where the view has it, lets the scan skip what lies outside."""
    if day not in view.columns:
        return view
    within = view.where(F.col(day) >= low.cast("date"))
    return within if high is None else within.where(F.col(day) <= high.cast("date"))


def by_publish_date(view: DataFrame, start: str, end: str) -> DataFrame:
    """Listings published from ``start`` up to, not including, ``end``."""
    low, high = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    published = F.col("publish_date")
    return _on_days(view.where((published >= low) & (published < high)), "publish_day", low, high)


def recent_inserts(view: DataFrame, now: Column, hours: int = 1) -> DataFrame:
    """Number of listings updated after ``now`` minus ``hours``."""
    since = now - F.make_dt_interval(hours=F.lit(hours))
    recent = _on_days(view.where(F.col("update_date") > since), "update_day", since)
    return recent.agg(F.count("*").alias("recent_inserts"))


def search_postings(
    view: DataFrame, keyword: str = "", page: int = 1, page_size: int = PAGE_SIZE, **slots: str
) -> DataFrame:
    """One result page: newest first, then by job id.

    ``keyword`` is a case-insensitive part of the title, ``jobArea`` a province
    or a district; every other slot is compared for equality, and a blank slot
    does not filter. ``sortType`` "1", the only order there is, may be named. ``view`` is a
    listing in either form with one row per job id, which makes the order total.
    """
    found = view
    if keyword:
        title = F.col(_column(view, "job_title", "jobName"))
        found = found.where(F.contains(F.lower(title), F.lower(F.lit(keyword))))
    if slots.pop("sortType", "1") not in ("", "1"):
        raise ValueError("only sortType 1, newest first, is known")
    if area := slots.pop("jobArea", ""):
        found = found.where(_in_area(view, area))
    for slot, value in slots.items():
        if value:
            found = found.where(F.col(_column(view, *SEARCH_SLOTS.get(slot, ()))) == value)
    updated = F.col(_column(view, "update_date", "updateDateTime"))
    if "updateDateTime" in view.columns:
        updated = updated.try_cast("timestamp_ntz")
    return (
        found.orderBy(updated.desc_nulls_last(), _column(view, "job_id", "jobId"))
        .offset((page - 1) * page_size)
        .limit(page_size)
    )
