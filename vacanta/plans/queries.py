"""The registered queries: every operator over shapes of the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables.
Moments are written as text where the result must not depend on a time zone.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.operators import checks, envelope, events, listings, requests, search, sql, tasks
from vacanta.schemas import CHECK_EVENT, REQUEST_EVENT, TASK_KEYS
from vacanta.sources import samples, store, title_index, upsert
from vacanta.sources.areas import area_dimension, city_codes
from vacanta.sources.responses import read_responses, stream_log, stream_responses
from vacanta.sources.workspace import new_folder
from vacanta.streaming import frontier, hourly, ingest, streaks

Query = Callable[[SparkSession, str], DataFrame]

NOW, LATER = "2024-01-31 00:00:00", "2024-02-01 00:00:00"
LISTING_NOW = "1998-08-03 03:30:00"
# A page a minute, by number.
PAGE_MOMENT = "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(page_id as int))"
PAGE_NOW = "2024-06-01 00:00:00"
SEARCH_FROM = "1998-07-01 00:00:00"
KEYWORD = "n 5-LOW 6"


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS") for n in names})


def _big(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


# --- shapes -------------------------------------------------------------------

def _request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.shape(spark, sf_dir, samples.REQUEST_EVENT)


def _check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.shape(spark, sf_dir, samples.CHECK_EVENT)


def _task_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.shape(spark, sf_dir, samples.TASK_EVENT)


def _items(spark: SparkSession, sf_dir: str, *columns: str, **options) -> DataFrame:
    responses = samples.landed_responses(spark, sf_dir)
    return envelope.explode_items(responses, list(columns) or None, **options)


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.clean_items(_items(spark, sf_dir), area_dimension(spark))


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.listing_view(_listings(spark, sf_dir))


def _stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One storable row per job id, the newest copy."""
    return listings.dedupe_latest(
        listings.storable(_view(spark, sf_dir)), "job_id", listings.newest_first()
    )


_stores: dict[tuple[str, str], str] = {}


_indexes: dict[tuple[str, str], str] = {}


def _store_path(spark: SparkSession, sf_dir: str) -> str:
    """The listing store, written once per application and table set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        path = new_folder(spark, "listings")
        store.save_listings(_stored_rows(spark, sf_dir), path)
        _stores[key] = path
    return _stores[key]


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.read_listings(spark, _store_path(spark, sf_dir))


def _index_path(spark: SparkSession, sf_dir: str) -> str:
    """The title index of that store."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _indexes:
        path = new_folder(spark, "titles")
        title_index.build_title_index(spark, _store_path(spark, sf_dir), path)
        _indexes[key] = path
    return _indexes[key]


# --- sources ------------------------------------------------------------------

def scan_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = read_responses(spark, samples.landed_path(spark, sf_dir))
    return scanned.select(
        "page_id", "run", "kw", "city", "page",
        F.col("status_code").cast("bigint").alias("status_code"),
        F.length("body").cast("bigint").alias("body_chars"),
        F.md5("body").alias("body_md5"),
    )


def parse_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = envelope.usable_responses(samples.landed_responses(spark, sf_dir))
    parsed = envelope.parse_envelope(usable, columns=["jobId"])
    return parsed.select(
        "page_id", "is_json", "status_json", F.size("items").cast("bigint").alias("n_items")
    )


def explode_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(
        spark, sf_dir, "jobId", "jobName", "companyName", "jobDescribe", "jobSalaryMin"
    )
    return items.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "jobId", "jobName", "companyName",
        "jobDescribe", "jobSalaryMin",
    )


def sql_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql.execute_query(
        spark,
        """select location_code, count(*) as postings,
             cast(min(salary_min) as bigint) as lowest, cast(max(salary_max) as bigint) as highest
           from {store} group by location_code""",
        store=_store(spark, sf_dir),
    )


def city_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_codes(samples.shape(spark, sf_dir, samples.CITY_LINES))


# --- responses and pages ------------------------------------------------------

def classify_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.count_classes(samples.landed_responses(spark, sf_dir))


def classify_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same classes for real texts: web pages and prose in several languages."""
    bodies = [
        samples.table(spark, sf_dir, name).select(
            F.lit(name).alias("origin"), F.lit(200).alias("status_code"), F.col(column).alias("body")
        )
        for name, column in (("pages", "html"), ("documents", "text"))
    ]
    return envelope.count_classes(listings.union_pages(bodies), "origin")


def valid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = envelope.valid_pages(samples.landed_responses(spark, sf_dir))
    return valid.select("page_id", *TASK_KEYS, "page")


def page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.page_quality(samples.landed_responses(spark, sf_dir))


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _big(envelope.page_counts(samples.landed_responses(spark, sf_dir)), "jobs_count")


def _taken(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = envelope.page_outcomes(samples.landed_responses(spark, sf_dir))
    return tasks.pages_until_bad(outcomes, TASK_KEYS, _run_tasks(spark, sf_dir))


def _run_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.task_cities(samples.shape(spark, sf_dir, samples.RUN_CONFIG))


def all_pages_until_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``pages_until_bad``, with no limit but the pages that landed."""
    outcomes = envelope.page_outcomes(samples.landed_responses(spark, sf_dir))
    return tasks.pages_until_bad(outcomes, TASK_KEYS)


def pages_until_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taken(spark, sf_dir)


def task_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.task_grid(samples.shape(spark, sf_dir, samples.SEARCH_CONFIG))


def task_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.task_completion(_run_tasks(spark, sf_dir), _taken(spark, sf_dir), TASK_KEYS)


def failed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _run_tasks(spark, sf_dir).select(*TASK_KEYS)
    return tasks.failed_tasks(asked, _taken(spark, sf_dir), TASK_KEYS)


# --- listings -----------------------------------------------------------------

def listings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _big(_listings(spark, sf_dir), "pos")


def area_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings and salary span per area."""
    items = _items(spark, sf_dir, "jobSalaryMin", "jobSalaryMax")
    cleaned = listings.clean_items(items, area_dimension(spark))
    return cleaned.groupBy("search_city").agg(
        F.count("*").alias("postings"),
        F.min("jobSalaryMin").alias("lowest"),
        F.max("jobSalaryMax").alias("highest"),
    )


def decode_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = samples.landed_responses(spark, sf_dir).select("page_id", "city")
    return listings.decode_area(pages, area_dimension(spark), "city", "area")


def select_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir, "coId", "jobName", "companyName", "jobId", "term")
    return _big(listings.select_expected(items, also=["page_id", "pos"]), "pos")


def flatten_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = listings.flatten_lists(_items(spark, sf_dir, "jobTags"))
    return _big(flat.select("page_id", "pos", "jobTags"), "pos")


def cast_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    cast = listings.cast_salary(_items(spark, sf_dir, "jobSalaryMin", "jobSalaryMax"))
    return _big(cast.select("page_id", "pos", "jobSalaryMin", "jobSalaryMax"), "pos")


def cast_salary_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = listings.cast_salary_rejects(_items(spark, sf_dir, "jobSalaryMin", "jobSalaryMax"))
    return _big(rejects.select("page_id", "pos", "column_name", "value"), "pos")


def cast_salary_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir, "jobSalaryMin", "jobSalaryMax", page_flags=True)
    cast = listings.cast_salary_by_page(items)
    return _big(
        cast.select(
            "page_id", "pos", "jobSalaryMin", "jobSalaryMin_text", "jobSalaryMax",
            "jobSalaryMax_text",
        ),
        "pos",
    )


def union_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items appended from groups of pages that know different columns."""
    page = F.col("page")
    groups = [
        (page == 1, ["jobId", "jobName"]),
        (page.between(2, 5), ["jobId", "companyName"]),
        (page > 5, ["jobId", "jobName", "term"]),
    ]
    items = _items(spark, sf_dir, "jobId", "jobName", "companyName", "term")
    appended = listings.known_columns(items, groups)
    return _big(appended.select("page_id", "pos", "jobId", "jobName", "companyName", "term"), "pos")


def page_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that items have, by page number."""
    return envelope.item_columns(samples.landed_responses(spark, sf_dir), "page")


def listing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = listings.listing_view(_listings(spark, sf_dir), created_at=_moment(NOW))
    return _big(
        _text(view, "publish_date", "update_date", "created_at"), "pos", "salary_min", "salary_max"
    )


def not_null_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.not_null_rejects(_view(spark, sf_dir))


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stored_rows(spark, sf_dir).select(
        "job_id", "page_id", "pos", "job_title", "company_name", "salary_min", "update_date"
    )
    return _big(_text(rows, "update_date"), "pos", "salary_min")


# --- store --------------------------------------------------------------------

def _save(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Save two frames to a new table with ``mode`` and read it back."""
    path = new_folder(spark, "saved")
    name = "saved_" + path.rsplit("-", 1)[1]
    rows = _items(spark, sf_dir, "jobId", "companyName")
    first = rows.where("page <= 5").select("page_id", "jobId", "companyName")
    second = rows.where("page > 5").select("page_id", "jobId", "companyName")
    store.save_frame(first, name, "append", path=path)
    store.save_frame(second, name, mode, path=path)
    return spark.table(name)


def save_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _save(spark, sf_dir, "append")


def save_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _save(spark, sf_dir, "replace")


def save_fail_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _save(spark, sf_dir, "fail")


def upsert_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after a first load and an upsert of the pages that came later."""
    rows = samples.landed_responses(spark, sf_dir)
    path = new_folder(spark, "upserted")
    for pages in (rows.where("page <= 4"), rows.where("page > 4")):
        cleaned = listings.clean_items(envelope.explode_items(pages), area_dimension(spark))
        upsert.upsert(path, listings.listing_view(cleaned))
    return _found(upsert.read_upserted(spark, path))


FOUND = ["job_id", "page_id", "job_title", "company_name", "location_code", "salary_min", "salary_max"]


def _found(df: DataFrame) -> DataFrame:
    return _big(df.select(*FOUND), "salary_min", "salary_max")


def by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(search.by_company(_store(spark, sf_dir), "Company 7 Ltd"))


def by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(search.by_location(_store(spark, sf_dir), "050200"))


def by_salary_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(search.by_salary_range(_store(spark, sf_dir), 1000, 2500))


def by_publish_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(search.by_publish_date(_store(spark, sf_dir), "1998-01-01", "1998-07-01"))


def recent_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.recent_inserts(_store(spark, sf_dir), _moment(LISTING_NOW))


def search_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search_postings(
        _store(spark, sf_dir), keyword="python 1", page=2, companyType="Public"
    )
    return _found(found)


def search_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword search through the title index."""
    paths = _store_path(spark, sf_dir), _index_path(spark, sf_dir)
    view = title_index.listings_with(spark, *paths, KEYWORD)
    return _found(search.search_postings(view, keyword=KEYWORD))


def search_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result page of one province."""
    return _found(search.search_postings(_store(spark, sf_dir), jobArea="050000", sortType="1"))


def search_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that follows a given row."""
    later = search.after_row(_store(spark, sf_dir), SEARCH_FROM, "J")
    return _found(search.search_postings(later, page_size=15))


def search_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search on listings as the pages carry them."""
    items = _items(
        spark, sf_dir, "jobId", "jobName", "jobType", "industryType1", "updateDateTime"
    ).select("page_id", "pos", "jobId", "jobName", "jobType", "industryType1", "updateDateTime")
    updated = F.col("updateDateTime").try_cast("timestamp_ntz")
    newest = listings.dedupe_latest(
        items, "jobId", [updated.desc_nulls_last(), F.col("page_id").desc(), F.col("pos").desc()]
    )
    found = search.search_postings(newest, keyword="DATA", jobType="1", industry="3", function="")
    return found.select("page_id", "jobId", "jobName", "updateDateTime")


def sql_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql.execute_query(
        spark,
        """select company_name, count(*) as postings from {store}
           where salary_min > :low and degree_requirement = :degree group by company_name""",
        {"low": 2000, "degree": "Master"},
        store=_store(spark, sf_dir),
    )


def sql_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE and INSERT with ``%s`` parameters, then the table."""
    path = new_folder(spark, "statement")
    name = "statement_" + path.rsplit("-", 1)[1]
    sql.execute_sql(
        spark, f"create table {name} (job_id string, salary_min bigint) using parquet location '{path}'"
    )
    _store(spark, sf_dir).createOrReplaceTempView(f"{name}_source")
    sql.execute_sql(
        spark,
        f"insert into {name} select job_id, salary_min from {name}_source"
        " where salary_min >= %s and company_type = %s",
        [3000, "Private"],
    )
    return spark.table(name)


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in TABLES:
        samples.table(spark, sf_dir, name).createOrReplaceTempView(f"given_{name}")
    names = [f"given_{name}" for name in TABLES] + ["given_nowhere"]
    return sql.table_profile(spark, names)


# --- request log --------------------------------------------------------------

def request_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.request_totals(_request_log(spark, sf_dir))


def _ragged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.shape(spark, sf_dir, samples.RAGGED_EVENT)


def log_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.log_balance(_ragged_log(spark, sf_dir))


def ragged_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts over a log with rows that lack order, source or outcome."""
    summary = requests.request_summary(_ragged_log(spark, sf_dir))
    return requests.with_verdict(summary, _moment(NOW)).select(
        "source", "total_requests", "failed_requests", "consecutive_failures", "health_message"
    )


def _page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.expr(f"{PAGE_MOMENT}")
    return events.request_events(samples.landed_responses(spark, sf_dir), at)


def page_request_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request totals of each run, from its landed pages."""
    return requests.request_totals(_page_log(spark, sf_dir))


def page_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of the report of each run, from its landed pages and tasks."""
    landed = samples.landed_responses(spark, sf_dir)
    facts = events.save_page_facts(landed, new_folder(spark, "facts"))
    taken = tasks.pages_until_bad(facts, TASK_KEYS, _run_tasks(spark, sf_dir))
    tasks_ = events.task_events(_run_tasks(spark, sf_dir), taken, facts)
    log = events.events_of_facts(facts, F.expr(PAGE_MOMENT))
    report = requests.report(log, tasks_, _moment(PAGE_NOW))
    errors = F.transform(
        F.array_sort(F.map_entries("error_breakdown")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return report.select(
        "source", "health_message", "statistics.total_requests", "statistics.total_jobs_crawled",
        "statistics.cities_completed", "statistics.cities_failed", "statistics.consecutive_failures",
        F.array_join(errors, ";").alias("errors"), F.size("recent_hourly_stats").cast("bigint").alias("hours"),
    )


def success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.success_rate(_request_log(spark, sf_dir))


def error_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.error_breakdown(_request_log(spark, sf_dir))


def hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.hourly_stats(_request_log(spark, sf_dir))


def last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(requests.last_success(_request_log(spark, sf_dir)), "last_success_time")


def consecutive_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.consecutive_failures(_request_log(spark, sf_dir))


def avg_last100(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rounded because engines add doubles in different orders.
    return requests.avg_response_time(_request_log(spark, sf_dir)).withColumn(
        "avg_response_time", F.round("avg_response_time", 6)
    )


def recent_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.recent_hours(_request_log(spark, sf_dir))


def health_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.health_verdict(_request_log(spark, sf_dir), _moment(NOW))


def health_verdict_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day on, when every source has been silent for over an hour."""
    return requests.health_verdict(_request_log(spark, sf_dir), _moment(LATER))


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _big(requests.recommendations(_request_log(spark, sf_dir)), "place")


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.report(_request_log(spark, sf_dir), _task_log(spark, sf_dir), _moment(NOW))


def _flat_report(report: DataFrame) -> DataFrame:
    """The nested report with maps and lists as sorted text."""
    errors = F.transform(
        F.array_sort(F.map_entries("error_breakdown")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    hours = F.transform(
        F.array_sort(F.map_entries("recent_hourly_stats")),
        lambda e: F.concat_ws("/", e["key"], e["value"]["requests"].cast("string"),
                              e["value"]["success"].cast("string"), e["value"]["jobs"].cast("string")),
    )
    return report.select(
        "source", "timestamp", F.round("runtime_hours", 6).alias("runtime_hours"),
        "health_status", "health_message", "statistics.*",
        F.array_join(errors, ";").alias("error_breakdown"),
        F.array_join("recommendations", ";").alias("recommendations"),
        F.array_join(hours, ";").alias("recent_hourly_stats"),
    )


def report_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_report(_report(spark, sf_dir))


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written as JSON and read back."""
    path = new_folder(spark, "report")
    report = _report(spark, sf_dir)
    requests.save_report(report, path)
    return _flat_report(spark.read.schema(report.schema).json(path))


def report_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.report_checkpoints(_task_log(spark, sf_dir))


# --- check log ----------------------------------------------------------------

def check_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(
        checks.check_totals(_check_log(spark, sf_dir)),
        "last_check_time", "last_success_time", "last_failure_time",
    )


def failure_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_runs(_check_log(spark, sf_dir))


def streak_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.streak_alerts(_check_log(spark, sf_dir))


def last_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _big(_text(checks.last_errors(_check_log(spark, sf_dir)), "ts"), "place")


def error_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.error_patterns(_check_log(spark, sf_dir))


def diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _big(checks.diagnosis(_check_log(spark, sf_dir)), "line_no")


def slow_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.slow_checks(_check_log(spark, sf_dir))


def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = checks.check_report(_check_log(spark, sf_dir))
    errors = F.transform(
        "last_errors", lambda e: F.concat(e["seq"].cast("string"), F.lit(":"), e["error"])
    )
    return report.select(
        "source", "total_checks", "success_rate", "current_streak", "max_streak",
        F.coalesce(F.array_join(errors, ";"), F.lit("")).alias("last_errors"),
    )


def check_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_details(_store(spark, sf_dir), _moment(LISTING_NOW))


# --- streams ------------------------------------------------------------------

_logs: dict[tuple[str, str, str], str | tuple[str, int]] = {}
FIRST_SEEN_ORDER = (2, 0, 1)  # page_id modulo 3, in order of arrival


SLICES, SLICE_FILES = 4, 2


def _landed_log(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame, newest_first: bool) -> str:
    """A log landed in slices of ``seq``, one after the other; a slice is ``SLICE_FILES`` files."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _logs:
        path = new_folder(spark, name)
        span = (rows.agg(F.max("seq")).first()[0] or 0) + 1
        order = range(SLICES)
        for i in reversed(order) if newest_first else order:
            part = rows.where(F.col("seq").between(span * i // SLICES, span * (i + 1) // SLICES - 1))
            part.repartition(SLICE_FILES).write.mode("append").parquet(path)
        _logs[key] = path
    return _logs[key]


def _landed_slices(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Landed pages in slices, the youngest ids in the middle one, and the files of a slice.

    A slice has more files the more pages it has, all slices the same number, so
    that a batch of so many files is a slice. With 1,000 pages a file in the
    smallest slice none is left empty.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "slices")
    if key not in _logs:
        path = new_folder(spark, "slices")
        pages = samples.page_base(spark, sf_dir)
        parts = [pages.where(F.col("page_id") % 3 == part) for part in FIRST_SEEN_ORDER]
        sizes = [part.count() for part in parts]
        wanted = max(-(-max(sizes) // samples.PAGES_PER_FILE), spark.sparkContext.defaultParallelism)
        files = max(SLICE_FILES, min(wanted, min(sizes) // 1000))
        for part in parts:
            samples.write_pages(part, path, files, mode="append")
        _logs[key] = path, files
    return _logs[key]


def _slice_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, files = _landed_slices(spark, sf_dir)
    return stream_responses(spark, path, files_per_batch=files)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = stream_responses(spark, samples.landed_path(spark, sf_dir))
    rows = ingest.ingest(
        responses, area_dimension(spark), new_folder(spark, "ingested"), new_folder(spark, "offsets")
    )
    return _big(rows, "pos")


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_log(spark, sf_dir, "request_log", _request_log(spark, sf_dir), newest_first=True)
    log = stream_log(spark, path, REQUEST_EVENT, files_per_batch=SLICE_FILES)
    return hourly.hourly_so_far(log, new_folder(spark, "hours"), new_folder(spark, "offsets"))


def stream_closed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours the watermark has closed, with what came too late for it added."""
    path = _landed_log(spark, sf_dir, "request_log", _request_log(spark, sf_dir), newest_first=True)
    log = stream_log(spark, path, REQUEST_EVENT, files_per_batch=SLICE_FILES)
    closed = hourly.closed_hours(log, new_folder(spark, "closed"), new_folder(spark, "offsets"))
    so_far = hourly.hourly_so_far(log, new_folder(spark, "hours"), new_folder(spark, "offsets"))
    return hourly.exact_hours(closed, hourly.corrections(so_far, closed))


def stream_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources without a success for an hour, by the stream's clock."""
    path = _landed_log(spark, sf_dir, "request_log_by_time", _request_log(spark, sf_dir), newest_first=False)
    log = stream_log(spark, path, REQUEST_EVENT, files_per_batch=SLICE_FILES)
    told = streaks.watch_silence(log, new_folder(spark, "silence"), new_folder(spark, "offsets"), ok="success")
    return _text(told, "last_success", "silent_at")


def _streaks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = _landed_log(spark, sf_dir, "check_log", _check_log(spark, sf_dir), newest_first=False)
    log = stream_log(spark, path, CHECK_EVENT, files_per_batch=SLICE_FILES)
    return streaks.follow_streaks(log, new_folder(spark, "streaks"), new_folder(spark, "offsets"))


def stream_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streaks(spark, sf_dir)[0].drop("last_seq")


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streaks(spark, sf_dir)[1]


def _followed(spark: SparkSession, sf_dir: str) -> frontier.TaskPages:
    """Tasks followed over pages of which a third lands at a time, every third page of a task."""
    responses = _slice_stream(spark, sf_dir)
    limits = _run_tasks(spark, sf_dir)
    return frontier.follow_tasks(
        responses, TASK_KEYS, new_folder(spark, "tasks"), new_folder(spark, "offsets"), limits
    )


def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _followed(spark, sf_dir).taken()


def stream_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _followed(spark, sf_dir).completion(_run_tasks(spark, sf_dir))


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = _slice_stream(spark, sf_dir)
    items = envelope.explode_items(responses, ["jobId"]).select("jobId", "page_id")
    return ingest.write_first_seen(
        items, "jobId", new_folder(spark, "first_seen"), new_folder(spark, "offsets")
    )


QUERIES: dict[str, Query] = {
    "area_summary": area_summary,
    "scan_responses": scan_responses,
    "parse_envelope": parse_envelope,
    "explode_items": explode_items,
    "sql_scan": sql_scan,
    "city_codes": city_codes_query,
    "classify_response": classify_response,
    "classify_texts": classify_texts,
    "valid_pages": valid_pages,
    "page_quality": page_quality,
    "page_counts": page_counts,
    "pages_until_bad": pages_until_bad,
    "all_pages_until_bad": all_pages_until_bad,
    "task_grid": task_grid,
    "task_completion": task_completion,
    "failed_tasks": failed_tasks,
    "listings": listings_query,
    "decode_area": decode_area,
    "select_expected": select_expected,
    "flatten_lists": flatten_lists,
    "cast_salary": cast_salary,
    "cast_salary_rejects": cast_salary_rejects,
    "cast_salary_by_page": cast_salary_by_page,
    "union_pages": union_pages,
    "page_columns": page_columns,
    "listing_view": listing_view,
    "not_null_rejects": not_null_rejects,
    "dedupe_latest": dedupe_latest,
    "save_append": save_append,
    "save_replace": save_replace,
    "save_fail_if_exists": save_fail_if_exists,
    "upsert_listings": upsert_listings,
    "by_company": by_company,
    "by_location": by_location,
    "by_salary_range": by_salary_range,
    "by_publish_date": by_publish_date,
    "recent_inserts": recent_inserts,
    "search_postings": search_postings,
    "search_listings": search_listings,
    "search_keyword": search_keyword,
    "search_province": search_province,
    "search_after": search_after,
    "sql_named": sql_named,
    "sql_positional": sql_positional,
    "table_profile": table_profile,
    "request_totals": request_totals,
    "log_balance": log_balance,
    "ragged_verdict": ragged_verdict,
    "page_request_totals": page_request_totals,
    "page_report": page_report,
    "success_rate": success_rate,
    "error_breakdown": error_breakdown,
    "hourly_stats": hourly_stats,
    "last_success": last_success,
    "consecutive_failures": consecutive_failures,
    "avg_last100": avg_last100,
    "recent_hours": recent_hours,
    "health_verdict": health_verdict,
    "health_verdict_later": health_verdict_later,
    "recommendations": recommendations,
    "report_struct": report_struct,
    "report_json": report_json,
    "report_checkpoints": report_checkpoints,
    "check_totals": check_totals,
    "failure_runs": failure_runs,
    "streak_alerts": streak_alerts,
    "last_errors": last_errors,
    "error_patterns": error_patterns,
    "diagnosis": diagnosis,
    "slow_checks": slow_checks,
    "check_report": check_report,
    "check_details": check_details,
    "stream_ingest": stream_ingest,
    "stream_hourly": stream_hourly,
    "stream_closed_hours": stream_closed_hours,
    "stream_silence": stream_silence,
    "stream_streaks": stream_streaks,
    "stream_alerts": stream_alerts,
    "stream_dedupe": stream_dedupe,
    "stream_pages": stream_pages,
    "stream_completion": stream_completion,
}
