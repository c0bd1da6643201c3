"""The engine's input shapes, derived from the star-schema tables.

The SQL of a shape is plain enough to run in Spark and in an ANSI engine, so a
check can start from the same rows. ``{orders}``, ``{events}`` and
``{customer}`` stand for the tables. Every shape is a row-by-row projection of
one table: no join, no window, no collected group, whatever the size.
"""

import re

from pyspark.sql import DataFrame, SparkSession

from vacanta.sources.responses import read_responses
from vacanta.sources.workspace import new_folder

# One landed page per order: fifteen pages make a task, 165 tasks (5 keywords x 33
# areas, the last one unknown) make a run.
PAGE_BASE = """
select *, cast(floor(task_no / 165) as bigint) as run,
  case task_no % 5 when 0 then 'Python' when 1 then 'Java' when 2 then 'Data'
    when 3 then 'Sales' else 'Design' end as kw,
  lpad(cast((cast(floor(task_no / 5) as bigint) % 33 + 1) * 10000 as string), 6, '0') as city,
  case page_id % 53 when 0 then 403 when 1 then 429 when 2 then 503 when 3 then 521
    when 4 then 500 when 5 then 404 else 200 end as status_code,
  case when page_id % 41 = 7 then 'challenge' when page_id % 37 = 5 then 'blank'
    when page_id % 31 = 11 then 'error' when page_id % 43 = 2 then 'broken'
    when page_id % 61 = 3 then 'trailing' when page_id % 67 = 4 then 'list_result'
    when o_orderstatus = 'P' and page_id % 5 = 0 then 'refused'
    when page_id % 47 = 9 then 'numeric' when page_id % 59 = 13 then 'no_items'
    else 'page' end as kind
from (select o_orderkey as page_id, cast(floor(o_orderkey / 15) as bigint) as task_no,
        o_orderkey % 15 + 1 as page, o_custkey % 8 as n_items,
        o_custkey, o_orderstatus, o_orderdate, o_orderpriority
      from {orders}) o
"""

# Values of item i (1 ... n_items) of a page; NULL means the key is absent.
ITEM_VALUES = {
    "jobId": "case when (page_id + i) % 97 <> 0 then concat('J', cast(o_custkey as string), '-', cast(i as string)) end",
    "jobType": "cast(i % 2 as string)",
    "jobName": "case when (page_id + i) % 89 <> 0 then concat(kw, ' ', o_orderpriority, ' ', cast(i as string)) end",
    "jobAreaCode": "case when (page_id + i) % 83 <> 0 then concat(substr(city, 1, 2), '0', cast(i as string), '00') end",
    "jobAreaString": "case i % 4 when 0 then concat('City', substr(city, 1, 2), '·District', cast(i as string))"
    " when 1 then concat('City', substr(city, 1, 2), '-District', cast(i as string))"
    " when 2 then concat('City', substr(city, 1, 2)) end",
    "provideSalaryString": "concat(cast(i as string), '-', cast(i + 2 as string), 'k')",
    "issueDateString": "case when (page_id + i) % 19 = 0 then 'soon' else substr(cast(o_orderdate as string), 1, 10) end",
    "workYear": "cast(o_custkey % 6 as string)",
    "workYearString": "concat(cast(o_custkey % 6 as string), ' years')",
    "degreeString": "case o_custkey % 3 when 0 then 'Bachelor' when 1 then 'Master' end",
    "industryType1": "cast(o_custkey % 9 as string)",
    "companyName": "concat('Company ', cast(o_custkey % 100 as string))",
    "fullCompanyName": "case when o_custkey % 3 <> 0 then concat('Company ', cast(o_custkey % 100 as string), ' Ltd') end",
    "companyTypeString": "case when o_custkey % 4 = 0 then 'Private' else 'Public' end",
    "companySizeString": "concat(cast(o_custkey % 5 as string), '00+')",
    "companySizeCode": "cast(o_custkey % 5 as string)",
    "updateDateTime": "case when (page_id + i) % 17 = 0 then 'recently'"
    " else concat(substr(cast(o_orderdate as string), 1, 10), ' 0', cast(i as string), ':00:00') end",
    "jobHref": "concat('/job/', cast(page_id as string), '/', cast(i as string))",
    "companyHref": "concat('/co/', cast(o_custkey % 100 as string))",
    "jobDescribe": "concat(o_orderpriority, chr(10), '\"', kw, '\" 数据')",
    "term": "cast(i % 3 as string)",
    "coId": "cast(o_custkey % 100 as string)",
    "jobSalaryMax": "cast((o_custkey % 50 + i) * 150 as string)",
    "jobSalaryMin": "case (page_id + i) % 23 when 0 then '' when 1 then concat(' ', cast(o_custkey % 50 * 100 as string), ' ')"
    " when 2 then '1_000' when 3 then '1d' when 4 then '1万'"
    " else cast(o_custkey % 50 * 100 as string) end",
}
# JSON text of the list columns, and the value each must flatten to.
TAGS_JSON = """case (page_id + i) % 8 when 0 then '["pension","day shift"]' when 1 then '[]'
  when 2 then '"flexible"' when 3 then '5' when 4 then 'null'
  when 6 then '["a",null,"b"]' when 7 then '["x"]' end"""
TAGS_VALUE = """case (page_id + i) % 8 when 0 then 'pension,day shift' when 1 then ''
  when 2 then 'flexible' when 3 then '5' when 6 then 'a,b' when 7 then 'x' end"""


def _item_parts() -> list[str]:
    """The text of an item in parts; no part is NULL."""
    parts = ["'{'"]
    for name, value in ITEM_VALUES.items():
        if name == "jobDescribe":  # line feed and quotes need JSON escapes
            value = "concat(o_orderpriority, chr(92), 'n', chr(92), '\"', kw, chr(92), '\" 数据')"
        parts.append(f"coalesce('\"{name}\":\"' || {value} || '\",', '')")
    # || is NULL when a side is NULL in every engine, concat is not.
    parts.append(f"coalesce('\"jobTags\":' || {TAGS_JSON} || ',', '')")
    return [*parts, "'\"madeUpKey\":1}'"]


def _item_json() -> str:
    return f"concat({', '.join(_item_parts())})"


# Body text of a page, given the text of all its items.
PAGE_BODY = """case kind
  when 'challenge' then concat('<html>var arg1=', chr(39), 'A1B2C3', chr(39), ';</html>')
  when 'blank' then '   '
  when 'error' then '{"msg":"Error"}'
  when 'broken' then '{"status":"1","resultbody":{"job":'
  when 'no_items' then '{"status":"1","resultbody":{"job":{}}}'
  when 'list_result' then '{"status":"1","resultbody":[]}'
  else concat('{"status":', case kind when 'refused' then '"0"' when 'numeric' then '1' else '"1"' end,
    ',"resultbody":{"job":{"items":[', items_text, ']}}}', case kind when 'trailing' then ' garbage' else '' end) end"""



def _spark_items_text() -> str:
    """The text of all items of a page, as ``_item_json`` gives each.

    Most keys have the same value in every item of a page. Runs of these are put
    together once a page, as the one element of an array, and not once an item:
    a lambda is not compiled, so its body is the cost of landing.
    """
    runs: list[tuple[bool, list[str]]] = []
    for part in _item_parts():
        by_item = re.search(r"\bi\b", re.sub(r"'[^']*'", "", part)) is not None
        if not runs or runs[-1][0] != by_item:
            runs.append((by_item, []))
        runs[-1][1].append(part)
    same, pieces = [], []
    for by_item, parts in runs:
        if by_item:
            pieces += parts
        else:
            pieces.append(f"same.s{len(same)}")
            same.append(f"concat({', '.join(parts)}) as s{len(same)}")
    items = f"array_join(transform(sequence(1, n_items), i -> concat({', '.join(pieces)})), ',')"
    return f"case when n_items = 0 then '' else transform(array(struct({', '.join(same)})), same -> {items})[0] end"


SPARK_ITEMS_TEXT = _spark_items_text()
DUCKDB_ITEMS_TEXT = (
    "array_to_string(list_transform(range(1, n_items + 1), lambda i: " + _item_json() + "), ',')"
)

REQUEST_EVENT = """
select event_id as seq, ts, source, success,
  case when event_id % 10 = 0 then cast(0 as double) when event_id % 10 = 1 then null
    else value end as response_time,
  case when success then null when source = 2 then 'anti_spider_suspected'
    when event_id % 5 = 0 then 'Anti_Spider_suspected'
    when event_id % 5 = 1 then 'database_save_failed'
    when event_id % 5 = 2 then 'IP_BLOCKED' when event_id % 5 = 3 then ''
    else 'request_exception_Timeout' end as error_type,
  case when success then event_id % 21 else 0 end as jobs_count
from (select *, case
        when source = 0 then event_type <> 'error' and ts < cast('2024-01-29 00:00:00' as timestamp)
        when source = 1 then event_type = 'click'
        when source = 2 then event_type in ('click', 'view')
        else event_type <> 'error' end as success
      from (select *, user_id % 10 as source from {events}) s) e
"""

# The same log with what recorded logs lack here and there: order, source, outcome.
RAGGED_EVENT = f"""
select case when seq % 11 <> 3 then seq end as seq, ts,
  case when source <> 4 then source end as source, case when seq % 7 <> 2 then success end as success,
  response_time, error_type, jobs_count
from ({REQUEST_EVENT}) whole
"""

CHECK_EVENT = """
select event_id as seq, ts, user_id % 10 as source, event_type <> 'error' as ok,
  value / 50 as response_time,
  case when event_type <> 'error' then null
    when event_id % 5 = 0 then 'Read TIMEOUT after 60s'
    when event_id % 5 = 1 then 'Lost connection to server'
    when event_id % 5 = 2 then 'OperationalError 2013'
    when event_id % 5 = 3 then 'timeout waiting for connection'
    else 'table is locked' end as error
from {events}
"""

TASK_EVENT = """
select o_orderkey as seq, o_orderdate as ts, o_custkey % 10 as source,
  o_orderpriority as kw, lpad(cast((o_custkey % 33 + 1) * 10000 as string), 6, '0') as city,
  o_orderstatus <> 'F' as success
from {orders}
"""

# One search configuration per customer, as comma text without trimming.
SEARCH_CONFIG = """
select c_custkey as config_id, concat(c_mktsegment, ',', c_name, ',x') as kws,
  case when c_custkey % 5 = 0 then concat('010000,', '000000')
    else concat(lpad(cast((c_nationkey + 1) * 10000 as string), 6, '0'), ',990000') end as cities,
  case when c_custkey % 3 <> 0 then c_custkey % 7 + 1 end as max_page
from {customer}
"""

# The configuration of each run of PAGE_BASE: all areas, or two named ones.
RUN_CONFIG = """
select run, 'Python,Java,Data,Sales,Design' as kws,
  case when run % 2 = 0 then '000000' else '010000,330000' end as cities,
  case run % 3 when 0 then 14 when 1 then 3 end as max_page
from (select distinct cast(floor(o_orderkey / 2475) as bigint) as run from {orders}) r
"""

# Lines of "<digits>":"<name>" text.
CITY_LINES = """
select c_custkey as line,
  concat('{{"', lpad(cast((c_nationkey + 1) * 10000 as string), 6, '0'), '":"City', cast(c_nationkey as string),
    '","', lpad(cast(c_custkey as string), 7, '1'), '":"', c_name, '","x":"y"}}') as text
from {customer}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A shape of this module over the tables in ``sf_dir``."""
    used = [t for t in ("orders", "events", "customer") if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


# About 40 MB of text a file.
PAGES_PER_FILE = 20_000

_landed: dict[tuple[str, str], str] = {}


def page_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow row per landed page, from which ``write_pages`` makes its text."""
    return shape(spark, sf_dir, PAGE_BASE)


def write_pages(pages: DataFrame, path: str, files: int, mode: str = "errorifexists") -> None:
    """Write rows of ``page_base`` as landed responses into so many files of like size.

    A page's text is some twenty times its row, so rows are spread before the
    text is made, over as many tasks as files, and no text is ever shuffled.
    """
    (
        pages.repartition(files)
        .selectExpr("*", f"{SPARK_ITEMS_TEXT} as items_text")
        .selectExpr("page_id", "run", "kw", "city", "page", "status_code", f"{PAGE_BODY} as body")
        .write.mode(mode)
        .parquet(path)
    )


def landed_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of landed responses, written once per application and table set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        path = new_folder(spark, "landed")
        pages = page_base(spark, sf_dir)
        files = -(-pages.count() // PAGES_PER_FILE)
        write_pages(pages, path, max(files, spark.sparkContext.defaultParallelism))
        _landed[key] = path
    return _landed[key]


def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_responses(spark, landed_path(spark, sf_dir))
