"""An independent ANSI-SQL statement of each registered query.

They start from the tables themselves: the JSON text is skipped where the rows
can be named directly, so equality also proves the round trip through JSON.
"""

from vacanta import fixed_values as fixed
from vacanta.plans.queries import TABLES
from vacanta.sources import samples


def _from_tables(sql: str) -> str:
    return sql.format(orders="orders", events="events", customer="customer")


def _values(*names: str) -> str:
    return ", ".join(f"{samples.ITEM_VALUES[n]} as {n}" for n in names)


_AREA_ROWS = ", ".join(f"('{code}', '{name}')" for code, name in fixed.AREAS.items())
_ALL_CODES = "[" + ", ".join(f"'{code}'" for code in fixed.AREAS) + "]"

_PAGES = f"pages0 as ({_from_tables(samples.PAGE_BASE)})"
_BODIES = f"""{_PAGES}, bodies as (
  select *, {samples.PAGE_BODY} as body
  from (select *, {samples.DUCKDB_ITEMS_TEXT} as items_text from pages0) p)"""
_OUTCOMES = f"""{_PAGES}, outcomes as (
  select *, status_code = 200 and kind = 'page' and n_items > 0 as good from pages0)"""
# i counts from 1, pos from 0.
_ITEMS = f"""{_OUTCOMES}, area as (select * from (values {_AREA_ROWS}) v(code, name)),
items as (
  select *, i - 1 as pos from (
    select o.*, unnest(range(1, n_items + 1)) as i from outcomes o where good) u)"""
_NUMBER = r"'^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)\s*$'"


def _number(column: str) -> str:
    return f"case when regexp_matches({column}, {_NUMBER}) then try_cast(trim({column}) as double) end"


def _bad(column: str) -> str:
    return f"coalesce({column} <> '' and not regexp_matches({column}, {_NUMBER}), false)"


_CLEAN_COLUMNS = ",\n  ".join(
    "name_or_code as search_city" if c == "search_city"
    else "kw as search_kw" if c == "search_kw"
    else f"{samples.TAGS_VALUE} as jobTags" if c == "jobTags"
    else f"{_number('(' + samples.ITEM_VALUES[c] + ')')} as {c}" if c in fixed.SALARY_COLUMNS
    else f"{samples.ITEM_VALUES[c]} as {c}" if c in samples.ITEM_VALUES
    else f"cast(null as varchar) as {c}"
    for c in fixed.LISTING_COLUMNS
)
_LISTINGS = f"""{_ITEMS}, listing as (
  select page_id, pos, {_CLEAN_COLUMNS}
  from (select items.*, coalesce(area.name, city) as name_or_code
        from items left join area on area.code = city) t)"""
_VIEW = f"""{_LISTINGS}, listing_view as (
  select page_id, pos, jobId as job_id, jobName as job_title,
    coalesce(fullCompanyName, companyName) as company_name, companyTypeString as company_type,
    companySizeString as company_size, cast(trunc(jobSalaryMin) as bigint) as salary_min,
    cast(trunc(jobSalaryMax) as bigint) as salary_max, provideSalaryString as salary_range,
    jobAreaCode as location_code, substr(jobAreaCode, 1, 2) || '0000' as province_code,
    case when regexp_matches(jobAreaString, '[·-]')
      then regexp_extract(jobAreaString, '^([^·-]*)[·-](.*)$', 1) else jobAreaString end as city_name,
    case when regexp_matches(jobAreaString, '[·-]')
      then regexp_extract(jobAreaString, '^([^·-]*)[·-](.*)$', 2) end as district,
    jobDescribe as job_describe, workYearString as work_experience,
    degreeString as degree_requirement, try_cast(issueDateString as timestamp) as publish_date,
    try_cast(updateDateTime as timestamp) as update_date, jobHref as job_url,
    companyHref as company_url
  from listing)"""
_STORED = f"""{_VIEW}, stored as (
  select * from (
    select *, row_number() over (partition by job_id
      order by update_date desc nulls last, page_id desc, pos desc) as place
    from listing_view
    where job_id is not null and job_title is not null and company_name is not null
      and location_code is not null) s
  where place = 1)"""
_FOUND = "job_id, page_id, job_title, company_name, location_code, salary_min, salary_max"
_RUN_TASKS = f"""tasks as (
  select run, kw, max_page, unnest(case when list_contains(string_split(cities, ','), '000000')
    then {_ALL_CODES} else string_split(cities, ',') end) as city
  from (select run, cities, max_page, unnest(string_split(kws, ',')) as kw
        from ({_from_tables(samples.RUN_CONFIG)}) c) k)"""
_READ_ALL = """select page_id, run, kw, city, page from (
    select *, min(case when not good then page else 1000 end)
      over (partition by run, kw, city) as first_bad from outcomes) o
  where page < first_bad"""
_LIMITED = f"""select o.* from ({_READ_ALL}) o
  left join (select *, greatest(coalesce(max_page, 10), 1) as last_page from tasks) t
    on t.run = o.run and t.kw = o.kw and t.city = o.city
  where last_page is null or page <= last_page"""
_TAKEN = f"""{_OUTCOMES}, {_RUN_TASKS}, taken as ({_LIMITED})"""
_STAMP = "'%Y-%m-%d %H:%M:%S.%f'"

# --- logs ---------------------------------------------------------------------

_REQ = f"req as ({_from_tables(samples.REQUEST_EVENT)})"
# NULL is a source and no outcome is a failure, written out; rows without order are at the very end.
_RAGGED_REQ = f"""ragged as ({_from_tables(samples.RAGGED_EVENT)}), req as (
  select seq, ts, coalesce(source, -1) as source, coalesce(success, false) as success,
    response_time, error_type, jobs_count from ragged)"""
_PAGE_LOG = f"""{_OUTCOMES}, req as (
  select page_id as seq, timestamp '2024-01-01 00:00:00' + to_minutes(page_id) as ts, run as source,
    good as success, cast(null as double) as response_time,
    case when good then null when kind = 'challenge' then 'anti_spider_suspected'
      when status_code = 200 and kind in ('blank', 'error') then 'unusable_body'
      when status_code = 200 then 'no_valid_items'
      when status_code in (403, 429, 503, 521) then 'blocked_' || status_code
      else 'http_error_' || status_code end as error_type,
    case when good then n_items else 0 end as jobs_count from outcomes)"""
_CHK = f"chk as ({_from_tables(samples.CHECK_EVENT)})"
_TSK = f"tsk as ({_from_tables(samples.TASK_EVENT)})"
_HOURS = """hours as (
  select source, strftime(ts, '%Y-%m-%d %H:00') as hour, count(*) as requests,
    cast(count(*) filter (where success) as bigint) as success,
    cast(coalesce(sum(jobs_count) filter (where success), 0) as bigint) as jobs
  from req group by 1, 2)"""
_RECENT_HOURS = f"""{_HOURS}, recent as (
  select source, hour, requests, success, jobs from (
    select *, row_number() over (partition by source order by hour desc) as place from hours) h
  where place <= 24)"""
_ERRORS = """errs as (
  select source, error_type, count(*) as failures from req
  where not success and error_type <> '' group by 1, 2)"""
_AVG = """timed as (
  select source, response_time, row_number() over (partition by source order by seq desc) as place
  from req where response_time <> 0),
avgs as (
  select s.source, coalesce(m.mean, 0) as avg_response_time
  from (select distinct source from req) s
  left join (select source, avg(response_time) as mean from timed where place <= 100 group by 1) m
    on m.source = s.source)"""
_STREAK = """streak as (
  select r.source, cast(count(*) filter (where not r.success and r.seq > coalesce(l.last_ok, -1)) as bigint)
    as consecutive_failures
  from req r left join (select source, max(seq) as last_ok from req where success group by 1) l
    on l.source = r.source
  group by 1)"""
_SUMMARY = f"""{_REQ}, {_AVG}, {_STREAK}, sums as (
  select source, count(*) as total_requests,
    cast(count(*) filter (where success) as bigint) as successful_requests,
    cast(count(*) filter (where not success) as bigint) as failed_requests,
    cast(count(*) filter (where success and jobs_count = 0) as bigint) as empty_responses,
    cast(coalesce(sum(jobs_count) filter (where success), 0) as bigint) as total_jobs,
    cast(count(*) filter (where not success and (contains(lower(error_type), 'anti_spider')
      or contains(lower(error_type), 'blocked'))) as bigint) as anti_spider_hits,
    max(ts) filter (where success) as last_success_time, min(ts) as first_time
  from req group by 1),
summary as (
  select sums.*, consecutive_failures, avg_response_time,
    cast(successful_requests as double) / total_requests * 100 as success_rate,
    cast(anti_spider_hits as double) / total_requests * 100 as anti_rate,
    coalesce(cast(empty_responses as double) / nullif(successful_requests, 0) * 100, 0) as empty_rate
  from sums join streak on streak.source = sums.source join avgs on avgs.source = sums.source)"""


def _verdict(now: str) -> str:
    return f"""{_SUMMARY}, verdict as (
  select *, case when message = '{fixed.HEALTH_GOOD}' then 'NORMAL' else 'CRITICAL' end as status
  from (select *, case when consecutive_failures > 10 then '{fixed.HEALTH_STREAK}'
      when total_requests > 20 and success_rate < 30 then '{fixed.HEALTH_RATE}'
      when total_requests > 10 and cast(anti_spider_hits as double) / total_requests > 0.5
        then '{fixed.HEALTH_ANTI}'
      when timestamp '{now}' - last_success_time > interval 1 hour then '{fixed.HEALTH_SILENT}'
      else '{fixed.HEALTH_GOOD}' end as message from summary) s)"""


_ADVICE = f"""advice as (
  select source, list_filter([
    case when success_rate < 50 then '{fixed.ADVICE_RATE}' end,
    case when anti_rate > 30 then '{fixed.ADVICE_ANTI}' end,
    case when empty_rate > 50 then '{fixed.ADVICE_EMPTY}' end,
    case when avg_response_time > 10 then '{fixed.ADVICE_SLOW}' end], lambda t: t is not null) as texts
  from summary)"""
_REPORT = f"""with {_verdict('2024-01-31 00:00:00')}, {_ADVICE}, {_RECENT_HOURS}, {_ERRORS}, {_TSK}
select v.source, '2024-01-31T00:00:00' as "timestamp",
  round(date_diff('microsecond', first_time, timestamp '2024-01-31 00:00:00') / 1e6 / 3600, 6)
    as runtime_hours,
  status as health_status, message as health_message, total_requests,
  round_even(success_rate, 2) as success_rate, total_jobs as total_jobs_crawled,
  cast(coalesce(cities_completed, 0) as bigint) as cities_completed,
  cast(coalesce(cities_failed, 0) as bigint) as cities_failed,
  consecutive_failures, anti_spider_hits, round_even(avg_response_time, 2) as avg_response_time,
  strftime(last_success_time, '%Y-%m-%dT%H:%M:%S.%f') as last_success_time,
  coalesce(e.text, '') as error_breakdown, array_to_string(texts, ';') as recommendations,
  h.text as recent_hourly_stats
from verdict v join advice a on a.source = v.source
left join (select source, string_agg(error_type || '=' || failures, ';' order by error_type) as text
  from errs group by 1) e on e.source = v.source
left join (select source, string_agg(hour || '/' || requests || '/' || success || '/' || jobs, ';'
  order by hour) as text from recent group by 1) h on h.source = v.source
left join (select source, count(*) filter (where success) as cities_completed,
  count(*) filter (where not success) as cities_failed from tsk group by 1) t on t.source = v.source"""

_ISLANDS = f"""{_CHK}, numbered as (
  select *, count(*) filter (where ok) over (partition by source order by seq) as island from chk),
placed as (
  select *, row_number() over (partition by source, island order by seq) as streak
  from numbered where not ok),
runs as (
  select a.source, cast(count(p.seq) filter (where p.island = a.last_island) as bigint) as current_streak,
    cast(coalesce(max(p.streak), 0) as bigint) as max_streak
  from (select source, max(island) as last_island from numbered group by 1) a
  left join placed p on p.source = a.source group by 1)"""
_LAST_ERRORS = f"""last_err as (
  select source, seq, ts, error, row_number() over (partition by source order by seq desc) as place
  from chk where not ok qualify place <= 50)"""
_PATTERN = """case when contains(lower(error), 'timeout') then 'timeout'
    when contains(lower(error), 'connection') then 'connection'
    when contains(lower(error), 'operational') then 'operational' end"""
_PATTERNS = f"""patterns as (
  select source, {_PATTERN} as pattern, count(*) as errors, min(seq) as first_seq
  from last_err where place <= 10 and {_PATTERN} is not null group by 1, 2)"""


def _lines(texts: list[str]) -> str:
    return "[" + ", ".join(f"'{t}'" for t in texts) + "]"


_DIAGNOSIS = f"""with {_ISLANDS}, {_LAST_ERRORS}, {_PATTERNS}, rates as (
  select source, cast(count(*) filter (where ok) as double) / count(*) * 100 as rate from chk group by 1),
found as (
  select source, list('  ' || pattern || ': ' || errors || ' 次' order by first_seq) as texts
  from patterns group by 1),
late as (select source, bool_or(coalesce(contains(error, 'timeout'), false)) as has_timeout
  from last_err group by 1),
texts as (
  select r.source, 'diagnosis' as kind, list_concat(list_filter([
      case when current_streak > 0 then '当前连续失败 ' || current_streak || ' 次' end,
      case when rate < 90 then '成功率较低: ' || printf('%.1f', rate) || '%' end,
      case when len(coalesce(found.texts, [])) > 0 then '{fixed.FINDING_PATTERNS}' end],
      lambda t: t is not null), coalesce(found.texts, [])) as lines
  from runs r join rates on rates.source = r.source left join found on found.source = r.source
  union all
  select r.source, 'suggestion', list_concat(
      case when current_streak >= 3 then {_lines(fixed.ADVICE_STREAK)} else [] end,
      case when has_timeout then {_lines(fixed.ADVICE_TIMEOUT)} else [] end)
  from runs r left join late on late.source = r.source)
select source, kind, unnest(range(0, len(lines))) as line_no, unnest(lines) as line from texts"""

_SAVED = """select page_id, jobId, companyName from
  (select *, {values} from items) i {where}"""


def _saved(where: str = "") -> str:
    return f"with {_ITEMS} " + _SAVED.format(values=_values("jobId", "companyName"), where=where)


ORACLES: dict[str, str] = {
    "area_summary": f"""with {_LISTINGS}
select search_city, count(*) as postings, min(jobSalaryMin) as lowest, max(jobSalaryMax) as highest
from listing group by 1""",
    "scan_responses": f"""with {_BODIES}
select page_id, run, kw, city, page, cast(status_code as bigint) as status_code,
  length(body) as body_chars, md5(body) as body_md5 from bodies""",
    "parse_envelope": f"""with {_PAGES}
select page_id, kind not in ('broken', 'trailing') as is_json,
  case kind when 'broken' then null when 'trailing' then null when 'refused' then '"0"' when 'numeric' then '1' else '"1"' end
    as status_json,
  case when kind not in ('broken', 'trailing', 'no_items', 'list_result') then n_items end as n_items
from pages0 where status_code = 200 and kind not in ('challenge', 'blank', 'error')""",
    "explode_items": f"""with {_ITEMS}
select page_id, pos, {_values('jobId', 'jobName', 'companyName', 'jobDescribe', 'jobSalaryMin')}
from items""",
    "sql_scan": f"""with {_STORED}
select location_code, count(*) as postings, min(salary_min) as lowest, max(salary_max) as highest
from stored group by 1""",
    "city_codes": f"""with city_lines as ({_from_tables(samples.CITY_LINES)}),
pairs as (
  select line, unnest(regexp_extract_all(text, '"([0-9]+)":"([^"]*)"', 1)) as code,
    unnest(regexp_extract_all(text, '"([0-9]+)":"([^"]*)"', 2)) as name,
    unnest(range(0, len(regexp_extract_all(text, '"([0-9]+)":"([^"]*)"')))) as pos
  from city_lines)
select name, code from pairs
qualify row_number() over (partition by name order by line, pos) = 1""",
    "classify_response": f"""with {_BODIES}
select case when regexp_matches(body, 'var arg1=''[A-F0-9]+'';') then 'challenge'
    when status_code = 200 and trim(body) <> '' and not contains(lower(body), 'error') then 'ok'
    when status_code = 200 then 'invalid' when status_code in (403, 429, 503, 521) then 'blocked'
    else 'http_error' end as response_class, count(*) as responses
from bodies group by 1""",
    "classify_texts": """with bodies as (
  select 'pages' as origin, html as body from pages
  union all select 'documents', text from documents)
select origin, case when regexp_matches(body, 'var arg1=''[A-F0-9]+'';') then 'challenge'
    when regexp_matches(body, '[^\\s]') and not contains(lower(body), 'error') then 'ok'
    else 'invalid' end as response_class, count(*) as responses
from bodies group by 1, 2""",
    "valid_pages": f"with {_OUTCOMES} select page_id, run, kw, city, page from outcomes where good",
    "page_quality": f"""with {_PAGES}, usable as (
  select * from pages0 where status_code = 200 and kind not in ('challenge', 'blank', 'error')),
counted as (
  select count(*) as pages, count(*) filter (where kind in ('broken', 'trailing')) as not_json,
    count(*) filter (where kind = 'list_result') as wrong_shape,
    count(*) filter (where kind in ('broken', 'trailing', 'refused', 'numeric')) as bad_status,
    count(*) filter (where kind in ('broken', 'trailing', 'no_items', 'list_result') or n_items = 0) as too_few_items
  from usable)
select pages, unnest(['not_json', 'wrong_shape', 'no_status', 'no_resultbody', 'bad_status', 'too_few_items']) as rule,
  unnest([not_json, wrong_shape, not_json, not_json + wrong_shape, bad_status, too_few_items]) as rejected from counted""",
    "page_counts": f"with {_OUTCOMES} select page_id, n_items as jobs_count from outcomes where good",
    "pages_until_bad": f"with {_TAKEN} select * from taken",
    "all_pages_until_bad": f"with {_OUTCOMES} {_READ_ALL}",
    "task_grid": f"""with config as ({_from_tables(samples.SEARCH_CONFIG)}),
k as (select config_id, cities, max_page, unnest(string_split(kws, ',')) as kw from config),
c as (select config_id, kw, max_page, unnest(case when list_contains(string_split(cities, ','), '000000')
    then {_ALL_CODES} else string_split(cities, ',') end) as city from k)
select config_id, kw, city, unnest(range(1, greatest(coalesce(max_page, 10), 1) + 1)) as page from c""",
    "task_completion": f"""with {_TAKEN}
select t.run, t.kw, t.city, count(p.page_id) as pages, count(p.page_id) > 0 as completed
from tasks t left join taken p on p.run = t.run and p.kw = t.kw and p.city = t.city
group by 1, 2, 3""",
    "failed_tasks": f"""with {_TAKEN}
select run, kw, city from tasks t where not exists (
  select 1 from taken p where p.run = t.run and p.kw = t.kw and p.city = t.city)""",
    "listings": f"with {_LISTINGS} select * from listing",
    "decode_area": f"""with {_PAGES}, area as (select * from (values {_AREA_ROWS}) v(code, name))
select page_id, city, coalesce(name, city) as area from pages0 left join area on code = city""",
    "select_expected": f"""with {_ITEMS}
select page_id, pos, {_values('jobId', 'jobName', 'companyName', 'term', 'coId')} from items""",
    "flatten_lists": f"with {_ITEMS} select page_id, pos, {samples.TAGS_VALUE} as jobTags from items",
    "cast_salary": f"""with {_ITEMS}, raw as (
  select page_id, pos, {_values('jobSalaryMin', 'jobSalaryMax')} from items)
select page_id, pos, {_number('jobSalaryMin')} as jobSalaryMin, {_number('jobSalaryMax')} as jobSalaryMax
from raw""",
    "cast_salary_rejects": f"""with {_ITEMS}, raw as (
  select page_id, pos, {_values('jobSalaryMin', 'jobSalaryMax')} from items)
select page_id, pos, 'jobSalaryMin' as column_name, jobSalaryMin as value from raw where {_bad('jobSalaryMin')}
union all
select page_id, pos, 'jobSalaryMax', jobSalaryMax from raw where {_bad('jobSalaryMax')}""",
    "cast_salary_by_page": f"""with {_ITEMS}, raw as (
  select page_id, pos, {_values('jobSalaryMin', 'jobSalaryMax')} from items),
flagged as (
  select *, bool_or({_bad('jobSalaryMin')}) over (partition by page_id) as bad_min,
    bool_or({_bad('jobSalaryMax')}) over (partition by page_id) as bad_max from raw)
select page_id, pos, case when not bad_min then {_number('jobSalaryMin')} end as jobSalaryMin,
  case when bad_min then nullif(jobSalaryMin, '') end as jobSalaryMin_text,
  case when not bad_max then {_number('jobSalaryMax')} end as jobSalaryMax,
  case when bad_max then nullif(jobSalaryMax, '') end as jobSalaryMax_text
from flagged""",
    "page_columns": f"with {_ITEMS} " + " union all ".join(
        f"select page, '{name}' as column_name, count({value}) as items from items group by page having count({value}) > 0"
        for name, value in {**samples.ITEM_VALUES, "jobTags": samples.TAGS_VALUE, "madeUpKey": "1"}.items()
    ),
    "union_pages": f"""with {_ITEMS}, raw as (
  select page, page_id, pos, {_values('jobId', 'jobName', 'companyName', 'term')} from items)
select page_id, pos, jobId, case when page = 1 or page > 5 then jobName end as jobName,
  case when page between 2 and 5 then companyName end as companyName,
  case when page > 5 then term end as term from raw""",
    "listing_view": f"""with {_VIEW}
select * replace (strftime(publish_date, {_STAMP}) as publish_date,
  strftime(update_date, {_STAMP}) as update_date),
  '2024-01-31 00:00:00.000000' as created_at from listing_view""",
    "not_null_rejects": f"""with {_VIEW}, counted as (
  select count(*) filter (where job_id is null) as a, count(*) filter (where job_title is null) as b,
    count(*) filter (where company_name is null) as c, count(*) filter (where location_code is null) as d
  from listing_view)
select unnest(['job_id', 'job_title', 'company_name', 'location_code']) as rule,
  unnest([a, b, c, d]) as rejected from counted""",
    "dedupe_latest": f"""with {_STORED}
select job_id, page_id, pos, job_title, company_name, salary_min,
  strftime(update_date, {_STAMP}) as update_date from stored""",
    "save_append": _saved(),
    "save_replace": _saved("where page > 5"),
    "save_fail_if_exists": _saved("where page <= 5"),
    "upsert_listings": f"with {_STORED} select {_FOUND} from stored",
    "by_company": f"with {_STORED} select {_FOUND} from stored where company_name = 'Company 7 Ltd'",
    "by_location": f"with {_STORED} select {_FOUND} from stored where location_code = '050200'",
    "by_salary_range": f"""with {_STORED}
select {_FOUND} from stored where salary_min >= 1000 and salary_max <= 2500""",
    "by_publish_date": f"""with {_STORED} select {_FOUND} from stored
where publish_date >= timestamp '1998-01-01' and publish_date < timestamp '1998-07-01'""",
    "recent_inserts": f"""with {_STORED} select count(*) as recent_inserts from stored
where update_date > timestamp '1998-08-03 03:30:00' - interval 1 hour""",
    "search_postings": f"""with {_STORED} select {_FOUND} from stored
where contains(lower(job_title), 'python 1') and company_type = 'Public'
order by update_date desc nulls last, job_id limit 20 offset 20""",
    "search_keyword": f"""with {_STORED} select {_FOUND} from stored
where contains(lower(job_title), 'n 5-low 6') order by update_date desc nulls last, job_id limit 20""",
    "search_province": f"""with {_STORED} select {_FOUND} from stored where province_code = '050000'
order by update_date desc nulls last, job_id limit 20""",
    "search_after": f"""with {_STORED} select {_FOUND} from stored
where update_date is null or update_date < timestamp '1998-07-01 00:00:00'
  or (update_date = timestamp '1998-07-01 00:00:00' and job_id > 'J')
order by update_date desc nulls last, job_id limit 15""",
    "search_listings": f"""with {_ITEMS}, raw as (
  select page_id, pos, {_values('jobId', 'jobName', 'jobType', 'industryType1', 'updateDateTime')}
  from items),
newest as (
  select * from raw where jobId is not null qualify row_number() over (partition by jobId
    order by try_cast(updateDateTime as timestamp) desc nulls last, page_id desc, pos desc) = 1)
select page_id, jobId, jobName, updateDateTime from newest
where contains(lower(jobName), 'data') and jobType = '1' and industryType1 = '3'
order by try_cast(updateDateTime as timestamp) desc nulls last, jobId limit 20""",
    "sql_named": f"""with {_STORED} select company_name, count(*) as postings from stored
where salary_min > 2000 and degree_requirement = 'Master' group by 1""",
    "sql_positional": f"""with {_STORED} select job_id, salary_min from stored
where salary_min >= 3000 and company_type = 'Private'""",
    "table_profile": "\nunion all ".join(
        f"select 'given_{name}' as table_name, true as table_exists, count(*) as row_count from {name}"
        for name in TABLES
    ) + "\nunion all select 'given_nowhere', false, 0",
    "request_totals": f"""with {_SUMMARY} select source, total_requests, successful_requests,
  failed_requests, empty_responses, total_jobs, anti_spider_hits from sums""",
    "log_balance": f"""with ragged as ({_from_tables(samples.RAGGED_EVENT)})
select source, count(*) as total_requests, cast(count(*) filter (where success) as bigint) as successful_requests,
  cast(count(*) filter (where success is not true) as bigint) as failed_requests,
  cast(count(*) filter (where seq is null) as bigint) as without_order from ragged group by 1""",
    "ragged_verdict": f"""with {_verdict('2024-01-31 00:00:00').replace(_REQ, _RAGGED_REQ)}
select nullif(source, -1) as source, total_requests, failed_requests, consecutive_failures,
  message as health_message from verdict""",
    "page_request_totals": f"""with {_PAGE_LOG}
select source, count(*) as total_requests, cast(count(*) filter (where success) as bigint) as successful_requests,
  cast(count(*) filter (where not success) as bigint) as failed_requests, 0 as empty_responses,
  cast(coalesce(sum(jobs_count), 0) as bigint) as total_jobs,
  cast(count(*) filter (where contains(error_type, 'anti_spider') or contains(error_type, 'blocked')) as bigint)
    as anti_spider_hits
from req group by 1""",
    "page_report": f"""with {_verdict('2024-06-01 00:00:00').replace(_REQ, _PAGE_LOG)}, {_RUN_TASKS}, taken as ({_LIMITED}),
done as (
  select t.run, count(*) filter (where p.run is not null) as completed, count(*) filter (where p.run is null) as failed
  from tasks t left join (select distinct run, kw, city from taken) p
    on p.run = t.run and p.kw = t.kw and p.city = t.city group by 1),
{_ERRORS}, {_HOURS}
select v.source, message as health_message, total_requests, total_jobs as total_jobs_crawled,
  cast(coalesce(completed, 0) as bigint) as cities_completed, cast(coalesce(failed, 0) as bigint) as cities_failed,
  consecutive_failures, coalesce(e.text, '') as errors, least(h.n, 24) as hours
from verdict v left join done on done.run = v.source
left join (select source, string_agg(error_type || '=' || failures, ';' order by error_type) as text
  from errs group by 1) e on e.source = v.source
left join (select source, count(*) as n from hours group by 1) h on h.source = v.source""",
    "success_rate": f"with {_SUMMARY} select source, success_rate from summary",
    "error_breakdown": f"with {_REQ}, {_ERRORS} select * from errs",
    "hourly_stats": f"with {_REQ}, {_HOURS} select * from hours",
    "last_success": f"""with {_SUMMARY}
select source, strftime(last_success_time, {_STAMP}) as last_success_time from sums""",
    "consecutive_failures": f"with {_REQ}, {_STREAK} select * from streak",
    "avg_last100": f"""with {_REQ}, {_AVG}
select source, round(avg_response_time, 6) as avg_response_time from avgs""",
    "recent_hours": f"with {_REQ}, {_RECENT_HOURS} select * from recent",
    "health_verdict": f"""with {_verdict('2024-01-31 00:00:00')}
select source, status as health_status, message as health_message from verdict""",
    "health_verdict_later": f"""with {_verdict('2024-02-01 00:00:00')}
select source, status as health_status, message as health_message from verdict""",
    "recommendations": f"""with {_SUMMARY}, {_ADVICE}
select source, unnest(range(0, len(texts))) as place, unnest(texts) as recommendation from advice""",
    "report_struct": _REPORT,
    "report_json": _REPORT,
    "report_checkpoints": f"""with {_TSK}, counted as (
  select source, seq, row_number() over w as n, count(*) filter (where success) over w as cities_completed
  from tsk window w as (partition by source order by seq rows unbounded preceding))
select source, seq, cities_completed, n - cities_completed as cities_failed from counted where n % 5 = 0""",
    "check_totals": f"""with {_CHK} select source, count(*) as total_checks,
  count(*) filter (where ok) as successful_checks, count(*) filter (where not ok) as failed_checks,
  strftime(max(ts), {_STAMP}) as last_check_time,
  strftime(max(ts) filter (where ok), {_STAMP}) as last_success_time,
  strftime(max(ts) filter (where not ok), {_STAMP}) as last_failure_time,
  cast(count(*) filter (where ok) as double) / count(*) * 100 as success_rate from chk group by 1""",
    "failure_runs": f"with {_ISLANDS} select * from runs",
    "streak_alerts": f"with {_ISLANDS} select source, seq, streak from placed where streak >= 3",
    "last_errors": f"""with {_CHK}, {_LAST_ERRORS}
select source, seq, strftime(ts, {_STAMP}) as ts, error, place from last_err""",
    "error_patterns": f"with {_CHK}, {_LAST_ERRORS}, {_PATTERNS} select * from patterns",
    "diagnosis": _DIAGNOSIS,
    "slow_checks": f"""with {_CHK} select source, seq, response_time from chk
where ok and response_time > 5.0""",
    "check_report": f"""with {_ISLANDS}, {_LAST_ERRORS}, sums as (
  select source, count(*) as total_checks,
    cast(count(*) filter (where ok) as double) / count(*) * 100 as success_rate from chk group by 1),
shown as (
  select source, string_agg(seq || ':' || error, ';' order by seq) as last_errors
  from last_err where place <= 5 group by 1)
select s.source, total_checks, success_rate, current_streak, max_streak,
  coalesce(last_errors, '') as last_errors
from sums s join runs on runs.source = s.source left join shown on shown.source = s.source""",
    "check_details": f"""with {_STORED} select true as table_exists, count(*) as table_row_count,
  count(*) filter (where update_date > timestamp '1998-08-03 03:30:00' - interval 1 hour) as recent_inserts,
  cast(null as varchar) as check_error
from stored""",
    "stream_ingest": f"with {_LISTINGS} select * from listing",
    "stream_hourly": f"with {_REQ}, {_HOURS} select * from hours",
    "stream_closed_hours": f"""with {_REQ}, {_HOURS} select * from hours
where hour < (select strftime(max(ts) - interval 10 minute, '%Y-%m-%d %H:00') from req)""",
    "stream_silence": f"""with {_REQ}, last as (
  select source, max(ts) filter (where success) as newest, (epoch_us(max(ts) filter (where success)) + 999) // 1000 as ms
  from req group by source)
select source, strftime(newest, {_STAMP}) as last_success,
  strftime(make_timestamp(ms * 1000 + 3600000000), {_STAMP}) as silent_at
from last where ms + 3600000 <= (select epoch_ms(max(ts)) - 600000 from req)""",
    "stream_streaks": f"with {_ISLANDS} select *, 0 as overtaken from runs",
    "stream_alerts": f"with {_ISLANDS} select source, seq, streak from placed where streak >= 3",
    "stream_dedupe": f"""with {_ITEMS}, ids as (select page_id, {_values('jobId')} from items)
select jobId, page_id from ids where jobId is not null
qualify row_number() over (partition by jobId
  order by case page_id % 3 when 2 then 0 when 0 then 1 else 2 end, page_id) = 1""",
}

# What a stream has folded is what the batch form gives on all that has landed.
ORACLES["stream_pages"] = ORACLES["pages_until_bad"]
ORACLES["stream_completion"] = ORACLES["task_completion"]
