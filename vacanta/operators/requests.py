"""Statistics, verdicts and reports over the request log.

A log row is one recorded request: ``seq, ts, source, success, response_time,
error_type, jobs_count``. ``source`` names the collector; rows without one are
a source of their own. A request whose ``success`` is NULL has failed.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacanta import fixed_values as fixed
from vacanta.functions.numbers import percent, round_exact
from vacanta.functions.text import contains_ci
from vacanta.functions.times import hour_label, hours_between, iso_text
from vacanta.operators.ordered import (
    CHUNK_ROWS,
    join_by_source,
    last_rows,
    running_totals,
    runs_and_totals,
    with_known,
)


def _anti_spider() -> Column:
    hit = F.lit(False)
    for word in fixed.ANTI_SPIDER_WORDS:
        hit = hit | contains_ci(F.col("error_type"), word)
    return ~F.col("success") & hit


def _total_columns() -> dict[str, Column]:
    jobs = F.coalesce("jobs_count", F.lit(0))
    return {
        "total_requests": F.count("*"),
        "successful_requests": F.count_if("success"),
        "failed_requests": F.count_if(~F.col("success")),
        "empty_responses": F.count_if(F.col("success") & (jobs == 0)),
        "total_jobs": F.coalesce(F.sum(F.when(F.col("success"), jobs)), F.lit(0)),
        "anti_spider_hits": F.count_if(_anti_spider()),
        "last_success_time": F.max(F.when(F.col("success"), F.col("ts"))),
    }


def request_totals(log: DataFrame) -> DataFrame:
    """Per source: counts of requests by outcome, jobs and anti-spider hits."""
    return with_known(log, "success").groupBy("source").agg(
        *[c.alias(n) for n, c in _total_columns().items() if n != "last_success_time"]
    )


def success_rate(log: DataFrame) -> DataFrame:
    counts = log.groupBy("source").agg(
        F.count_if("success").alias("successes"), F.count("*").alias("requests")
    )
    return counts.select(
        "source", percent(F.col("successes"), F.col("requests")).alias("success_rate")
    )


def error_breakdown(log: DataFrame) -> DataFrame:
    """Per source and error type: number of failures that name a type."""
    return (
        with_known(log, "success").where(~F.col("success") & (F.col("error_type") != ""))
        .groupBy("source", "error_type")
        .agg(F.count("*").alias("failures"))
    )


def hourly_stats(log: DataFrame) -> DataFrame:
    """Per source and hour: requests, successes and jobs of successes."""
    jobs = F.when(F.col("success"), F.col("jobs_count"))
    # Grouped by the moment and labelled afterwards: one label per group.
    return (
        log.groupBy("source", F.date_trunc("hour", "ts").alias("hour"))
        .agg(
            F.count("*").alias("requests"),
            F.count_if("success").alias("success"),
            F.coalesce(F.sum(jobs), F.lit(0)).alias("jobs"),
        )
        .withColumn("hour", hour_label(F.col("hour")))
    )


def recent_hours(log: DataFrame, n: int = fixed.RECENT_HOURS) -> DataFrame:
    """The last ``n`` hours in which a source had any request."""
    latest = W.partitionBy("source").orderBy(F.col("hour").desc())
    return (
        hourly_stats(log)
        .withColumn("place", F.row_number().over(latest))
        .where(F.col("place") <= n)
        .drop("place")
    )


def last_success(log: DataFrame) -> DataFrame:
    """Per source: time of the last success, NULL if there was none."""
    return log.groupBy("source").agg(
        F.max(F.when(F.col("success"), F.col("ts"))).alias("last_success_time")
    )


def consecutive_failures(log: DataFrame) -> DataFrame:
    """Per source: failures since the last success; 0 where no row has an order."""
    runs = runs_and_totals(log.select("source", "seq", "success"), "success", {}, {})
    return runs.select("source", F.col("current_streak").alias("consecutive_failures"))


def avg_response_time(log: DataFrame, n: int = fixed.RESPONSE_TIMES_KEPT) -> DataFrame:
    """Per source: mean of the last ``n`` response times that are given and not 0;
    0 where there is none."""
    sources = log.select("source").distinct()
    return join_by_source(sources, _mean_of_last(log, n), "left").select(
        "source", F.coalesce("mean", F.lit(0.0)).alias("avg_response_time")
    )


def _mean_of_last(log: DataFrame, n: int = fixed.RESPONSE_TIMES_KEPT) -> DataFrame:
    timed = log.select("source", "seq", "response_time").where("response_time <> 0")
    return last_rows(timed, n).groupBy("source").agg(F.avg("response_time").alias("mean"))


def report_checkpoints(
    task_log: DataFrame, every: int = fixed.REPORT_EVERY_TASKS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Every ``every``-th task of a source, with its counts so far."""
    counted = running_totals(
        with_known(task_log.select("source", "seq", "success"), "success"),
        {
            "cities_completed": F.col("success").cast("bigint"),
            "cities_failed": (~F.col("success")).cast("bigint"),
        },
        chunk_rows,
    )
    tasks = F.col("cities_completed") + F.col("cities_failed")
    return counted.where(tasks % every == 0).select(
        "source", "seq", "cities_completed", "cities_failed"
    )


def task_totals(task_log: DataFrame) -> DataFrame:
    """Per source: tasks completed and failed."""
    return with_known(task_log, "success").groupBy("source").agg(
        F.count_if("success").alias("cities_completed"),
        F.count_if(~F.col("success")).alias("cities_failed"),
    )


def _with_mean(totals: DataFrame, log: DataFrame) -> DataFrame:
    return (
        join_by_source(totals, _mean_of_last(log), "left")
        .withColumn("avg_response_time", F.coalesce("mean", F.lit(0.0)))
        .withColumn(
            "success_rate", percent(F.col("successful_requests"), F.col("total_requests"))
        )
        .drop("mean")
    )


def request_summary(log: DataFrame) -> DataFrame:
    """One row per source with everything verdict and advice look at.

    Totals and streak come from one scan, the last response times from another.
    """
    totals = {**_total_columns(), "first_time": F.min("ts")}
    merges = {n: F.sum(n) for n in totals} | {
        "last_success_time": F.max("last_success_time"), "first_time": F.min("first_time")
    }
    rows = log.select("source", "seq", "ts", "success", "error_type", "jobs_count")
    runs = runs_and_totals(rows, "success", totals, merges)
    return _with_mean(runs.withColumnRenamed("current_streak", "consecutive_failures").drop("max_streak"), log)


def report_parts(log: DataFrame, hours: int = fixed.RECENT_HOURS) -> DataFrame:
    """Per source: totals, ``error_breakdown`` and ``recent_hourly_stats``, from one scan.

    One aggregate with grouping sets counts by source, by source and hour and
    by source and error type, on the map side before its one shuffle. A
    source's maps are gathered from its counted rows.
    """
    failed_type = F.when(~F.col("success") & (F.col("error_type") != ""), F.col("error_type"))
    rows = with_known(log, "success").withColumns(
        {"of_hour": F.date_trunc("hour", "ts"), "of_type": failed_type}
    )
    counted = rows.groupingSets(
        [["source"], ["source", "of_hour"], ["source", "of_type"]], "source", "of_hour", "of_type"
    ).agg(
        *[c.alias(n) for n, c in _total_columns().items()],
        F.min("ts").alias("first_time"),
        F.grouping("of_hour").alias("no_hour"),
        F.grouping("of_type").alias("no_type"),
    )
    whole = (F.col("no_hour") == 1) & (F.col("no_type") == 1)
    by_hour, by_type = F.col("no_hour") == 0, (F.col("no_type") == 0) & F.col("of_type").isNotNull()
    stats = F.struct(
        F.col("total_requests").alias("requests"),
        F.col("successful_requests").alias("success"),
        F.col("total_jobs").alias("jobs"),
    )
    hour = F.struct(hour_label(F.col("of_hour")).alias("hour"), stats.alias("stats"))
    error = F.struct("of_type", F.col("failed_requests").alias("failures"))
    # The last hours of each source go on, cut per task before they meet.
    newest = W.partitionBy("source", "no_hour", "no_type").orderBy(F.col("of_hour").desc_nulls_last())
    kept = counted.withColumn("place", F.row_number().over(newest)).where(~by_hour | (F.col("place") <= hours))
    names = [*_total_columns(), "first_time"]
    return kept.groupBy("source").agg(
        *[F.max(F.when(whole, F.col(n))).alias(n) for n in names],
        F.map_from_entries(F.collect_list(F.when(by_type, error))).alias("error_breakdown"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(by_hour & F.col("of_hour").isNotNull(), hour)))).alias(
            "recent_hourly_stats"
        ),
    )


def _verdict_message(now: Column) -> Column:
    """First rule that holds; a source that never succeeded cannot be silent."""
    total = F.col("total_requests")
    silent_for = F.make_dt_interval(hours=F.lit(fixed.HEALTH_SILENT_HOURS))
    return (
        F.when(F.col("consecutive_failures") > fixed.HEALTH_STREAK_LIMIT, fixed.HEALTH_STREAK)
        .when(
            (total > fixed.HEALTH_RATE_MIN_REQUESTS)
            & (F.col("success_rate") < fixed.HEALTH_RATE_LIMIT),
            fixed.HEALTH_RATE,
        )
        .when(
            (total > fixed.HEALTH_ANTI_MIN_REQUESTS)
            & (F.col("anti_spider_hits") / total > fixed.HEALTH_ANTI_LIMIT),
            fixed.HEALTH_ANTI,
        )
        .when(now - F.col("last_success_time") > silent_for, fixed.HEALTH_SILENT)
        .otherwise(fixed.HEALTH_GOOD)
    )


def with_verdict(summary: DataFrame, now: Column) -> DataFrame:
    return summary.withColumn("health_message", _verdict_message(now)).withColumn(
        "health_status",
        F.when(F.col("health_message") == fixed.HEALTH_GOOD, fixed.NORMAL).otherwise(
            fixed.CRITICAL
        ),
    )


def health_verdict(log: DataFrame, now: Column) -> DataFrame:
    return with_verdict(request_summary(log), now).select(
        "source", "health_status", "health_message"
    )


def _advice() -> Column:
    anti = percent(F.col("anti_spider_hits"), F.col("total_requests"))
    empty = percent(F.col("empty_responses"), F.col("successful_requests"))
    rules = [
        (F.col("success_rate") < fixed.ADVICE_RATE_LIMIT, fixed.ADVICE_RATE),
        (anti > fixed.ADVICE_ANTI_LIMIT, fixed.ADVICE_ANTI),
        (empty > fixed.ADVICE_EMPTY_LIMIT, fixed.ADVICE_EMPTY),
        (F.col("avg_response_time") > fixed.ADVICE_SLOW_LIMIT, fixed.ADVICE_SLOW),
    ]
    return F.array_compact(F.array(*[F.when(rule, F.lit(text)) for rule, text in rules]))


def recommendations(log: DataFrame) -> DataFrame:
    """One row per piece of advice, in order."""
    return request_summary(log).select(
        "source", F.posexplode(_advice()).alias("place", "recommendation")
    )


def report(log: DataFrame, task_log: DataFrame, now: Column) -> DataFrame:
    """The nested report, one document per source.

    The maps hold one entry per distinct error type and at most 24 hours; both
    are counted before they are gathered. The request log is scanned three
    times: for all counts, for the streak, and for the last response times.
    """
    counted = join_by_source(report_parts(log), consecutive_failures(log), "left")
    whole = with_verdict(_with_mean(counted, log), now)
    whole = join_by_source(whole, task_totals(task_log), "left")
    no_errors = F.create_map().cast("map<string,bigint>")
    return whole.select(
        "source",
        iso_text(now).alias("timestamp"),
        hours_between(F.col("first_time"), now).alias("runtime_hours"),
        "health_status",
        "health_message",
        F.struct(
            "total_requests",
            round_exact(F.col("success_rate"), 2).cast("double").alias("success_rate"),
            F.col("total_jobs").alias("total_jobs_crawled"),
            F.coalesce("cities_completed", F.lit(0)).alias("cities_completed"),
            F.coalesce("cities_failed", F.lit(0)).alias("cities_failed"),
            "consecutive_failures",
            "anti_spider_hits",
            round_exact(F.col("avg_response_time"), 2).cast("double").alias("avg_response_time"),
            iso_text(F.col("last_success_time")).alias("last_success_time"),
        ).alias("statistics"),
        F.coalesce("error_breakdown", no_errors).alias("error_breakdown"),
        _advice().alias("recommendations"),
        "recent_hourly_stats",
    )


def save_report(report_rows: DataFrame, path: str) -> None:
    """UTF-8 JSON, one document per line, NULLs written out."""
    report_rows.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
