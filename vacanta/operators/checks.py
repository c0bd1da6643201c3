"""Statistics and diagnosis over the log of store checks.

A log row is one check: ``seq, ts, source, ok, response_time, error``. A check
whose ``ok`` is NULL has failed; rows without source are a source of their own.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta import fixed_values as fixed
from vacanta.functions.numbers import percent, round_exact
from vacanta.functions.text import contains_ci
from vacanta.operators.ordered import (
    CODE_ROWS,
    failure_runs,
    failures_with_streak,
    join_by_source,
    last_rows,
    runs_and_totals,
    with_known,
)


def _totals() -> dict[str, Column]:
    return {
        "total_checks": F.count("*"),
        "successful_checks": F.count_if("ok"),
        "failed_checks": F.count_if(~F.col("ok")),
        "last_check_time": F.max("ts"),
        "last_success_time": F.max(F.when(F.col("ok"), F.col("ts"))),
        "last_failure_time": F.max(F.when(~F.col("ok"), F.col("ts"))),
    }


def _with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "success_rate", percent(F.col("successful_checks"), F.col("total_checks"))
    )


def check_totals(log: DataFrame) -> DataFrame:
    """Per source: counts, success rate and last check, success and failure."""
    return _with_rate(
        with_known(log, "ok").groupBy("source").agg(*[c.alias(n) for n, c in _totals().items()])
    )


def check_summary(log: DataFrame, chunk_rows: int = CODE_ROWS) -> DataFrame:
    """``check_totals`` with the current and the longest run of failures, from one scan."""
    totals = _totals()
    merges = {n: F.max(n) if n.endswith("_time") else F.sum(n) for n in totals}
    rows = log.select("source", "seq", "ts", "ok")
    return _with_rate(runs_and_totals(rows, "ok", totals, merges, chunk_rows))


def check_runs(log: DataFrame, chunk_rows: int = CODE_ROWS) -> DataFrame:
    """Per source: current and longest run of failed checks."""
    return failure_runs(log, "ok", chunk_rows)


def streak_alerts(
    log: DataFrame, limit: int = fixed.ALERT_STREAK, chunk_rows: int = CODE_ROWS
) -> DataFrame:
    """Every failed check that is at least the ``limit``-th in a row."""
    return failures_with_streak(log, "ok", chunk_rows, at_least=limit)


def last_errors(log: DataFrame, n: int = fixed.ERRORS_KEPT) -> DataFrame:
    """The last ``n`` failures of each source, ``place`` 1 the newest."""
    failed = with_known(log, "ok").where(~F.col("ok"))
    return last_rows(failed.select("source", "seq", "ts", "error"), n)


def _pattern() -> Column:
    """First pattern found in the error text, NULL if none."""
    kind = F.lit(None).cast("string")
    for word in reversed(fixed.ERROR_PATTERNS):
        kind = F.when(contains_ci(F.col("error"), word), word).otherwise(kind)
    return kind


def error_patterns(log: DataFrame, n: int = fixed.ERRORS_ANALYSED) -> DataFrame:
    """Per source: error patterns among its last ``n`` failures."""
    return (
        last_errors(log, n)
        .withColumn("pattern", _pattern())
        .where(F.col("pattern").isNotNull())
        .groupBy("source", "pattern")
        .agg(F.count("*").alias("errors"), F.min("seq").alias("first_seq"))
    )


def diagnosis(log: DataFrame, chunk_rows: int = CODE_ROWS) -> DataFrame:
    """Findings and suggestions per source, one line per row.

    ``kind`` is ``diagnosis`` or ``suggestion``; ``line_no`` orders the lines.
    Patterns are listed in the order they first came up.
    """
    kept = last_errors(log)
    has_timeout = F.contains("error", F.lit(fixed.ADVICE_TIMEOUT_WORD))
    recent = kept.withColumn(
        "pattern", F.when(F.col("place") <= fixed.ERRORS_ANALYSED, _pattern())
    )
    # At most 50 kept rows per source, and one entry per pattern.
    by_pattern = recent.groupBy("source", "pattern").agg(
        F.min("seq").alias("first_seq"),
        F.count("*").alias("errors"),
        F.bool_or(F.coalesce(has_timeout, F.lit(False))).alias("has_timeout"),
    )
    line = F.format_string(fixed.FINDING_PATTERN, "pattern", "errors")
    errors = by_pattern.groupBy("source").agg(
        F.bool_or("has_timeout").alias("has_timeout"),
        F.array_sort(
            F.collect_list(F.when(F.col("pattern").isNotNull(), F.struct("first_seq", line.alias("line"))))
        ).alias("patterns"),
    )
    facts = join_by_source(check_summary(log, chunk_rows), errors, "left")
    streak, rate = F.col("current_streak"), F.col("success_rate")
    rate_text = round_exact(rate, 1).cast("string")
    pattern_lines = F.coalesce(F.col("patterns.line"), F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    findings = F.concat(
        F.array_compact(
            F.array(
                F.when(streak > 0, F.format_string(fixed.FINDING_STREAK, streak)),
                F.when(
                    rate < fixed.FINDING_RATE_LIMIT, F.format_string(fixed.FINDING_RATE, rate_text)
                ),
                F.when(F.size(pattern_lines) > 0, F.lit(fixed.FINDING_PATTERNS)),
            )
        ),
        pattern_lines,
    )
    suggestions = F.concat(
        F.when(
            streak >= fixed.ALERT_STREAK, F.array(*[F.lit(t) for t in fixed.ADVICE_STREAK])
        ).otherwise(none),
        F.when(
            F.col("has_timeout"), F.array(*[F.lit(t) for t in fixed.ADVICE_TIMEOUT])
        ).otherwise(none),
    )
    return facts.select(
        "source",
        F.inline(
            F.array(
                F.struct(F.lit("diagnosis").alias("kind"), findings.alias("lines")),
                F.struct(F.lit("suggestion").alias("kind"), suggestions.alias("lines")),
            )
        ),
    ).select("source", "kind", F.posexplode("lines").alias("line_no", "line"))


def check_report(log: DataFrame, chunk_rows: int = CODE_ROWS) -> DataFrame:
    """One row per source: totals, streaks and its last five errors, oldest first."""
    shown = last_errors(log, fixed.ERRORS_SHOWN).groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct("seq", "ts", "error"))).alias("last_errors")
    )
    return join_by_source(check_summary(log, chunk_rows), shown, "left")


def missing_details(spark: SparkSession, error: str | None = None) -> DataFrame:
    """What a check notes where there is no listing table, or none that can be read."""
    return spark.createDataFrame(
        [(error is not None, 0, 0, error)],
        "table_exists boolean, table_row_count bigint, recent_inserts bigint, check_error string",
    )


def check_details(store: DataFrame, now: Column) -> DataFrame:
    """What a check notes about the listing table: rows, and rows of the last hour."""
    since = now - F.make_dt_interval(hours=F.lit(1))
    return store.agg(
        F.count("*").alias("table_row_count"),
        F.count_if(F.col("update_date") > since).alias("recent_inserts"),
    ).select(
        F.lit(True).alias("table_exists"),
        "table_row_count",
        "recent_inserts",
        F.lit(None).cast("string").alias("check_error"),
    )


def slow_checks(log: DataFrame, seconds: float = fixed.SLOW_CHECK_SECONDS) -> DataFrame:
    """Successful checks that took longer than ``seconds``."""
    return log.where(F.col("ok") & (F.col("response_time") > seconds)).select(
        "source", "seq", "response_time"
    )
