"""Request and task logs derived from what landed.

A landed page is one request, and a task of the grid is one task event, so the
statistics of ``requests`` run on landed pages as on recorded logs. The source
is the run. ``at`` gives a page's moment (NULL where none is known).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import ANTI_SPIDER
from vacanta.operators.envelope import page_outcomes, response_class
from vacanta.operators.ordered import join_by_source, rows_without_order
from vacanta.operators.requests import request_totals
from vacanta.schemas import TASK_KEYS


def page_facts(responses: DataFrame) -> DataFrame:
    """What every landed page comes to, without its body: the page's columns, ``good``,
    ``jobs_count`` and ``error_type``.

    A page that passes is a success with its number of items. The others fail,
    and the error type names the class of the response and its status, or
    ``no_valid_items`` for a usable body that is no good page.
    """
    kind = response_class()
    status = F.col("status_code").cast("string")
    error = (
        F.when(kind == "challenge", F.lit(ANTI_SPIDER))
        .when(kind == "ok", F.lit("no_valid_items"))
        .when(kind == "invalid", F.lit("unusable_body"))
        .otherwise(F.concat(kind, F.lit("_"), status))
    )
    outcome = page_outcomes(responses.withColumn("error_type", error))
    return outcome.withColumns(
        {
            "error_type": F.when(~F.col("good"), F.col("error_type")),
            "jobs_count": F.when(F.col("good"), F.col("jobs_count")).otherwise(0).cast("bigint"),
        }
    )


def save_page_facts(responses: DataFrame, path: str) -> DataFrame:
    """The facts, stored: what several reports look at, while bodies are parsed once."""
    facts = page_facts(responses)
    facts.write.mode("errorifexists").parquet(path)
    return facts.sparkSession.read.schema(facts.schema).parquet(path)


def events_of_facts(facts: DataFrame, at: Column | None = None) -> DataFrame:
    """One event per page; ``page_id`` is the call order."""
    moment = F.lit(None).cast("timestamp_ntz") if at is None else at
    return facts.select(
        F.col("page_id").alias("seq"),
        moment.alias("ts"),
        F.col("run").alias("source"),
        F.col("good").alias("success"),
        F.lit(None).cast("double").alias("response_time"),
        "error_type",
        "jobs_count",
    )


def request_events(responses: DataFrame, at: Column | None = None) -> DataFrame:
    """One event per landed page, straight from the bodies."""
    return events_of_facts(page_facts(responses), at)


def task_events(asked: DataFrame, taken: DataFrame, landed: DataFrame) -> DataFrame:
    """One event per asked task: did it take any page?

    Its place in the order is its last landed page; tasks of which nothing
    landed have none.
    """
    last = landed.groupBy(*TASK_KEYS).agg(F.max("page_id").alias("seq"))
    pages = taken.groupBy(*TASK_KEYS).agg(F.count("*").alias("pages"))
    whole = asked.select(*TASK_KEYS).join(last, TASK_KEYS, "left").join(pages, TASK_KEYS, "left")
    return whole.select(
        "seq",
        F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.col("run").alias("source"),
        "kw",
        "city",
        F.col("pages").isNotNull().alias("success"),
    )


def log_balance(log: DataFrame) -> DataFrame:
    """Per source: rows counted, and rows that no order-dependent result can see."""
    totals = request_totals(log).select(
        "source", "total_requests", "successful_requests", "failed_requests"
    )
    unordered = rows_without_order(log).withColumnRenamed("rows", "without_order")
    return join_by_source(totals, unordered, "left").withColumn(
        "without_order", F.coalesce("without_order", F.lit(0))
    )
