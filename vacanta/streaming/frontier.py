"""How far each search task has come, as its pages land.

A task has come to page n when pages 1 ... n are good. Pages land in any order
and more than once, so per task the spans of good pages are kept: the one that
begins at page 1 ends at the task's frontier, the others wait for what is
missing before them. Spans that touch or overlap are one.

Pages, spans and frontiers lie in levelled tables by task. A batch opens the
folders of the tasks it brings pages of, joins its spans with theirs, and adds
the frontiers that follow. A frontier never moves back.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.operators.envelope import page_outcomes
from vacanta.operators.tasks import CHUNK_PAGES, within_limits
from vacanta.streaming.batches import batch_path, drop_batch, run_batches
from vacanta.streaming.levels import LevelledTable


def page_spans(pages: DataFrame, task_keys: list[str]) -> DataFrame:
    """Spans ``first_page, last_page`` of distinct pages, cut at multiples of ``CHUNK_PAGES``.

    Neighbours have the same difference of page and place. Windows see a chunk.
    """
    chunk = F.call_function("div", F.col("page") - 1, F.lit(CHUNK_PAGES))
    place = F.row_number().over(W.partitionBy(*task_keys, "chunk").orderBy("page"))
    return (
        pages.withColumn("chunk", chunk)
        .withColumn("island", F.col("page") - place)
        .groupBy(*task_keys, "chunk", "island")
        .agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))
        .select(*task_keys, "first_page", "last_page")
    )


def merge_spans(spans: DataFrame, task_keys: list[str]) -> DataFrame:
    """Spans that touch or overlap as one; windows see a task's spans, not its pages."""
    by_task = W.partitionBy(*task_keys).orderBy("first_page", "last_page")
    reached = F.max("last_page").over(by_task.rowsBetween(W.unboundedPreceding, -1))
    begins = F.coalesce(F.col("first_page") > F.col("reached") + 1, F.lit(True))
    island = F.sum(F.col("begins").cast("bigint")).over(by_task.rowsBetween(W.unboundedPreceding, 0))
    return (
        spans.withColumn("reached", reached)
        .withColumn("begins", begins)
        .withColumn("island", island)
        .groupBy(*task_keys, "island")
        .agg(F.min("first_page").alias("first_page"), F.max("last_page").alias("last_page"))
        .drop("island")
    )


def _join_by_task(left: DataFrame, right: DataFrame, task_keys: list[str], how: str) -> DataFrame:
    """Join on the task, where NULL equals NULL."""
    named = right.withColumnsRenamed({k: f"_{k}" for k in task_keys})
    same = [left[k].eqNullSafe(named[f"_{k}"]) for k in task_keys]
    joined = left.join(named, same, how)
    return joined.drop(*[f"_{k}" for k in task_keys])


class TaskPages:
    """Good pages, spans and frontiers of tasks below ``path``."""

    def __init__(self, outcomes: DataFrame, task_keys: list[str], path: str, limits: DataFrame | None = None, **sizes: int):
        spark = outcomes.sparkSession
        self.spark, self.path, self.task_keys, self.limits = spark, path, task_keys, limits
        tasks = list(outcomes.select(*task_keys).schema)

        def table(name: str, columns: list[str], merge) -> LevelledTable:
            schema = T.StructType([*tasks, *(T.StructField(c, T.LongType()) for c in columns)])
            return LevelledTable(spark, f"{path}/{name}", schema, task_keys, merge, **sizes)

        self.pages = table("pages", ["page", "page_id"], self._least)
        self.spans = table("spans", ["first_page", "last_page"], lambda s: merge_spans(s, task_keys))
        self.frontiers = table("frontiers", ["frontier"], self._furthest)

    def _least(self, pages: DataFrame) -> DataFrame:
        return pages.groupBy(*self.task_keys, "page").agg(F.min("page_id").alias("page_id"))

    def _furthest(self, frontiers: DataFrame) -> DataFrame:
        return frontiers.groupBy(*self.task_keys).agg(F.max("frontier").alias("frontier"))

    def add(self, outcomes: DataFrame, batch_id: int) -> None:
        """Fold the outcomes of a batch of pages; a batch may be folded again."""
        good = within_limits(outcomes.where("good and page >= 1"), self.task_keys, self.limits)
        staged = batch_path(f"{self.path}/arrived", batch_id)
        names = [f.name for f in self.pages.schema]
        self._least(good).select(*names).write.mode("overwrite").parquet(staged)  # bodies are parsed once
        came = self.spark.read.schema(self.pages.schema).parquet(staged)
        self.pages.add(came, batch_id)
        new = page_spans(came.select(*self.task_keys, "page"), self.task_keys)
        runs = self.spans.runs(before=batch_id)
        known = self.spans.read(runs, self.spans.touched(came, runs))
        touched = came.select(*self.task_keys).distinct()
        theirs = _join_by_task(known, touched, self.task_keys, "left_semi").unionByName(new)
        self.spans.add(new, batch_id)
        begun = merge_spans(theirs, self.task_keys).where("first_page = 1")
        self.frontiers.add(begun.select(*self.task_keys, F.col("last_page").alias("frontier")), batch_id)
        drop_batch(self.spark, f"{self.path}/arrived", batch_id)

    def frontier(self) -> DataFrame:
        """Per task with a first page: the last page before a gap."""
        return self._furthest(self.frontiers.read())

    def taken(self) -> DataFrame:
        """The pages up to each task's frontier: ``page_id``, the task and ``page``."""
        pages = self._least(self.pages.read())
        reached = _join_by_task(pages, self.frontier(), self.task_keys, "inner").where("page <= frontier")
        return reached.select("page_id", *self.task_keys, "page")

    def completion(self, tasks: DataFrame) -> DataFrame:
        """Each asked task with its number of pages so far; completed if there is any."""
        known = _join_by_task(tasks.select(*self.task_keys), self.frontier(), self.task_keys, "left")
        return known.select(
            *self.task_keys,
            F.coalesce("frontier", F.lit(0)).alias("pages"),
            F.col("frontier").isNotNull().alias("completed"),
        )


def follow_tasks(
    responses: DataFrame, task_keys: list[str], path: str, checkpoint: str, limits: DataFrame | None = None,
    trigger: dict | None = None,
) -> TaskPages:
    """Fold every landed page; ``limits`` are those of ``pages_until_bad``."""
    outcomes = page_outcomes(responses).select("page_id", *task_keys, "page", "good")
    state = TaskPages(outcomes, task_keys, path, limits)
    run_batches(outcomes, checkpoint, state.add, trigger)
    return state
