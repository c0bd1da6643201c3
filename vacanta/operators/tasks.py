"""Search tasks: the grid, the pages a task may use, and task completion."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacanta.fixed_values import ALL_AREAS, AREAS, DEFAULT_MAX_PAGE

CHUNK_PAGES = 4096


def task_cities(configs: DataFrame) -> DataFrame:
    """``(…, kw, city)`` for each configuration row ``(…, kws, cities)``.

    Lists are comma text, taken without trimming. The wildcard anywhere in the
    area list replaces the list by all areas. Each configuration multiplies its
    own short lists, so nothing is joined or shuffled.
    """
    kept = [c for c in configs.columns if c not in ("kws", "cities")]
    cities = F.split("cities", ",")
    all_areas = F.array(*[F.lit(code) for code in AREAS])
    return configs.select(
        *kept,
        F.explode(F.split("kws", ",")).alias("kw"),
        F.when(F.array_contains(cities, ALL_AREAS), all_areas).otherwise(cities).alias("cities"),
    ).select(*kept, "kw", F.explode("cities").alias("city"))


def task_grid(configs: DataFrame) -> DataFrame:
    """keyword x area x page 1 ... ``max_page`` (10 where NULL).

    The first page is always asked for, so ``max_page`` below 1 acts as 1.
    """
    kept = [c for c in configs.columns if c not in ("kws", "cities", "max_page")]
    last = F.greatest(F.coalesce("max_page", F.lit(DEFAULT_MAX_PAGE)), F.lit(1))
    return task_cities(configs).select(
        *kept, "kw", "city", F.explode(F.sequence(F.lit(1).cast("bigint"), last)).alias("page")
    )


def within_limits(pages: DataFrame, task_keys: list[str], limits: DataFrame | None) -> DataFrame:
    """Pages that their task asks for; all of them where it names no limit."""
    if limits is None:
        return pages
    last = F.greatest(F.coalesce("max_page", F.lit(DEFAULT_MAX_PAGE)), F.lit(1))
    named = limits.groupBy(*task_keys).agg(F.max(last).alias("last_page"))
    return pages.join(named, task_keys, "left").where("last_page is null or page <= last_page")


def pages_until_bad(
    outcomes: DataFrame, task_keys: list[str], limits: DataFrame | None = None
) -> DataFrame:
    """Pages a sequential reader would have taken: good and with no gap before.

    ``outcomes`` has the task keys, ``page`` and ``good``. ``limits`` (task keys
    and ``max_page``, 10 where NULL) says how far a task reads; without it, or
    for a task it does not name, every landed page counts. Copies of a page are
    merged first (good if any copy is), on the map side. A task's pages are cut
    into chunks of ``CHUNK_PAGES``: windows see one chunk, and one row per chunk
    says whether all chunks before it are whole.
    """
    pages = within_limits(outcomes.where("page >= 1"), task_keys, limits)
    chunk = F.call_function("div", F.col("page") - 1, F.lit(CHUNK_PAGES))
    merged = (
        pages.groupBy(*task_keys, chunk.alias("chunk"), "page")
        .agg(
            F.bool_or("good").alias("good"),
            F.min(F.when(F.col("good"), F.col("page_id"))).alias("page_id"),
        )
        .where("good")
    )
    # Sorted pages that lie at their own place have no gap before them.
    begin = F.col("chunk") * CHUNK_PAGES + 1
    listed = F.sort_array(F.collect_list(F.struct("page", "page_id")))
    chunks = merged.groupBy(*task_keys, "chunk").agg(listed.alias("pages"))
    chunks = chunks.withColumn("pages", F.filter("pages", lambda p, i: p["page"] == begin + i))
    by_chunk = W.partitionBy(*task_keys).orderBy("chunk")
    before_whole = F.coalesce(F.lag(F.size("pages")).over(by_chunk) == CHUNK_PAGES, F.lit(False))
    follows = (F.col("chunk") == 0) | (before_whole & (F.lag("chunk").over(by_chunk) == F.col("chunk") - 1))
    reached = chunks.withColumn("follows", follows).withColumn(
        "reached", F.min("follows").over(by_chunk.rowsBetween(W.unboundedPreceding, 0))
    )
    taken = reached.where("reached").select(*task_keys, F.inline("pages"))
    return taken.select("page_id", *task_keys, "page")


def task_completion(tasks: DataFrame, taken: DataFrame, task_keys: list[str]) -> DataFrame:
    """Each task with the number of pages taken; completed if there is any."""
    counts = taken.groupBy(*task_keys).agg(F.count("*").alias("pages"))
    return tasks.join(counts, task_keys, "left").select(
        *task_keys,
        F.coalesce("pages", F.lit(0)).alias("pages"),
        F.col("pages").isNotNull().alias("completed"),
    )


def failed_tasks(tasks: DataFrame, taken: DataFrame, task_keys: list[str]) -> DataFrame:
    """Tasks that took no page at all."""
    return tasks.join(taken.select(*task_keys).distinct(), task_keys, "left_anti")
