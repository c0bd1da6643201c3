"""Tasks followed over batches of pages, against the batch operators on all that landed."""

import random

import pytest
from pyspark.sql import functions as F

from vacanta.operators import tasks
from vacanta.streaming import frontier

KEYS = ["kw", "city"]
OUTCOMES = "page_id long, kw string, city string, page long, good boolean"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def check(state, landed, asked, limits=None):
    taken = tasks.pages_until_bad(landed, KEYS, limits)
    assert rows_of(state.taken(), "page_id", *KEYS, "page") == rows_of(taken, "page_id", *KEYS, "page")
    if asked is not None:
        done = tasks.task_completion(asked, taken, KEYS)
        columns = [*KEYS, "pages", "completed"]
        assert rows_of(state.completion(asked), *columns) == rows_of(done, *columns)


@pytest.mark.parametrize("seed,limited", [(1, False), (2, True)])
def test_pages_backwards_doubled_and_missing(spark, tmp_path, monkeypatch, seed, limited):
    monkeypatch.setattr(frontier, "CHUNK_PAGES", 4)
    rng = random.Random(seed)
    pages = []
    for kw, city, n in [("a", "x", 30), ("a", "y", 9), ("b", "x", 1), ("b", "y", 17), ("c", "z", 12), ("d", "z", 5)]:
        for page in range(1, n + 1):
            for _ in range(rng.choice([1, 1, 2, 3])):
                pages.append((len(pages), kw, city, page, rng.random() < 0.93))
    pages += [(len(pages) + i, "e", "x", page, True) for i, page in enumerate((0, -1, 2, 3))] + [(9000, "a", "x", None, True)]
    rng.shuffle(pages)
    pages.sort(key=lambda r: -(r[3] or 0) + rng.randrange(12))  # mostly backwards
    asked = spark.createDataFrame([(k, c) for k in "abcdef" for c in "xyz"], "kw string, city string")
    limits = None
    if limited:
        limits = spark.createDataFrame(
            [("a", "x", 12), ("a", "y", None), ("b", "y", 0), ("a", "x", 7)], "kw string, city string, max_page long"
        )
    state = frontier.TaskPages(
        spark.createDataFrame([], OUTCOMES), KEYS, f"{tmp_path}/tasks", limits, fan=3, bucket_rows=20
    )
    size = -(-len(pages) // 7)
    for n in range(7):
        batch = spark.createDataFrame(pages[n * size : (n + 1) * size], OUTCOMES)
        for _ in range(1 + n % 2):  # every other batch is run again
            state.add(batch, n)
        check(state, spark.createDataFrame(pages[: (n + 1) * size], OUTCOMES), asked, limits)
    assert any(r.bits for r in state.pages.runs())
    # A task's spans are few once its gaps are filled.
    most = frontier.merge_spans(state.spans.read(), KEYS).groupBy(*KEYS).count().agg(F.max("count")).first()[0]
    assert most <= 10


def test_tasks_without_a_name_and_batches_without_pages(spark, tmp_path):
    state = frontier.TaskPages(spark.createDataFrame([], OUTCOMES), KEYS, f"{tmp_path}/tasks")
    assert state.taken().count() == state.frontier().count() == 0
    batches = [[(1, None, "x", 2, True)], [], [(2, None, "x", 1, True), (3, None, None, 1, True)], [(0, None, "x", 2, True)]]
    landed = []
    for n, rows in enumerate(batches):
        state.add(spark.createDataFrame(rows, OUTCOMES), n)
        landed += rows
        check(state, spark.createDataFrame(landed, OUTCOMES), None)
    assert rows_of(state.frontier(), *KEYS, "frontier") == [(None, "x", 2), (None, None, 1)]


def test_a_long_task_has_one_span(spark):
    pages = spark.range(1, 20_001).select(F.lit("a").alias("kw"), F.lit("x").alias("city"), F.col("id").alias("page"))
    spans = frontier.page_spans(pages, KEYS)
    assert spans.count() == 5  # chunks of 4096
    assert rows_of(frontier.merge_spans(spans, KEYS), "first_page", "last_page") == [(1, 20_000)]
