"""Chunked operators against plain Python on random logs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from vacanta.operators import ordered


def random_log(seed, n=400):
    """Half of the rows belong to source 0; numbers have gaps."""
    rng = random.Random(seed)
    seqs = sorted(rng.sample(range(n * 3), n))
    return [
        (rng.choice([0, 0, 0, 1, 2, 3]), seq, rng.random() < rng.choice([0.05, 0.5, 0.95]))
        for seq in seqs
    ]


def by_source(rows):
    ordered_rows = sorted(rows)
    return {s: [(seq, ok) for _, seq, ok in g]
            for s, g in itertools.groupby(ordered_rows, key=lambda r: r[0])}


def runs(history):
    """Lengths of the failure runs, with the last one 0 if the log ends well."""
    lengths = [len(list(g)) for ok, g in itertools.groupby(history, key=lambda h: h[1]) if not ok]
    return (lengths[-1] if lengths and not history[-1][1] else 0), max(lengths, default=0)


def places(history):
    out = {}
    for ok, g in itertools.groupby(history, key=lambda h: h[1]):
        if not ok:
            out.update({seq: i for i, (seq, _) in enumerate(g, 1)})
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "source long, seq long, ok boolean").repartition(5)


@pytest.mark.parametrize("seed,chunk", [(1, 1), (2, 7), (3, 50), (4, 10_000)])
def test_runs_streaks_and_totals(spark, seed, chunk):
    rows = random_log(seed)
    log = frame(spark, rows)
    logs = by_source(rows)

    got = {r["source"]: (r["current_streak"], r["max_streak"])
           for r in ordered.failure_runs(log, "ok", chunk).collect()}
    assert got == {s: runs(h) for s, h in logs.items()}

    got = {(r["source"], r["seq"]): r["streak"]
           for r in ordered.failures_with_streak(log, "ok", chunk).collect()}
    assert got == {(s, seq): n for s, h in logs.items() for seq, n in places(h).items()}

    totals = ordered.running_totals(log, {"good": F.col("ok").cast("long")}, chunk).collect()
    want = {(s, seq): total for s, h in logs.items()
            for (seq, _), total in zip(h, itertools.accumulate(int(ok) for _, ok in h))}
    assert {(r["source"], r["seq"]): r["good"] for r in totals} == want


@pytest.mark.parametrize("cut", [0, 3, 200, 399])
def test_earlier_state_continues_the_runs(spark, cut):
    rows = random_log(9)
    early, late = rows[:cut], rows[cut:]
    state = ordered.failure_runs(frame(spark, early), "ok", 16)
    got = {r["source"]: (r["current_streak"], r["max_streak"])
           for r in ordered.failure_runs(frame(spark, late), "ok", 16, before=state).collect()}
    assert got == {s: runs(h) for s, h in by_source(rows).items()}
    streaks = ordered.failures_with_streak(frame(spark, late), "ok", 16, before=state).collect()
    late_seqs = {(s, seq) for s, seq, _ in late}
    want = {(s, seq): n for s, h in by_source(rows).items() for seq, n in places(h).items()
            if (s, seq) in late_seqs}
    assert {(r["source"], r["seq"]): r["streak"] for r in streaks} == want


def test_last_rows(spark):
    rows = random_log(5)
    got = {(r["source"], r["seq"], r["place"]) for r in ordered.last_rows(frame(spark, rows), 4).collect()}
    want = {(s, seq, i) for s, h in by_source(rows).items()
            for i, (seq, _) in enumerate(reversed(h[-4:]), 1)}
    assert got == want


def test_no_window_group_exceeds_a_chunk(spark):
    log = spark.range(100_000).select(
        F.lit(1).cast("long").alias("source"), F.col("id").alias("seq"), (F.col("id") % 3 == 0).alias("ok")
    )
    sizes = ordered.with_chunk(log, 1000).groupBy("source", "chunk").count()
    assert sizes.agg(F.max("count")).first()[0] == 1000
    got = ordered.failure_runs(log, "ok", 1000).first()
    assert (got["current_streak"], got["max_streak"]) == (0, 2)


@pytest.mark.parametrize("step", [1, 1_000_003, 3_600_000_000])
def test_numbers_far_apart_and_rows_without_source(spark, monkeypatch, step):
    monkeypatch.setattr(ordered, "FAN", 5)
    rows = [(None if s == 3 else s, seq * step, ok) for s, seq, ok in random_log(11)]
    log = frame(spark, rows)
    logs = {}
    for s, seq, ok in sorted(rows, key=lambda r: r[1]):
        logs.setdefault(s, []).append((seq, ok))
    got = {r["source"]: (r["current_streak"], r["max_streak"]) for r in ordered.failure_runs(log, "ok", 7).collect()}
    assert got == {s: runs(h) for s, h in logs.items()}
    got = {(r["source"], r["seq"]): r["streak"] for r in ordered.failures_with_streak(log, "ok", 7).collect()}
    assert got == {(s, seq): n for s, h in logs.items() for seq, n in places(h).items()}
    totals = ordered.running_totals(log, {"good": F.col("ok").cast("long"), "one": F.lit(1)}, 7).collect()
    want = {(s, seq): (n, i) for s, h in logs.items()
            for i, ((seq, _), n) in enumerate(zip(h, itertools.accumulate(int(ok) for _, ok in h)), 1)}
    assert {(r["source"], r["seq"]): (r["good"], r["one"]) for r in totals} == want


def test_no_window_grows_with_a_sparse_log(spark):
    """One source, a row a second, numbered in microseconds: every chunk has few rows."""
    log = spark.range(40_000).select(
        F.lit(1).cast("long").alias("source"),
        (F.lit(1_700_000_000_000_000) + F.col("id") * 1_000_000).alias("seq"),
        (F.col("id") % 5 == 0).alias("ok"),
    )
    chunks = ordered.with_chunk(log).select("chunk").distinct()
    groups = chunks.groupBy(F.call_function("div", F.col("chunk"), F.lit(ordered.FAN)).alias("up")).count()
    assert groups.agg(F.max("count")).first()[0] <= ordered.FAN
    # Any 64-bit number: as many groups of groups as a window takes at most.
    assert (1 << 63) // (ordered.CHUNK_ROWS * ordered.FAN**ordered.LEVELS) <= 1024
    got = ordered.failure_runs(log, "ok").first()
    assert (got["current_streak"], got["max_streak"]) == (4, 4)


def test_rows_without_order_or_outcome(spark):
    rows = [(1, 1, True), (1, 2, None), (1, None, False), (None, 5, False), (None, None, True), (None, None, None)]
    log = frame(spark, rows)
    got = {r["source"]: (r["current_streak"], r["max_streak"]) for r in ordered.failure_runs(log, "ok").collect()}
    assert got == {1: (1, 1), None: (1, 1)}
    assert {r["source"]: r["rows"] for r in ordered.rows_without_order(log).collect()} == {1: 1, None: 2}


@pytest.mark.parametrize("fold,levels", [(2, 3), (5, 2), (1 << 17, 2)])
def test_runs_and_totals_from_one_fold(spark, monkeypatch, fold, levels):
    monkeypatch.setattr(ordered, "FOLD", fold)
    monkeypatch.setattr(ordered, "FOLD_LEVELS", levels)
    rows = [(None if s == 3 else s, None if i % 17 == 0 else seq - 300, None if i % 13 == 0 else ok)
            for i, (s, seq, ok) in enumerate(random_log(21))] + [(77, None, True), (77, None, False)]
    totals = {"rows": F.count("*"), "good": F.count_if("ok"), "first": F.min("seq")}
    merges = {"rows": F.sum("rows"), "good": F.sum("good"), "first": F.min("first")}
    got = ordered.runs_and_totals(frame(spark, rows), "ok", totals, merges, 7).collect()
    want = {}
    for source in {r[0] for r in rows}:
        mine = [(seq, bool(ok)) for s, seq, ok in rows if s == source]
        history = sorted(h for h in mine if h[0] is not None)
        want[source] = (len(mine), sum(ok for _, ok in mine), min((h[0] for h in history), default=None), *runs(history))
    assert {r["source"]: tuple(r)[1:] for r in got} == want


@pytest.mark.parametrize("limit", [1, 2, 3, 9])
def test_streaks_from_a_length_on(spark, limit):
    rows = random_log(31)
    got = ordered.failures_with_streak(frame(spark, rows), "ok", 16, at_least=limit).collect()
    want = {(s, seq, n) for s, h in by_source(rows).items() for seq, n in places(h).items() if n >= limit}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
