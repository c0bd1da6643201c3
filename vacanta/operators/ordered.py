"""Order-dependent operators that split one busy source over many tasks.

A log row has ``source`` (NULL is a source like any other) and ``seq``, a whole
number unique in its source that gives the call order; rows without ``seq``
have no place in the order and are left to ``rows_without_order``. ``seq`` is
cut into chunks of ``chunk_rows`` numbers, so a ``(source, chunk)`` group cannot
hold more rows than that, however large the source. Windows run inside the
chunks; one summary row per chunk then carries the state over chunk borders.
Where numbers are far apart (moments as numbers, say) there are as many chunks
as rows, so chunks are grouped the same way, by ``FAN`` of them, and groups
again: no window ever sees more than ``FAN`` rows. All groups depend on ``seq``
alone, so a rerun task and a second scan agree on them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK_ROWS = 1 << 18
FAN = 1 << 18
LEVELS = 2  # 2^18 numbers a chunk, 2^36 a group, 2^54 a group of groups: 1024 of these at most
CODE_ROWS = 1 << 14  # numbers of a chunk whose outcomes are gathered in one array
FOLD, FOLD_LEVELS = 1 << 17, 2  # chunks folded to one: 2^48 numbers, 2^16 of these at most
FIRST = -(1 << 62)  # a chunk before any other


def with_known(log: DataFrame, flag: str) -> DataFrame:
    """An outcome that was not noted is no success."""
    return log.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def join_by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``source``, where NULL equals NULL."""
    renamed = right.withColumnRenamed("source", "_source")
    return left.join(renamed, left["source"].eqNullSafe(renamed["_source"]), how).drop("_source")


def rows_without_order(log: DataFrame) -> DataFrame:
    """Per source: rows that totals count and that have no place in any order."""
    return log.where("seq is null").groupBy("source").agg(F.count("*").alias("rows"))


def _keyed(rows: DataFrame) -> DataFrame:
    """``source`` as a struct, which is never NULL and equals itself in joins."""
    return rows.withColumn("source", F.struct("source"))


def _plain(rows: DataFrame) -> DataFrame:
    return rows.withColumn("source", F.col("source.source"))


def _part(column: str, width: int) -> Column:
    """Number of the part, never NULL.

    A nullable key would let the joins below add a NULL test on one side only;
    without it the log is scanned and shuffled once and the shuffle is used again.
    """
    return F.coalesce(F.call_function("div", F.col(column), F.lit(width)), F.lit(0))


def _so_far():
    """Rows of the chunk up to this one."""
    return W.partitionBy("source", "chunk").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)


def with_chunk(log: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Keyed rows with ``chunk``."""
    return _keyed(log.where("seq is not null")).withColumn("chunk", _part("seq", chunk_rows))


def _with_before(
    nodes: DataFrame, sums: list[str], base: str | None = None, levels: int = LEVELS
) -> DataFrame:
    """Add ``<sum>_before``, the sums of the source's earlier chunks, and with
    ``base`` the greatest (first sum up to there + ``base``) among them."""
    group = ["source", "up"] if levels else ["source"]
    if levels:
        nodes = nodes.withColumn("up", _part("chunk", FAN))
    earlier = W.partitionBy(*group).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    local = nodes.withColumns({f"{s}_before": F.coalesce(F.sum(s).over(earlier), F.lit(0)) for s in sums})
    if base:
        reached = F.col(f"{sums[0]}_before") + F.col(base)
        local = local.withColumn("base_before", F.max(reached).over(earlier))
    if not levels:
        return local
    whole = [F.sum(s).alias(s) for s in sums] + ([F.max(reached).alias(base)] if base else [])
    groups = local.groupBy("source", "up").agg(*whole).withColumnRenamed("up", "chunk")
    above = _with_before(groups, sums, base, levels - 1)
    kept = [*(f"{s}_before" for s in sums), *(["base_before"] if base else [])]
    above = above.select("source", F.col("chunk").alias("up"), *[F.col(c).alias(f"{c}_above") for c in kept])
    joined = local.join(above, ["source", "up"])
    new = {f"{s}_before": F.col(f"{s}_before") + F.col(f"{s}_before_above") for s in sums}
    if base:
        here = F.col(f"{sums[0]}_before_above") + F.col("base_before")
        new["base_before"] = F.coalesce(here, F.col("base_before_above"))
    return joined.withColumns(new).drop("up", *[f"{c}_above" for c in kept])


def running_totals(
    log: DataFrame, totals: dict[str, Column], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add running totals (``name -> 0/1 or number``) per source in ``seq`` order.

    The offsets are the chunk totals, one row per chunk. The joined log stays
    partitioned by (source, chunk), so its rows are shuffled once.
    """
    rows = with_chunk(log.withColumns(totals), chunk_rows)
    local = rows.withColumns({name: F.sum(name).over(_so_far()) for name in totals})
    chunks = local.groupBy("source", "chunk").agg(*[F.max_by(name, "seq").alias(name) for name in totals])
    offsets = _with_before(chunks, list(totals)).drop(*totals)
    joined = (
        local.join(offsets, ["source", "chunk"])
        .withColumns({name: F.col(name) + F.col(f"{name}_before") for name in totals})
        .drop("chunk", *[f"{name}_before" for name in totals])
    )
    return _plain(joined)


# --- runs of failures ---------------------------------------------------------
#
# A stretch of the log is summed up by a segment: its number of rows ``n``, how
# many failures it begins (``lead``) and ends (``trail``) with, its longest run
# (``best``) and whether it holds a success at all (``broken``). Segments that
# follow each other add up to one, in any grouping, so chunks are folded to
# groups and groups to sources.

SEGMENT = ("n", "lead", "trail", "best", "broken")


def chunk_codes(
    log: DataFrame, ok: str, chunk_rows: int = CODE_ROWS, totals: dict[str, Column] | None = None
) -> DataFrame:
    """One row per (keyed source, chunk): ``codes``, the outcomes in order, and totals.

    A code is twice the row's place in its chunk, plus 1 for a success: four
    bytes a row are shuffled. Rows without ``seq`` have no code and count in the
    totals only, in chunk 0.
    """
    numbered = _keyed(with_known(log, ok)).withColumn("chunk", _part("seq", chunk_rows))
    place = F.col("seq") - F.col("chunk") * chunk_rows
    code = (place * 2 + F.col(ok).cast("bigint")).cast("int")
    return numbered.groupBy("source", "chunk").agg(
        F.sort_array(F.collect_list(code)).alias("codes"),
        *[c.alias(name) for name, c in (totals or {}).items()],
    )


def _successes(codes: Column) -> Column:
    """Places of the successes among ``codes``."""
    marked = F.transform(codes, lambda c, i: F.when(c.bitwiseAND(1) == 1, i))
    return F.filter(marked, lambda i: i.isNotNull())


def with_segment(chunks: DataFrame) -> DataFrame:
    """Chunks of codes with the columns of their segment; ``codes`` stays."""
    ends = F.concat("oks", F.array(F.size("codes")))
    gaps = F.transform(ends, lambda end, i: end - F.when(i == 0, 0).otherwise(F.col("oks")[i - 1] + 1))
    return (
        chunks.withColumn("oks", _successes(F.col("codes")))
        .withColumn("gaps", gaps)
        .withColumns(
            {
                "n": F.size("codes").cast("bigint"),
                "lead": F.element_at("gaps", 1).cast("bigint"),
                "trail": F.element_at("gaps", -1).cast("bigint"),
                "best": F.array_max("gaps").cast("bigint"),
                "broken": F.size("oks") > 0,
            }
        )
        .drop("gaps")
    )


def _then(a: Column, b: Column) -> Column:
    """The segment of a stretch and the one that follows it."""
    return F.struct(
        (a["n"] + b["n"]).alias("n"),
        F.when(a["broken"], a["lead"]).otherwise(a["n"] + b["lead"]).alias("lead"),
        F.when(b["broken"], b["trail"]).otherwise(b["n"] + a["trail"]).alias("trail"),
        F.greatest(a["best"], b["best"], a["trail"] + b["lead"]).alias("best"),
        (a["broken"] | b["broken"]).alias("broken"),
    )


def _folded(group, merges: dict[str, Column]) -> DataFrame:
    none = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in SEGMENT[:-1]], F.lit(False).alias("broken"))
    listed = F.sort_array(F.collect_list(F.struct("chunk", *SEGMENT)))
    folded = group.agg(listed.alias("listed"), *[c.alias(name) for name, c in merges.items()])
    return folded.withColumn("folded", F.aggregate("listed", none, _then)).select(
        *[c for c in folded.columns if c != "listed"], "folded.*"
    )


def fold_segments(chunks: DataFrame, merges: dict[str, Column] | None = None) -> DataFrame:
    """One segment per source, and per source the totals that ``merges`` names.

    ``FOLD`` neighbouring chunks become one, the result again, and so on until
    few are left of any source. After the first step, which takes a busy source
    apart, a source stays in its partition.
    """
    merges = merges or {}
    for level in range(FOLD_LEVELS):
        groups = chunks.withColumn("up", _part("chunk", FOLD)).groupBy("source", "up")
        chunks = _folded(groups, merges).withColumnRenamed("up", "chunk")
        if level == 0:
            chunks = chunks.repartition("source")
    return _plain(_folded(chunks.groupBy("source"), merges))


def earlier_runs(before: DataFrame, *also: str) -> DataFrame:
    """An earlier result of ``failure_runs`` as a chunk ahead of all others."""
    return _keyed(before).select(
        "source",
        F.lit(FIRST).alias("chunk"),
        F.col("current_streak").alias("n"),
        F.lit(0).cast("bigint").alias("lead"),
        F.col("current_streak").alias("trail"),
        F.col("max_streak").alias("best"),
        F.lit(True).alias("broken"),
        *also,
    )


def runs_and_totals(
    log: DataFrame,
    ok: str,
    totals: dict[str, Column],
    merges: dict[str, Column],
    chunk_rows: int = CODE_ROWS,
) -> DataFrame:
    """Per source, from one scan: ``totals``, added up by ``merges``, ``current_streak``
    and ``max_streak``. Rows without ``seq`` count in the totals only."""
    chunks = with_segment(chunk_codes(log, ok, chunk_rows, totals)).select("source", "chunk", *SEGMENT, *totals)
    return fold_segments(chunks, merges).select(
        "source", *totals, F.col("trail").alias("current_streak"), F.col("best").alias("max_streak")
    )


def failure_runs(
    log: DataFrame, ok: str, chunk_rows: int = CODE_ROWS, before: DataFrame | None = None
) -> DataFrame:
    """Per source: ``current_streak`` (failures since the last success) and
    ``max_streak`` (longest run of failures)."""
    rows = log.select("source", "seq", ok).where("seq is not null")
    chunks = with_segment(chunk_codes(rows, ok, chunk_rows)).select("source", "chunk", *SEGMENT)
    if before is not None:
        chunks = chunks.unionByName(earlier_runs(before))
    return fold_segments(chunks).select(
        "source", F.col("trail").alias("current_streak"), F.col("best").alias("max_streak")
    )


def with_carry(segments: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Adds ``carry``, the length of the failure run that reaches a chunk's start.

    With fewer ``levels`` a source's windows see more rows: with one, a row per
    2^32 numbers.
    """
    after_success = F.when(F.col("broken"), F.col("n") - F.col("trail"))
    nodes = _with_before(segments.withColumn("base", after_success), ["n"], "base", levels)
    carry = F.col("n_before") - F.coalesce("base_before", F.lit(0))
    return nodes.withColumn("carry", carry).drop("n_before", "base", "base_before")


def streaks_of_chunks(chunks: DataFrame, at_least: int, chunk_rows: int = CODE_ROWS) -> DataFrame:
    """Failures that are at least the ``at_least``-th of their run, from chunks with
    ``codes`` and ``carry``; an earlier run has no codes."""
    chunks = chunks.where("codes is not null").withColumn("oks", _successes(F.col("codes")))
    # A run reaches from behind a success, or from before the chunk, to the next one.
    starts = F.concat(F.array(-F.col("carry") - 1), F.col("oks").cast("array<bigint>"))
    spans = F.transform(
        starts,
        lambda s, i: F.struct(
            s.alias("start"),
            F.greatest(s + at_least, F.lit(0)).alias("from"),
            F.coalesce(F.get("oks", i), F.size("codes")).cast("bigint").alias("end"),
        ),
    )
    hits = F.transform(
        F.filter(spans, lambda x: x["from"] < x["end"]),
        lambda x: F.transform(
            F.sequence(x["from"], x["end"] - 1),
            lambda p: F.struct(F.get("codes", p.cast("int")).alias("code"), (p - x["start"]).alias("streak")),
        ),
    )
    seq = F.col("chunk") * chunk_rows + F.shiftright("code", 1)
    found = chunks.select("source", "chunk", F.inline(F.flatten(hits)))
    return _plain(found.select("source", seq.alias("seq"), "streak"))


def failures_with_streak(
    log: DataFrame, ok: str, chunk_rows: int = CODE_ROWS, before: DataFrame | None = None, at_least: int = 1
) -> DataFrame:
    """``source, seq, streak`` of every failure that is at least the ``at_least``-th in a row."""
    rows = log.select("source", "seq", ok).where("seq is not null")
    chunks = with_segment(chunk_codes(rows, ok, chunk_rows)).drop("oks")
    if before is not None:
        chunks = chunks.unionByName(earlier_runs(before), allowMissingColumns=True)
    return streaks_of_chunks(with_carry(chunks), at_least, chunk_rows)


def last_rows(log: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of each source, with ``place`` 1 for the newest.

    Spark keeps only ``n`` rows per source and task before the shuffle.
    """
    newest = W.partitionBy("source").orderBy(F.col("seq").desc())
    return log.where("seq is not null").withColumn("place", F.row_number().over(newest)).where(F.col("place") <= n)
