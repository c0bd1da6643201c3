"""Parameterised SQL and table profiles."""

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def execute_query(
    spark: SparkSession, query: str, params: dict | None = None, **frames: DataFrame
) -> DataFrame:
    """Run a query with ``:name`` parameters; ``{name}`` stands for a given frame."""
    return spark.sql(query, args=params or None, **frames)


def execute_sql(spark: SparkSession, statement: str, params=None, **frames: DataFrame) -> None:
    """Run a statement (CREATE, INSERT, ...).

    A dict binds ``:name``, a list binds each ``%s`` in order, and a single
    value binds ``:param_0``.
    """
    if isinstance(params, (list, tuple)):
        statement = statement.replace("%s", "?", len(params))
        args = list(params) or None
    elif params is None or isinstance(params, dict):
        args = params or None
    else:
        args = {"param_0": params}
    spark.sql(statement, args=args, **frames)


def table_profile(spark: SparkSession, names: list[str]) -> DataFrame:
    """``(table_name, table_exists, row_count)`` for each name.

    A missing table is ``(false, 0)``; one that exists but cannot be opened or
    read is ``(true, 0)``. All tables are counted by one aggregate with a map side; the
    scans read no column.
    """
    exists = {name: spark.catalog.tableExists(name) for name in names}
    listed = spark.createDataFrame(
        [(name, found, 0) for name, found in exists.items()],
        "table_name string, table_exists boolean, n bigint",
    )
    frames = [listed]
    for name, found in exists.items():
        if found:
            try:
                rows = spark.table(name)
                rows.limit(1).count()  # one that cannot be read fails here, alone
            except PySparkException:
                continue
            frames.append(
                rows.select(
                    F.lit(name).alias("table_name"),
                    F.lit(True).alias("table_exists"),
                    F.lit(1).cast("bigint").alias("n"),
                )
            )
    return (
        reduce(DataFrame.unionAll, frames)
        .groupBy("table_name", "table_exists")
        .agg(F.sum("n").alias("row_count"))
    )
