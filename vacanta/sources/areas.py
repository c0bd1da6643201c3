"""The area dimension and the city-code text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.fixed_values import AREAS

CODE_PAIR = r'"([0-9]+)":"([^"]*)"'


def area_dimension(spark: SparkSession) -> DataFrame:
    """32 fixed rows ``(code, name)``."""
    rows = ", ".join(f"('{code}', '{name}')" for code, name in AREAS.items())
    return spark.sql(f"select * from values {rows} as area(code, name)")


def read_city_text(spark: SparkSession, path: str) -> DataFrame:
    """Text files of ``"<digits>":"<name>"`` pairs, one row per line.

    ``line`` rises with the place in a file.
    """
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("line"), F.col("value").alias("text")
    )


def city_pairs(lines: DataFrame) -> DataFrame:
    """Every ``(line, pos, code, name)`` pair in ``lines(line, text)``."""
    codes = F.regexp_extract_all("text", F.lit(CODE_PAIR), F.lit(1))
    names = F.regexp_extract_all("text", F.lit(CODE_PAIR), F.lit(2))
    pairs = F.arrays_zip(codes.alias("code"), names.alias("name"))
    return lines.select("line", F.posexplode(pairs).alias("pos", "pair")).select(
        "line", "pos", F.col("pair.code").alias("code"), F.col("pair.name").alias("name")
    )


def city_codes(lines: DataFrame) -> DataFrame:
    """``(name, code)`` of the first pair that names each city.

    ``min_by`` combines on the map side, so a name repeated in every line costs
    one row per task in the shuffle.
    """
    return city_pairs(lines).groupBy("name").agg(
        F.min_by("code", F.struct("line", "pos")).alias("code")
    )


def city_code(lines: DataFrame, city: str) -> DataFrame:
    """The code of one city; no row where the text does not name it."""
    return city_codes(lines.where(F.contains("text", F.lit(f'":"{city}"')))).where(
        F.col("name") == city
    )
