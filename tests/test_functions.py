import random

from pyspark.sql import functions as F

from vacanta.functions.numbers import percent, round_exact
from vacanta.functions.text import (
    blank_to_null,
    contains_ci,
    has_ink,
    is_bad_number,
    list_as_text,
    to_number,
)
from vacanta.functions.times import hour_label, hours_between, iso_text


def one(spark, values, kind, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_numbers_from_text(spark):
    values = ["", " 3 ", "1_000", "1d", "1f", "1万", None, "-2.5e3", ".5", "7.", "inf", "   ", "0x10"]
    assert one(spark, values, "string", to_number(blank_to_null(F.col("x")))) == [
        None, 3.0, None, None, None, None, None, -2500.0, 0.5, 7.0, float("inf"), None, None,
    ]
    assert one(spark, values, "string", is_bad_number(F.col("x"))) == [
        False, False, True, True, True, True, False, False, False, False, False, True, True,
    ]


def test_lists_as_text(spark):
    values = ['["a","b"]', "[]", '"t"', "5", "null", None, '["a",null,"b"]']
    column = list_as_text(F.parse_json("x"))
    assert one(spark, values, "string", column) == ["a,b", "", "t", "5", None, None, "a,b"]


def test_rounding_agrees_with_python(spark):
    random.seed(1)
    values = [2.675, 0.125, 0.375, 1.005, 99.995, 0.0, 100.0, -2.675, 12.0625, 33.335, 1e-9, 1e6 + 0.005]
    values += [random.randrange(0, n + 1) / n * 100 for n in range(1, 1500)]
    values += [random.randrange(0, 10**6) / 1000 + 0.005 for _ in range(1500)]
    got = one(spark, values, "double", round_exact(F.col("x"), 2).cast("double"))
    assert got == [round(v, 2) for v in values]
    got = one(spark, values, "double", round_exact(F.col("x"), 1).cast("string"))
    assert got[8:] == [f"{v:.1f}" for v in values[8:]]


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (57, 100)], "a long, b long")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert got == [1 / 3 * 100, 0.0, 57 / 100 * 100]


def test_words_in_any_case(spark):
    values = ["an ERROR", "eRrOr", "currently", "erro r", "数据error", None, ""]
    want = [True, True, False, False, True, None, False]
    assert one(spark, values, "string", contains_ci(F.col("x"), "error")) == want
    assert one(spark, values, "string", contains_ci(F.col("x"), "error", "rr")) == want


def test_blank_text(spark):
    values = ["", "  \t\n", "　\xa0", "\x1c", " a ", "中"]
    assert one(spark, values, "string", has_ink(F.col("x"))) == [False] * 4 + [True] * 2
    assert [bool(v.strip()) for v in values] == [False] * 4 + [True] * 2


def test_times(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-31 07:59:59.5' as a, timestamp_ntz'2024-01-31 09:29:59.5' as b"
    )
    row = df.select(
        hour_label(F.col("a")), iso_text(F.col("a")), hours_between(F.col("a"), F.col("b"))
    ).first()
    assert tuple(row) == ("2024-01-31 07:00", "2024-01-31T07:59:59.500000", 1.5)
