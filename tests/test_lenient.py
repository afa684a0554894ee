from decimal import Decimal

from pyspark.sql import functions as F

from shopmart.functions import is_number, lenient_decimal, lenient_long, lenient_round, value_or_default


def _one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_lenient_decimal_rules(spark):
    vals = [None, "", "abc", "0", "2.00", "12.345", "-0.125", "1e2", "12abc", " 7.5", ".5", "12."]
    got = _one(spark, vals, lambda c: lenient_decimal(c, 10, 2))
    assert got == [None, Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), Decimal("2.00"), Decimal("12.35"),
                   Decimal("-0.13"), Decimal("100.00"), Decimal("12.00"), Decimal("7.50"), Decimal("0.50"),
                   Decimal("12.00")]


def test_lenient_decimal_out_of_range_is_null(spark):
    assert _one(spark, ["123456789012.5"], lambda c: lenient_decimal(c, 10, 2)) == [None]


def test_lenient_long_rules(spark):
    vals = [None, "", "abc", "0", "3.7", "-12x", "  42", "1e2"]
    assert _one(spark, vals, lenient_long) == [None, 0, 0, 0, 3, -12, 42, 1]


def test_lenient_round_half_up_on_decimal(spark):
    vals = ["2.675", "-2.675", "1.234", "0.005", None]
    assert _one(spark, vals, lambda c: lenient_round(c, 2)) == [
        Decimal("2.68"), Decimal("-2.68"), Decimal("1.23"), Decimal("0.01"), None]


def test_is_number(spark):
    assert _one(spark, ["1.5", "abc", "", "1e3", None], is_number) == [True, False, False, True, False]


def test_value_or_default(spark):
    assert _one(spark, [None, "", "0", "card"], lambda c: value_or_default(c, "NONE")) == ["NONE", "NONE", "0", "card"]
