from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart import functions as clean


def evaluate(spark, expression, values, **options):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    result = rows.select("i", expression(F.col("x"), **options).alias("y")).collect()
    return {values[row.i]: row.y for row in result}


def test_guarded_int(spark):
    expected = {
        "12": 12, "007": 7, "0": 0, "": None, None: None, " 7": None, "7 ": None, "12.7": None,
        "-1": None, "+1": None, "1e3": None, "n/a": None, "12\n": None, "2147483647": 2147483647,
        "2147483648": None, "٣": None,
    }
    assert evaluate(spark, clean.guarded_int, list(expected)) == expected


def test_guarded_decimal(spark):
    expected = {
        "12": Decimal("12.00"), "12.345": Decimal("12.35"), "0.5": Decimal("0.50"), ".5": None,
        "5.": None, "-1.00": None, "$5": None, "1e3": None, " 1": None, "1.0\n": None, "": None,
        None: None, "99999999.99": Decimal("99999999.99"), "100000000": None,
    }
    result = evaluate(spark, lambda x: clean.guarded_decimal(x, 10, 2), list(expected))
    assert result == expected
    ratings = {"4.25": Decimal("4.3"), "99.9": Decimal("99.9"), "123.4": None}
    result = evaluate(spark, lambda x: clean.guarded_decimal(x, 3, 1), list(ratings))
    assert result == ratings


def test_us_date(spark):
    expected = {
        "3/5/2021": date(2021, 3, 5), "03/05/2021": date(2021, 3, 5),
        "12/31/2030": date(2030, 12, 31), "13/45/2001": None, "2/29/2021": None,
        "2/29/2020": date(2020, 2, 29), "3/5/21": None, "2021-03-05": None, "": None, None: None,
    }
    assert evaluate(spark, clean.us_date, list(expected)) == expected


def test_loose_int_equals_the_cast_without_ansi(spark):
    values = [
        "12", " 7 ", "\t7\n", "12.7", "-12.7", "+3", ".5", "-.5", "5.", ".", "-", "+", "", " ",
        "1e3", "n/a", "1 2", "12.7.1", "2147483647", "2147483648", "-2147483648", "-2147483649",
        "2147483647.9", "99999999999.1", "--1", "12.a", "007", "0x10", None,
    ]
    ours = evaluate(spark, clean.loose_int, values)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = evaluate(spark, lambda x: x.cast("int"), values)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert ours == legacy
    assert ours["12.7"] == 12 and ours[" 7 "] == 7 and ours[".5"] == 0


def test_loose_double(spark):
    expected = {"1.5": 1.5, "-1": -1.0, "1e3": 1000.0, " 2 ": 2.0, "free": None, "": None, None: None}
    assert evaluate(spark, clean.loose_double, list(expected)) == expected


def test_money(spark):
    expected = {
        "1.5": Decimal("1.5"), "-1.00": Decimal("-1"), "12.345": Decimal("12.345"),
        "0.000000015": Decimal("0.00000002"),
        "free": None, "": None, None: None,
    }
    assert evaluate(spark, clean.money, list(expected)) == expected


def test_or_empty_and_not_blank(spark):
    assert evaluate(spark, clean.or_empty, ["a", "", None]) == {"a": "a", "": "", None: ""}
    assert evaluate(spark, clean.not_blank, ["a", "", None]) == {"a": True, "": False, None: False}


@pytest.mark.parametrize("expression, value", [
    (clean.guarded_int, "2147483648"),
    (lambda x, strict: clean.guarded_decimal(x, 3, 1, strict), "123.4"),
    (clean.us_date, "13/45/2001"),
])
def test_strict_raises(spark, expression, value):
    with pytest.raises(Exception, match="CAST|NUMERIC|PARSE|TIMESTAMP"):
        evaluate(spark, expression, [value], strict=True)


def test_strict_keeps_what_does_not_have_the_shape_null(spark):
    assert evaluate(spark, clean.guarded_int, ["n/a", "-1"], strict=True) == {"n/a": None, "-1": None}
    assert evaluate(spark, clean.us_date, [""], strict=True) == {"": None}
