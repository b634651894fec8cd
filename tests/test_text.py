import pytest
from pyspark.sql import functions as F

from navloom.functions import display, text
from tests.helpers import day


def values(spark, expression, inputs, kind="string"):
    rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_code_padding(spark):
    assert values(spark, text.fund_code, ["1", "163402", "  163402  ", "1234567", None]) == [
        "000001", "163402", "163402", "1234567", None,
    ]


def test_first_number_stops_at_thousands_separator_and_finds_years(spark):
    inputs = ["10.60亿元（截止至：2025年）", "---（截止至：2025年12月31日）", "1,234", "-3.5%", "none", None]
    assert values(spark, text.first_number, inputs) == [10.6, 2025.0, 1.0, -3.5, None, None]


def test_rates_and_blank_texts(spark):
    inputs = ["1.20%（每年）", "---", "", "---（每年）", None]
    assert values(spark, text.rate_to_ratio, inputs) == [0.012, None, None, None, None]
    assert values(spark, text.number_or_blank, ["---", " 5亿 "]) == [None, 5.0]


def test_money_clamp(spark):
    inputs = [1e20, -1e20, 5.0, float("nan"), float("inf"), None]
    limit = 99999999999999.99
    assert values(spark, text.clamp_money, inputs, "double") == [limit, -limit, 5.0, None, None, None]


def test_general_date(spark):
    inputs = ["2024-01-05 起", "成立 2024/01/05", "2024年1月5日", "2024-13-40", "---", "", "later", None]
    d = day("2024-01-05")
    assert values(spark, text.general_date, inputs) == [d, d, d, None, None, None, None, None]


def test_inception_prefers_the_chinese_form(spark):
    inputs = ["2001年 3月 5日 / 2024-01-01", "2024-1-5 / x", "2024/1/5", "unknown", None]
    assert values(spark, text.inception_date, inputs) == [
        day("2001-03-05"), day("2024-01-05"), day("2024-01-05"), None, None,
    ]


def test_dividends_and_splits(spark):
    assert values(spark, text.dividend_amount, ["每份派现金0.1584元", "无", None]) == [0.1584, None, None]
    assert values(spark, text.split_ratio, ["1:3.9939", "2.5", "1:", "一拆二", None]) == [
        3.9939, 2.5, None, None, None,
    ]


def test_number_coercion(spark):
    inputs = [" 7 ", "1e3", "1.5d", "2f", "bad", "", "NaN", None]
    assert values(spark, text.to_number, inputs) == [7.0, 1000.0, None, None, None, None, None, None]


def test_date_coercion(spark):
    inputs = ["2024-01-05", "2024/1/5", "20240105", "2024-02-30", "x", "", None]
    d = day("2024-01-05")
    assert values(spark, text.to_date, inputs) == [d, d, d, None, None, None, None]


@pytest.mark.parametrize("digits", [2, 6, 10])
def test_round_exact_equals_correct_rounding(spark, digits):
    """Python's round is correctly rounded on the binary value: the yardstick here."""
    import random

    random.seed(digits)
    inputs = [2.675, 0.125, 0.375, 1.005, -2.675, -0.125, 12.5, 0.0, 1e17, 123456.785]
    inputs += [random.uniform(-100, 100) for _ in range(500)]
    inputs += [(k + 0.5) / 10**digits for k in range(-200, 200)]
    got = values(spark, lambda c: display.round_exact(c, digits), inputs, "double")
    assert got == [round(x, digits) for x in inputs]


def test_round_exact_leaves_infinities_and_nan(spark):
    got = values(spark, lambda c: display.round_exact(c, 2), [float("inf"), float("nan"), None], "double")
    assert got[0] == float("inf") and got[1] != got[1] and got[2] is None


def test_styles(spark):
    assert values(spark, lambda c: display.styled(c, "int"), [12.5, 13.5, None], "double") == [12, 14, None]
    assert values(spark, lambda c: display.styled(c, "percent0"), [0.125, 0.375, None], "double") == [12, 38, None]
    assert values(spark, lambda c: display.styled(c, "percent2"), [0.12345, None], "double") == [round(12.345, 2), None]


def test_fixed_text_and_buckets(spark):
    assert values(spark, lambda c: display.fixed_text(c, 10, "-"), [0.5, None], "double") == ["0.5000000000", "-"]
    assert values(spark, display.percent_text, [1 / 3], "double") == ["33.33%"]
    inputs = [0.0, 0.01, -0.02, 0.05, 0.1, None]
    assert values(spark, display.deviation_bucket, inputs, "double") == [
        "<1%", "1%～2%", "2%～5%", "5%～10%", "10%以上", "-",
    ]
