"""Column expressions over texts and numbers made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.catalog import query, r6, sql_r6
from navloom.functions import display, text


def _long_text(name):
    return F.col(name).cast("long").cast("string")


@query(
    "e1_code_padding",
    f"""SELECT o_orderkey, {b.sql_code('o_orderkey * (o_custkey % 1000 + 1)')} AS fund_code FROM orders""",
)
def e1(spark, sf):
    number = (F.col("o_orderkey") * (F.col("o_custkey") % 1000 + 1)).cast("string")
    padded = F.concat(F.lit("  "), number, F.lit("\t"))
    return b.read(spark, sf, "orders").select("o_orderkey", text.fund_code(padded).alias("fund_code"))


def _part_text(spark, sf):
    key = F.col("p_partkey")
    return b.read(spark, sf, "part").select(
        "p_partkey",
        F.when(key % 6 == 0, "n/a")
        .when(key % 6 == 1, F.concat(F.lit("约-"), _long_text("p_size"), F.lit(".25亿元（截止至：2025年）")))
        .when(key % 6 == 2, F.concat("p_brand", F.lit(" 9.9")))
        .when(key % 6 == 3, F.concat(F.lit("1,"), _long_text("p_size")))
        .when(key % 6 == 4, "---")
        .otherwise(F.concat(_long_text("p_size"), F.lit(".50%（每年）")))
        .alias("raw"),
    )


PART_TEXT = """(SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'n/a'
    WHEN 1 THEN '约-' || CAST(p_size AS VARCHAR) || '.25亿元（截止至：2025年）' WHEN 2 THEN p_brand || ' 9.9'
    WHEN 3 THEN '1,' || CAST(p_size AS VARCHAR) WHEN 4 THEN '---'
    ELSE CAST(p_size AS VARCHAR) || '.50%（每年）' END AS raw FROM part)"""
FIRST_NUMBER = r"TRY_CAST(regexp_extract(raw, '[-+]?[0-9]+(?:\.[0-9]+)?') AS DOUBLE)"


@query("e2_first_number", f"SELECT p_partkey, {sql_r6(FIRST_NUMBER)} AS value FROM {PART_TEXT}")
def e2(spark, sf):
    return _part_text(spark, sf).select("p_partkey", r6(text.first_number(F.col("raw"))).alias("value"))


@query(
    "e3_rate_to_ratio",
    f"""SELECT p_partkey, CASE WHEN raw <> '---' THEN {sql_r6(FIRST_NUMBER + ' / 100e0')} END AS ratio
        FROM {PART_TEXT}""",
)
def e3(spark, sf):
    return _part_text(spark, sf).select("p_partkey", r6(text.rate_to_ratio(F.col("raw"))).alias("ratio"))


@query(
    "e4_money_clamp",
    """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL
         ELSE least(greatest((p_partkey % 3 - 1) * p_retailprice * 1e11, -99999999999999.99::DOUBLE), 99999999999999.99::DOUBLE) + 0e0
         END AS amount FROM part""",
)
def e4(spark, sf):
    key = F.col("p_partkey")
    value = (
        F.when(key % 10 == 0, F.lit(float("nan")))
        .when(key % 5 == 0, F.lit(float("inf")))
        .otherwise((key % 3 - 1) * F.col("p_retailprice") * F.lit(1e11))
    )
    clamped = text.clamp_money(value) + F.lit(0.0)
    return b.read(spark, sf, "part").select("p_partkey", clamped.alias("amount"))


def _order_text(spark, sf):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    shapes = [
        F.date_format(day, "yyyy-MM-dd"),
        F.concat(F.lit("成立于"), F.date_format(day, "yyyy/MM/dd"), F.lit(" 规模2亿")),
        F.concat(F.date_format(day, "yyyy年M月d日"), F.lit(" / 3.5亿份")),
        F.date_format(day, "yyyyMMdd"),
        F.lit("---"),
        F.lit(""),
        F.lit("未知"),
        F.date_format(day, "yyyy-M-d"),
    ]
    raw = F.when(key % 8 == 0, shapes[0])
    for i, shape in enumerate(shapes[1:], start=1):
        raw = raw.when(key % 8 == i, shape)
    return b.read(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))


ORDER_DAY = """SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (4, 5, 6) THEN NULL
               ELSE CAST(o_orderdate AS DATE) END AS day FROM orders"""


@query("e5_general_date", ORDER_DAY)
def e5(spark, sf):
    return _order_text(spark, sf).select("o_orderkey", text.general_date(F.col("raw")).alias("day"))


@query("e6_inception_date", ORDER_DAY)
def e6(spark, sf):
    spaced = F.regexp_replace("raw", "([年月])", "$1 ")
    return _order_text(spark, sf).select("o_orderkey", text.inception_date(spaced).alias("day"))


@query(
    "e7_dividend_amount",
    f"""SELECT fund_code, ex_date, CAST(substr(per_share_text, 6, 4) AS DOUBLE) AS amount FROM bonus""",
)
def e7(spark, sf):
    return b.bonus(spark, sf).select(
        "fund_code", "ex_date", text.dividend_amount(F.col("per_share_text")).alias("amount")
    )


@query(
    "e8_split_ratio",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size + 125e-3 WHEN 1 THEN p_size * 1e0 END AS ratio
       FROM part""",
)
def e8(spark, sf):
    key = F.col("p_partkey")
    raw = (
        F.when(key % 4 == 0, F.concat(F.lit(" 1: "), _long_text("p_size"), F.lit(".125 ")))
        .when(key % 4 == 1, _long_text("p_size"))
        .when(key % 4 == 2, "1:")
        .otherwise("一拆二")
    )
    return b.read(spark, sf, "part").select("p_partkey", text.split_ratio(raw).alias("ratio"))


@query(
    "e9_coercion",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
              CASE o_orderkey % 3 WHEN 0 THEN o_custkey * 1e0 WHEN 1 THEN o_custkey * 1e3 END AS number
       FROM orders""",
)
def e9(spark, sf):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    date_text = (
        F.when(key % 3 == 0, "2001-02-30")
        .when(key % 3 == 1, F.date_format(day, "yyyy/M/d"))
        .otherwise(F.date_format(day, " yyyy-MM-dd "))
    )
    number_text = (
        F.when(key % 3 == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")))
        .when(key % 3 == 1, F.concat(F.col("o_custkey").cast("string"), F.lit("e3")))
        .otherwise("12.5f")
    )
    return b.read(spark, sf, "orders").select(
        "o_orderkey", text.to_date(date_text).alias("day"), text.to_number(number_text).alias("number")
    )


@query(
    "e10_display_styles",
    """SELECT DISTINCT x, CAST(printf('%.0f', x) AS BIGINT) AS as_int, CAST(printf('%.2f', x) AS DOUBLE) AS round2,
              CAST(printf('%.2f', x * 100) AS DOUBLE) AS percent2, CAST(printf('%.0f', x * 100) AS BIGINT) AS percent0,
              strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS day
       FROM (SELECT *, l_quantity / 8e0 + l_discount / 2e0 + l_tax / 16e0 AS x FROM lineitem)""",
)
def e10(spark, sf):
    """Many of these values lie on a rounding tie, exactly or only in their shortest decimal text."""
    x = F.col("l_quantity") / F.lit(8.0) + F.col("l_discount") / F.lit(2.0) + F.col("l_tax") / F.lit(16.0)
    lines = b.read(spark, sf, "lineitem").select("l_shipdate", x.alias("x"))
    return lines.select(
        "x",
        display.styled(F.col("x"), "int").alias("as_int"),
        display.styled(F.col("x"), "round2").alias("round2"),
        display.styled(F.col("x"), "percent2").alias("percent2"),
        display.styled(F.col("x"), "percent0").alias("percent0"),
        display.styled(F.col("l_shipdate"), "date").alias("day"),
    ).distinct()


@query(
    "e11_fixed_text",
    """SELECT DISTINCT x, CASE WHEN x IS NULL THEN '-' ELSE printf('%.10f', x) END AS ten_decimals,
              CASE WHEN x IS NULL THEN NULL ELSE printf('%.2f', x * 100) || '%' END AS percent,
              CASE WHEN x IS NULL THEN NULL ELSE printf('%.6f', x) END AS six_decimals
       FROM (SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount / l_quantity + l_tax / 64e0 END AS x
             FROM lineitem)""",
)
def e11(spark, sf):
    value = F.when(
        F.col("l_linenumber") != 3, F.col("l_discount") / F.col("l_quantity") + F.col("l_tax") / F.lit(64.0)
    )
    lines = b.read(spark, sf, "lineitem").select(value.alias("x"))
    return lines.select(
        "x",
        display.fixed_text(F.col("x"), 10, missing="-").alias("ten_decimals"),
        display.percent_text(F.col("x")).alias("percent"),
        display.fixed_text(F.col("x"), 6).alias("six_decimals"),
    ).distinct()


@query(
    "e12_deviation_bucket",
    """SELECT bucket, count(*) AS n FROM (
         SELECT CASE WHEN d IS NULL THEN '-' WHEN abs(d) < 0.01::DOUBLE THEN '<1%' WHEN abs(d) < 0.02::DOUBLE THEN '1%～2%'
                     WHEN abs(d) < 0.05::DOUBLE THEN '2%～5%' WHEN abs(d) < 0.1::DOUBLE THEN '5%～10%' ELSE '10%以上' END AS bucket
         FROM (SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount - l_tax END AS d FROM lineitem))
       GROUP BY 1""",
)
def e12(spark, sf):
    d = F.when(F.col("l_linenumber") != 3, F.col("l_discount") - F.col("l_tax"))
    lines = b.read(spark, sf, "lineitem").select(display.deviation_bucket(d).alias("bucket"))
    return lines.groupBy("bucket").agg(F.count("*").alias("n"))


@query(
    "e13_joined_reasons",
    """SELECT s_suppkey, concat_ws('；', CASE WHEN s_suppkey % 2 = 0 THEN 'even' END,
              CASE WHEN s_acctbal < 0 THEN 'negative' END, CASE WHEN s_nationkey > 12 THEN 'far' END) AS reasons
       FROM supplier""",
)
def e13(spark, sf):
    rules = (
        (F.col("s_suppkey") % 2 == 0, F.lit("even")),
        (F.col("s_acctbal") < 0, F.lit("negative")),
        (F.col("s_nationkey") > 12, F.lit("far")),
    )
    return b.read(spark, sf, "supplier").select("s_suppkey", display.joined_reasons(rules).alias("reasons"))


@query(
    "e14_flagged_names",
    """SELECT s_suppkey, concat_ws(',', CASE WHEN s_suppkey % 2 = 0 THEN 'zeta' END,
              CASE WHEN s_acctbal < 0 THEN 'beta' END, CASE WHEN s_nationkey > 12 THEN 'alpha' END) AS in_order,
              concat_ws(', ', CASE WHEN s_nationkey > 12 THEN 'alpha' END, CASE WHEN s_acctbal < 0 THEN 'beta' END,
              CASE WHEN s_suppkey % 2 = 0 THEN 'zeta' END) AS sorted_names
       FROM supplier""",
)
def e14(spark, sf):
    flags = [
        ("zeta", F.col("s_suppkey") % 2 == 0),
        ("beta", F.col("s_acctbal") < 0),
        ("alpha", F.col("s_nationkey") > 12),
    ]
    return b.read(spark, sf, "supplier").select(
        "s_suppkey",
        display.names_where(flags, ",").alias("in_order"),
        display.names_where(flags, ", ", in_order=False).alias("sorted_names"),
    )


@query(
    "e15_displayed_number",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey + 25e-2 END AS two_decimals,
              CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey * 1e0 END AS whole
       FROM orders""",
)
def e15(spark, sf):
    shown = F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise(
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(".25"))
    )
    return b.read(spark, sf, "orders").select(
        "o_orderkey",
        display.displayed_number(shown, "round2").alias("two_decimals"),
        display.displayed_number(shown, "int").alias("whole"),
    )


@query(
    "e16_tolerant_equality",
    """SELECT l_orderkey, l_linenumber, l_suppkey,
              CASE WHEN a IS NULL AND d IS NULL THEN TRUE WHEN a IS NULL OR d IS NULL THEN FALSE
                   ELSE abs(a - d) <= 1e-12 END AS same
       FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS a,
                    CASE WHEN l_linenumber <= 2 THEN NULL WHEN l_linenumber = 3 THEN l_tax + 1e-13
                         ELSE l_discount END AS d FROM lineitem)""",
)
def e16(spark, sf):
    line = F.col("l_linenumber")
    left = F.when(line != 1, F.col("l_tax"))
    right = F.when(line == 3, F.col("l_tax") + F.lit(1e-13)).when(line > 3, F.col("l_discount"))
    return b.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", display.same_displayed(left, right).alias("same")
    )
