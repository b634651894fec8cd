"""Fund-shaped tables derived from the driver tables, once in Spark and once in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.catalog import TABLES
from navloom.functions.text import fund_code
from navloom.operators import adjusted_nav

VERSIONS = (("v1", "1998-06-30"), ("v2", "1999-06-30"), ("v3", "2000-06-30"))
NAV_VERSIONS = (("n1", "2000-06-30"), ("n2", "2001-12-31"))


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def code(name: str) -> Column:
    return fund_code(F.col(name))


def sql_code(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"CASE WHEN length({text}) >= 6 THEN {text} ELSE lpad({text}, 6, '0') END"


def _text(value: Column) -> Column:
    return value.cast("long").cast("string")


def _padded(value: Column, width: int) -> Column:
    return F.lpad(_text(value), width, "0")


def nav(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem")
    return lines.groupBy(
        code("l_suppkey").alias("fund_code"), F.to_date("l_shipdate").alias("nav_date")
    ).agg((F.lit(1.0) + F.floor(F.max("l_extendedprice")) / F.lit(1e6)).alias("unit_nav"))


TABLES["nav"] = f"""
SELECT {sql_code('l_suppkey')} AS fund_code, CAST(l_shipdate AS DATE) AS nav_date,
       1e0 + floor(max(l_extendedprice)) / 1e6 AS unit_nav
FROM lineitem GROUP BY 1, 2"""


def raw_nav(spark: SparkSession, sf: str) -> DataFrame:
    """NAV as text with unreadable dates and numbers among the rows."""
    lines, kind = read(spark, sf, "lineitem"), F.col("l_linenumber")
    return lines.select(
        F.concat(F.lit(" "), _text(F.col("l_suppkey")), F.lit(" ")).alias("fund_code"),
        F.when(kind == 6, "bad")
        .when(kind == 5, F.date_format("l_shipdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("nav_date"),
        F.when(kind == 2, "---")
        .otherwise(F.concat(F.lit("1."), _padded(F.floor("l_extendedprice"), 6)))
        .alias("unit_nav"),
        F.when(kind == 3, "").otherwise(_text(F.round(F.col("l_discount") * 100))).alias("daily_growth"),
    )


def bonus(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem").where(
        "l_returnflag = 'R' and l_linenumber = 1 and l_discount > 0"
    )
    return lines.select(code("l_suppkey").alias("fund_code"), *_bonus_columns(F.to_date("l_shipdate")))


def _bonus_columns(day: Column) -> list[Column]:
    cents = _padded(F.round(F.col("l_discount") * 100), 2)
    return [
        F.date_format(day, "yyyy").alias("year"),
        F.date_sub(day, 1).alias("record_date"),
        day.alias("ex_date"),
        F.concat(F.lit("每份派现金0."), cents, F.lit("元")).alias("per_share_text"),
        F.date_add(day, 2).alias("pay_date"),
    ]


TABLES["bonus"] = f"""
SELECT {sql_code('l_suppkey')} AS fund_code, CAST(l_shipdate AS DATE) AS ex_date,
       '每份派现金0.' || lpad(CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR), 2, '0') || '元'
         AS per_share_text
FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1 AND l_discount > 0"""


def bonus_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """As bonus; every fifth fund (1) has early and every fifth (2) any dividends on order days."""
    lines = read(spark, sf, "lineitem").where(
        "l_returnflag = 'R' and l_linenumber = 1 and l_discount > 0"
    )
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    part = F.col("l_suppkey") % 5
    ordered, shipped = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    early = ordered < F.lit("1996-07-01").cast("date")
    day = (
        F.when((part == 1) & early, ordered).when(part == 2, ordered).otherwise(shipped)
    )
    return joined.select(code("l_suppkey").alias("fund_code"), *_bonus_columns(day))


TABLES["bonus_mixed"] = f"""
SELECT {sql_code('l_suppkey')} AS fund_code,
       CASE WHEN l_suppkey % 5 = 1 AND CAST(o_orderdate AS DATE) < DATE '1996-07-01' THEN CAST(o_orderdate AS DATE)
            WHEN l_suppkey % 5 = 2 THEN CAST(o_orderdate AS DATE)
            ELSE CAST(l_shipdate AS DATE) END AS ex_date,
       '每份派现金0.' || lpad(CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR), 2, '0') || '元'
         AS per_share_text
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R' AND l_linenumber = 1 AND l_discount > 0"""


def split(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem").where("l_linenumber = 7 and l_tax = 0.08")
    day = F.to_date("l_shipdate")
    return lines.select(
        code("l_suppkey").alias("fund_code"),
        F.date_format(day, "yyyy").alias("year"),
        day.alias("split_date"),
        F.lit("份额折算").alias("split_type"),
        F.concat(F.lit("1:1."), _padded(F.round(F.col("l_tax") * 100), 2)).alias("ratio_text"),
    )


TABLES["split"] = f"""
SELECT {sql_code('l_suppkey')} AS fund_code, CAST(l_shipdate AS DATE) AS split_date,
       '1:1.' || lpad(CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR), 2, '0') AS ratio_text
FROM lineitem WHERE l_linenumber = 7 AND l_tax = 0.08"""

# Adjusted NAV in SQL: events on NAV days only, factors multiplied per day and then over days.
TABLES["day_factor"] = """
SELECT fund_code, nav_date, product(factor) AS factor FROM (
  SELECT n.fund_code, n.nav_date,
         (n.unit_nav + CAST(regexp_extract(b.per_share_text, '[0-9]+(?:\\.[0-9]+)?') AS DOUBLE)) / n.unit_nav AS factor
  FROM nav n JOIN bonus b ON b.fund_code = n.fund_code AND b.ex_date = n.nav_date
  UNION ALL
  SELECT n.fund_code, n.nav_date, CAST(split_part(s.ratio_text, ':', 2) AS DOUBLE)
  FROM nav n JOIN split s ON s.fund_code = n.fund_code AND s.split_date = n.nav_date
) GROUP BY 1, 2"""
TABLES["adjusted"] = """
SELECT fund_code, nav_date, unit_nav, unit_nav * cumulative_factor AS adjusted_nav, cumulative_factor FROM (
  SELECT n.fund_code, n.nav_date, n.unit_nav,
         product(coalesce(f.factor, 1e0)) OVER (PARTITION BY n.fund_code ORDER BY n.nav_date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_factor
  FROM nav n LEFT JOIN day_factor f ON f.fund_code = n.fund_code AND f.nav_date = n.nav_date
)"""


def adjusted(spark: SparkSession, sf: str) -> DataFrame:
    return adjusted_nav.adjust(nav(spark, sf), bonus(spark, sf), split(spark, sf))


def cum_return(spark: SparkSession, sf: str) -> DataFrame:
    """Remote cumulative return of the unit NAV on the days of the first four lines of an order."""
    lines = read(spark, sf, "lineitem").where("l_linenumber <= 4")
    days = lines.groupBy(
        code("l_suppkey").alias("fund_code"), F.to_date("l_shipdate").alias("date")
    ).agg((F.lit(1.0) + F.floor(F.max("l_extendedprice")) / F.lit(1e6)).alias("value"))
    first = days.groupBy("fund_code").agg(F.min_by("value", "date").alias("first_value"))
    percent = (F.col("value") / F.col("first_value") - F.lit(1.0)) * F.lit(100.0)
    return days.join(first, "fund_code").select(
        "fund_code", "date", F.round(percent, 4).alias("cum_return_pct")
    )


TABLES["cum_return"] = f"""
SELECT fund_code, date, round((value / first_value(value) OVER (PARTITION BY fund_code ORDER BY date) - 1e0) * 100e0, 4)
         AS cum_return_pct
FROM (SELECT {sql_code('l_suppkey')} AS fund_code, CAST(l_shipdate AS DATE) AS date,
             1e0 + floor(max(l_extendedprice)) / 1e6 AS value
      FROM lineitem WHERE l_linenumber <= 4 GROUP BY 1, 2)"""


def raw_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Order days as text, repeated, with unreadable ones among them."""
    orders = read(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(F.when(F.col("o_orderkey") % 50 == 0, "bad").otherwise(day).alias("trade_date"))


TABLES["raw_calendar"] = """
SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS trade_date FROM orders"""
TABLES["calendar"] = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date FROM orders"


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(F.to_date("o_orderdate").alias("trade_date")).distinct()


def purchase(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    return read(spark, sf, "supplier").select(
        _text(key).alias("fund_code"),
        F.concat(F.lit("P "), F.col("s_name")).alias("short_name"),
        F.when(key % 7 == 0, None)
        .when(key % 3 == 0, "暂停申购")
        .when(key % 3 == 1, "开放申购")
        .otherwise("限大额")
        .alias("subscribe_status"),
        F.when(key % 4 == 0, "暂停赎回").otherwise("开放赎回").alias("redeem_status"),
        F.when(key % 5 == 0, "---")
        .when(key % 5 == 1, "2002-03-04")
        .when(key % 5 == 2, "2002/03/05")
        .when(key % 5 == 3, "2002年3月6日")
        .otherwise("soon")
        .alias("next_open_day"),
        F.when(key % 6 == 0, "10").otherwise("1,000元").alias("purchase_min_amount"),
        F.when(key % 9 == 0, "999999999999999999").otherwise("100000000000").alias("daily_limit_amount"),
        F.concat(F.lit("0."), _padded(key % 100, 2), F.lit("%")).alias("purchase_fee"),
    )


TABLES["purchase"] = f"""
SELECT {sql_code('s_suppkey')} AS fund_code, 'P ' || s_name AS short_name,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 3 = 0 THEN '暂停申购'
            WHEN s_suppkey % 3 = 1 THEN '开放申购' ELSE '限大额' END AS subscribe_status,
       CASE WHEN s_suppkey % 4 = 0 THEN '暂停赎回' ELSE '开放赎回' END AS redeem_status,
       CASE s_suppkey % 5 WHEN 0 THEN '---' WHEN 1 THEN '2002-03-04' WHEN 2 THEN '2002/03/05'
            WHEN 3 THEN '2002年3月6日' ELSE 'soon' END AS next_open_day,
       CASE WHEN s_suppkey % 6 = 0 THEN '10' ELSE '1,000元' END AS purchase_min_amount,
       CASE WHEN s_suppkey % 9 = 0 THEN '999999999999999999' ELSE '100000000000' END AS daily_limit_amount,
       '0.' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') || '%' AS purchase_fee
FROM supplier"""


def overview(spark: SparkSession, sf: str) -> DataFrame:
    """Overview of the suppliers but every 17th, all text."""
    key = F.col("s_suppkey")
    suppliers = read(spark, sf, "supplier").where(key % 17 != 0)
    nations = read(spark, sf, "nation")
    year = _text(F.lit(1990) + key % 10)
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        _text(key).alias("fund_code"),
        F.when(key % 13 == 0, None).otherwise(F.col("s_name")).alias("short_name"),
        F.concat("s_name", F.lit("基金")).alias("full_name"),
        F.col("n_name").alias("fund_type"),
        F.lit("1990年01月01日").alias("issue_date"),
        F.when(key % 4 == 0, F.concat(year, F.lit("年3月5日 / 2.5亿份")))
        .when(key % 4 == 1, F.concat(year, F.lit("-05-06")))
        .when(key % 4 == 2, F.concat(year, F.lit("/07/08")))
        .otherwise("---")
        .alias("inception_text"),
        F.when(key % 11 == 0, "---（截止至：2025年12月31日）")
        .otherwise(
            F.concat(_text(F.floor(F.abs("s_acctbal"))), F.lit(".50亿元（截止至：2025年12月31日）"))
        )
        .alias("asset_scale"),
        F.lit("1.5亿份").alias("share_scale"),
        F.lit("管理公司").alias("manager_co"),
        F.lit("托管银行").alias("custodian"),
        F.lit("经理").alias("manager"),
        F.lit("每份累计0.00元（0次）").alias("dividends_text"),
        F.concat(F.lit("1."), _padded(key % 100, 2), F.lit("%（每年）")).alias("mgmt_fee"),
        F.when(key % 3 == 0, "---").otherwise("0.20%（每年）").alias("custody_fee"),
        F.when(key % 3 == 1, "---（每年）").otherwise("0.40%（每年）").alias("sales_fee"),
        F.lit("1.20%（前端）").alias("max_subscribe_fee"),
        F.lit("基准").alias("benchmark"),
        F.lit("无").alias("tracking"),
    )


TABLES["overview"] = f"""
SELECT {sql_code('s_suppkey')} AS fund_code, CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE s_name END AS short_name,
       s_name || '基金' AS full_name, n_name AS fund_type,
       CASE s_suppkey % 4 WHEN 0 THEN make_date(1990 + s_suppkey % 10, 3, 5)
            WHEN 1 THEN make_date(1990 + s_suppkey % 10, 5, 6)
            WHEN 2 THEN make_date(1990 + s_suppkey % 10, 7, 8) END AS inception_date,
       CASE WHEN s_suppkey % 11 = 0 THEN 2025e0 ELSE floor(abs(s_acctbal)) + 5e-1 END AS scale_billion,
       (1e0 + (s_suppkey % 100) / 100e0) / 100e0 AS management_fee_rate,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 2e-1 / 100e0 END AS custodian_fee_rate,
       CASE WHEN s_suppkey % 3 = 1 THEN NULL ELSE 4e-1 / 100e0 END AS sales_service_fee_rate,
       12e-1 / 100e0 AS max_subscribe_fee_rate
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 17 <> 0"""


def blacklist(spark: SparkSession, sf: str) -> DataFrame:
    listed = read(spark, sf, "supplier").where("s_suppkey % 10 = 3")
    return listed.select(code("s_suppkey").alias("fund_code"))


TABLES["blacklist"] = f"SELECT {sql_code('s_suppkey')} AS fund_code FROM supplier WHERE s_suppkey % 10 = 3"


def raw_personnel(spark: SparkSession, sf: str) -> DataFrame:
    """Notices as text, every tenth without a readable date."""
    return read(spark, sf, "events").select(
        _text(F.col("user_id")).alias("fund_code"),
        F.col("event_type").alias("title"),
        F.concat(F.lit("F"), _text(F.col("user_id"))).alias("fund_name"),
        F.when(F.col("event_id") % 10 == 0, "n/a")
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("notice_date"),
        _text(F.col("event_id")).alias("report_id"),
    )


TABLES["personnel"] = f"""
SELECT {sql_code('user_id')} AS fund_code, event_type AS title, 'F' || user_id AS fund_name,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS notice_date,
       CAST(event_id AS VARCHAR) AS report_id
FROM events"""


def failure_log(spark: SparkSession, sf: str) -> DataFrame:
    errors = read(spark, sf, "events").where("event_type = 'error'")
    return errors.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        F.when(F.col("user_id") % 3 == 0, "step2_overview")
        .when(F.col("user_id") % 3 == 1, "step3_nav")
        .otherwise(" ")
        .alias("stage"),
        _text(F.col("user_id")).alias("code"),
        F.col("props").alias("error"),
    )


TABLES["failure_log"] = """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts,
       CASE user_id % 3 WHEN 0 THEN 'step2_overview' WHEN 1 THEN 'step3_nav' ELSE ' ' END AS stage,
       CAST(user_id AS VARCHAR) AS code, props AS error
FROM events WHERE event_type = 'error'"""


def month_nav(spark: SparkSession, sf: str) -> DataFrame:
    """NAV per month end: dense enough for windows that need every trade day."""
    lines = read(spark, sf, "lineitem")
    return lines.groupBy(
        code("l_suppkey").alias("fund_code"), F.last_day("l_shipdate").alias("nav_date")
    ).agg((F.lit(1.0) + F.floor(F.max("l_extendedprice")) / F.lit(1e6)).alias("adjusted_nav"))


TABLES["month_nav"] = f"""
SELECT {sql_code('l_suppkey')} AS fund_code, last_day(CAST(l_shipdate AS DATE)) AS nav_date,
       1e0 + floor(max(l_extendedprice)) / 1e6 AS adjusted_nav
FROM lineitem GROUP BY 1, 2"""


def month_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(F.last_day("l_shipdate").alias("trade_date")).distinct()


TABLES["month_calendar"] = "SELECT DISTINCT last_day(CAST(l_shipdate AS DATE)) AS trade_date FROM lineitem"


def version_rows(versions) -> Column:
    """Version rows joined in through a literal array: one copy of a row per version."""
    rows = [
        F.struct(F.lit(name).alias("data_version"), F.lit(day).cast("date").alias("as_of_date"))
        for name, day in versions
    ]
    return F.inline(F.array(*rows))


def nav_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Stored month NAV of two versions, each cut at its as-of date."""
    tagged = month_nav(spark, sf).select("*", version_rows(NAV_VERSIONS))
    return tagged.where("nav_date <= as_of_date")


def _sql_versions(versions) -> str:
    return ", ".join(f"('{name}', DATE '{day}')" for name, day in versions)


TABLES["nav_versions"] = f"""
SELECT fund_code, nav_date, adjusted_nav, data_version, as_of_date
FROM month_nav, (VALUES {_sql_versions(NAV_VERSIONS)}) AS v(data_version, as_of_date)
WHERE nav_date <= as_of_date"""


def board_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Small scoreboard snapshot of three versions: annual return up to the as-of date, statuses."""
    rows = nav(spark, sf).select("*", version_rows(VERSIONS)).where("nav_date <= as_of_date")
    days = F.datediff(F.max("nav_date"), F.min("nav_date"))
    growth = F.max_by("unit_nav", "nav_date") / F.min_by("unit_nav", "nav_date")
    board = rows.groupBy("data_version", "as_of_date", "fund_code").agg(
        F.round(F.pow(growth, F.lit(365.0) / F.nullif(days, F.lit(0))) - F.lit(1.0), 9).alias("annual_return")
    )
    status = purchase(spark, sf).select(
        fund_code(F.col("fund_code")).alias("fund_code"), "subscribe_status", "redeem_status"
    )
    return board.join(status, "fund_code").where("annual_return is not null")


TABLES["board_versions"] = f"""
SELECT data_version, as_of_date, fund_code, annual_return, subscribe_status, redeem_status FROM (
  SELECT data_version, as_of_date, fund_code,
         round(pow(arg_max(unit_nav, nav_date) / arg_min(unit_nav, nav_date),
                   365e0 / nullif(date_diff('day', min(nav_date), max(nav_date)), 0)) - 1e0, 9) AS annual_return
  FROM nav, (VALUES {_sql_versions(VERSIONS)}) AS v(data_version, as_of_date)
  WHERE nav_date <= as_of_date GROUP BY 1, 2, 3
) JOIN purchase USING (fund_code) WHERE annual_return IS NOT NULL"""
