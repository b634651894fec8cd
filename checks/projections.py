"""Normalised tables, the fund dimension, the export, and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.catalog import TABLES, query, r6, rounded, sql_r6
from navloom.operators import adjusted_nav, backtest, integrity, metrics, normalise, scoreboard

AS_OF = "2001-12-31"


@query(
    "p1_purchase",
    """SELECT fund_code, short_name, subscribe_status, redeem_status, next_open_day, purchase_min_amount,
              daily_limit_amount, purchase_fee FROM purchase""",
)
def p1(spark, sf):
    return normalise.purchase(b.purchase(spark, sf))


@query(
    "p2_overview",
    f"""SELECT fund_code, arg_min(c_name, c_custkey) AS short_name, arg_min(c_mktsegment, c_custkey) AS fund_type,
               '' AS issue_date, arg_min(CAST(c_nationkey AS VARCHAR), c_custkey) || '亿元' AS asset_scale
        FROM (SELECT *, {b.sql_code('c_custkey % 970')} AS fund_code FROM customer) GROUP BY 1""",
)
def p2(spark, sf):
    """Several source rows per code; the first in source order stays, absent columns become blank."""
    raw = b.read(spark, sf, "customer").select(
        (F.col("c_custkey") % 970).cast("string").alias("fund_code"),
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("short_name"),
        F.col("c_mktsegment").alias("fund_type"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("亿元")).alias("net_asset_scale"),
        "c_custkey",
    )
    return normalise.overview(raw, [F.col("c_custkey")]).select(
        "fund_code", "short_name", "fund_type", "issue_date", "asset_scale"
    )


@query(
    "p3_nav",
    f"""SELECT {b.sql_code('l_suppkey')} AS fund_code, CAST(l_shipdate AS DATE) AS nav_date,
               {sql_r6('1e0 + floor(l_extendedprice) / 1e6')} AS unit_nav,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE {sql_r6('round(l_discount * 100)')} END AS daily_growth
        FROM lineitem WHERE l_linenumber NOT IN (2, 6)""",
)
def p3(spark, sf):
    return rounded(normalise.nav(b.raw_nav(spark, sf)), "unit_nav", "daily_growth")


@query(
    "p4_bonus",
    """SELECT fund_code, strftime(ex_date, '%Y') AS year, ex_date - 1 AS record_date, ex_date,
              per_share_text, ex_date + 2 AS pay_date FROM bonus""",
)
def p4(spark, sf):
    raw = b.bonus(spark, sf)
    dates = ("record_date", "ex_date", "pay_date")
    return normalise.bonus(raw.withColumns({d: F.date_format(d, "yyyy-MM-dd") for d in dates}))


@query(
    "p5_split",
    """SELECT fund_code, strftime(split_date, '%Y') AS year, split_date, '份额折算' AS split_type, ratio_text
       FROM split""",
)
def p5(spark, sf):
    raw = b.split(spark, sf)
    return normalise.split(raw.withColumn("split_date", F.date_format("split_date", "yyyy/MM/dd")))


@query("p6_personnel", "SELECT fund_code, title, fund_name, notice_date, report_id FROM personnel")
def p6(spark, sf):
    return normalise.personnel(b.raw_personnel(spark, sf))


@query(
    "p7_cum_return",
    """SELECT fund_code, date, round(cum_return_pct, 4) + 0e0 AS cum_return_pct FROM cum_return
       WHERE day(date) <> 13""",
)
def p7(spark, sf):
    text = F.format_string("%.4f", F.col("cum_return_pct"))
    raw = b.cum_return(spark, sf).select(
        "fund_code",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.when(F.dayofmonth("date") != 13, text).otherwise("--").alias("cum_return_pct"),
    )
    typed = normalise.cum_return(raw)
    return typed.withColumn("cum_return_pct", F.round("cum_return_pct", 4) + F.lit(0.0))


TABLES["dim_base"] = f"""
SELECT 'v1' AS data_version, DATE '{AS_OF}' AS as_of_date, p.fund_code AS fund_code,
       coalesce(o.short_name, p.short_name) AS fund_name, o.full_name AS fund_full_name, o.fund_type AS fund_type,
       o.inception_date AS inception_date, date_diff('day', o.inception_date, DATE '{AS_OF}') / 365.25::DOUBLE AS inception_years,
       o.scale_billion AS scale_billion, p.subscribe_status AS subscribe_status, p.redeem_status AS redeem_status,
       CASE p.next_open_day WHEN '2002-03-04' THEN DATE '2002-03-04' WHEN '2002/03/05' THEN DATE '2002-03-05'
            WHEN '2002年3月6日' THEN DATE '2002-03-06' END AS next_open_day,
       CASE WHEN p.purchase_min_amount = '10' THEN 10e0 ELSE 1e0 END AS purchase_min_amount,
       least(CAST(p.daily_limit_amount AS DOUBLE), 99999999999999.99::DOUBLE) AS daily_limit_amount,
       o.management_fee_rate AS management_fee_rate, o.custodian_fee_rate AS custodian_fee_rate,
       o.sales_service_fee_rate AS sales_service_fee_rate, o.max_subscribe_fee_rate AS max_subscribe_fee_rate,
       CAST(replace(p.purchase_fee, '%', '') AS DOUBLE) / 100e0 AS purchase_fee_rate,
       'fund_overview.最高认购费率' AS fee_source_max_subscribe, 'fund_purchase.手续费' AS fee_source_purchase,
       DATE '{AS_OF}' AS last_updated_date, n.last_day AS last_personnel_change_date
FROM purchase p JOIN overview o ON o.fund_code = p.fund_code
LEFT JOIN (SELECT fund_code, max(notice_date) AS last_day FROM personnel GROUP BY 1) n ON n.fund_code = p.fund_code"""

DIM_NUMBERS = (
    "inception_years", "management_fee_rate", "custodian_fee_rate", "sales_service_fee_rate",
    "max_subscribe_fee_rate", "purchase_fee_rate",
)


def dim(spark, sf):
    latest = normalise.latest_personnel_date(normalise.personnel(b.raw_personnel(spark, sf)))
    return normalise.dim_base(b.purchase(spark, sf), b.overview(spark, sf), latest, "v1", AS_OF)


@query(
    "p8_dim_base",
    "SELECT * REPLACE (" + ", ".join(f"{sql_r6(n)} AS {n}" for n in DIM_NUMBERS) + ") FROM dim_base",
)
def p8(spark, sf):
    return rounded(dim(spark, sf), *DIM_NUMBERS)


SQL_STYLE = {
    "raw": "{0}",
    "date": "strftime({0}, '%Y-%m-%d')",
    "int": "CAST(printf('%.0f', {0}) AS BIGINT)",
    "round2": "CAST(printf('%.2f', {0}) AS DOUBLE) + 0e0",
    "percent2": "CAST(printf('%.2f', {0} * 100e0) AS DOUBLE) + 0e0",
    "percent0": "CAST(printf('%.0f', {0} * 100e0) AS BIGINT)",
}


def sql_export(columns):
    """Export columns of the given names; printf rounds half-even on the exact value."""
    parts = []
    for name, header, style in scoreboard.EXPORT:
        shown = SQL_STYLE[style].format(name)
        if name not in columns:
            shown = "NULL"
        elif style != "raw":
            shown = f"CASE WHEN {name} IS NULL THEN NULL ELSE {shown} END"
        parts.append(f'{shown} AS "{header}"')
    return ", ".join(parts)


_DIM_COLUMNS = (
    "fund_code", "fund_name", "scale_billion", "inception_years", "fund_type", "subscribe_status", "redeem_status",
    "next_open_day", "purchase_min_amount", "daily_limit_amount", "management_fee_rate", "custodian_fee_rate",
    "sales_service_fee_rate", "max_subscribe_fee_rate", "fee_source_max_subscribe", "purchase_fee_rate",
    "fee_source_purchase", "last_updated_date", "last_personnel_change_date",
)
_DIM_HEADERS = [header for name, header, _ in scoreboard.EXPORT if name in _DIM_COLUMNS]


@query(
    "p9_export",
    "SELECT "
    + ", ".join(f'"{h}"' for h in _DIM_HEADERS)
    + f", 54 AS exported_columns FROM (SELECT {sql_export(_DIM_COLUMNS)} FROM dim_base)",
)
def p9(spark, sf):
    """The dimension's part of the export; the metric columns are absent here, so null."""
    shown = scoreboard.export(dim(spark, sf))
    metric_headers = [header for _, header, _ in scoreboard.RECHECK_FIELDS]
    empty = F.coalesce(*[F.col(f"`{h}`").cast("string") for h in metric_headers]).isNull()
    columns = F.when(empty, F.lit(len(shown.columns)))
    keep = [
        (F.col(f"`{h}`") + F.lit(0.0)).alias(h) if dict(shown.dtypes)[h] == "double" else F.col(f"`{h}`")
        for h in _DIM_HEADERS
    ]
    return shown.select(*keep, columns.alias("exported_columns"))


@query(
    "p10_version_tags",
    f"""SELECT 'v9' AS data_version, DATE '{AS_OF}' AS as_of_date, fund_code, nav_date, {sql_r6('unit_nav')} AS unit_nav
        FROM nav""",
)
def p10(spark, sf):
    return rounded(normalise.tagged(b.nav(spark, sf), "v9", AS_OF), "unit_nav")


CUT = "1999-12-31"


@query(
    "f1_truncated_history",
    f"""SELECT fund_code, nav_date AS day, 'nav' AS kind FROM nav WHERE nav_date <= DATE '{CUT}'
        UNION ALL SELECT fund_code, notice_date, 'notice' FROM personnel WHERE notice_date <= DATE '2024-01-15'""",
)
def f1(spark, sf):
    notices = normalise.personnel(b.raw_personnel(spark, sf))
    kept = metrics.up_to(b.nav(spark, sf), CUT).select(
        "fund_code", F.col("nav_date").alias("day"), F.lit("nav").alias("kind")
    )
    return kept.unionByName(
        metrics.up_to(notices, "2024-01-15", "notice_date").select(
            "fund_code", F.col("notice_date").alias("day"), F.lit("notice").alias("kind")
        )
    )


@query(
    "f2_stale_funds",
    """SELECT fund_code, max(nav_date) AS end_date, date_diff('day', max(nav_date), DATE '2001-10-31') > 2 AS stale
       FROM nav WHERE nav_date <= DATE '2001-10-31' GROUP BY 1""",
)
def f2(spark, sf):
    series = metrics.up_to(b.nav(spark, sf), "2001-10-31")
    return metrics.with_freshness(series, "2001-10-31").select("fund_code", "end_date", "stale").distinct()


@query(
    "f3_trailing_years",
    f"""SELECT n.fund_code AS fund_code, years, nav_date, {sql_r6('unit_nav')} AS adjusted_nav
        FROM nav n JOIN (SELECT fund_code, max(nav_date) AS e FROM nav GROUP BY 1) x ON x.fund_code = n.fund_code,
             (VALUES (1), (3)) AS y(years)
        WHERE nav_date >= CAST(e - to_years(years) AS DATE)""",
)
def f3(spark, sf):
    series = b.nav(spark, sf).withColumnRenamed("unit_nav", "adjusted_nav")
    parts = [
        metrics.trailing_window(series, years).select(
            "fund_code", F.lit(years).alias("years"), "nav_date", r6("adjusted_nav").alias("adjusted_nav")
        )
        for years in (1, 3)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "f4_last_full_month",
    """SELECT n.fund_code AS fund_code, nav_date FROM nav n
       JOIN (SELECT fund_code, max(nav_date) AS e FROM nav GROUP BY 1) x ON x.fund_code = n.fund_code
       WHERE nav_date >= CAST(date_trunc('month', e) - INTERVAL 1 MONTH AS DATE)
         AND nav_date < CAST(date_trunc('month', e) AS DATE)""",
)
def f4(spark, sf):
    series = b.nav(spark, sf).withColumnRenamed("unit_nav", "adjusted_nav")
    return metrics.last_full_month(series).select("fund_code", "nav_date")


@query(
    "f5_eligible_funds",
    """SELECT fund_code FROM overview WHERE inception_date IS NULL OR inception_date <= DATE '1996-01-01'""",
)
def f5(spark, sf):
    return integrity.eligible_funds(b.overview(spark, sf), "1996-01-01")


@query(
    "f6_status_exclusion",
    """SELECT fund_code FROM purchase
       WHERE (subscribe_status NOT IN ('暂停申购', '限大额') OR subscribe_status IS NULL)
         AND (redeem_status NOT IN ('暂停赎回') OR redeem_status IS NULL)""",
)
def f6(spark, sf):
    rows = normalise.purchase(b.purchase(spark, sf))
    open_funds = backtest.status_filter(rows, "subscribe_status", ["暂停申购", "限大额"])
    return backtest.status_filter(open_funds, "redeem_status", ["暂停赎回"]).select("fund_code")


@query(
    "f7_user_predicate",
    """SELECT data_version, fund_code, row_number() OVER (PARTITION BY data_version
              ORDER BY annual_return DESC NULLS LAST, fund_code ASC) AS place
       FROM board_versions WHERE annual_return > 0 AND fund_code LIKE '%5'
       UNION ALL SELECT 'all', fund_code, 0 FROM board_versions WHERE data_version = 'v1'""",
)
def f7(spark, sf):
    board = b.board_versions(spark, sf)
    chosen = board.where(backtest.user_condition("annual_return > 0 and fund_code like '%5'"))
    order = backtest.order_terms("annual_return DESC, fund_code ASC")
    place = F.expr(f"row_number() over (partition by data_version order by {order})").cast("long")
    ranked = chosen.select("data_version", "fund_code", place.alias("place"))
    everything = board.where("data_version = 'v1'").where(backtest.user_condition("1"))
    return ranked.unionByName(
        everything.select(F.lit("all").alias("data_version"), "fund_code", F.lit(0).cast("long").alias("place"))
    )


TABLES["missing_events"] = """
SELECT DISTINCT b.fund_code AS fund_code, b.ex_date AS event_date FROM bonus_mixed b
WHERE NOT EXISTS (SELECT 1 FROM nav n WHERE n.fund_code = b.fund_code AND n.nav_date = b.ex_date)"""


@query(
    "f8_tolerated_missing_events",
    """SELECT fund_code, count(*) AS missing_dividend_days, 0::BIGINT AS missing_split_days,
              max(event_date) <= DATE '1996-12-31' AS tolerated
       FROM missing_events GROUP BY 1""",
)
def f8(spark, sf):
    return adjusted_nav.tolerated_events(
        b.nav(spark, sf), b.bonus_mixed(spark, sf), b.split(spark, sf), "1996-12-31"
    )
