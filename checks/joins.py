"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.catalog import TABLES, query, r6, rounded, sql_r6
from checks.metric_sql import define_metrics
from checks.projections import AS_OF, dim
from navloom.functions.text import fund_code
from navloom.operators import adjusted_nav, backtest, candidates, consistency, integrity, metrics, normalise, scoreboard
from navloom.session import written

STALE_DAYS = 60
TABLES["unit_source"] = "SELECT fund_code, nav_date, unit_nav AS adjusted_nav FROM nav"
define_metrics("unit", "unit_source", AS_OF, STALE_DAYS)
define_metrics("fresh", "unit_source", AS_OF, 100000)


def unit_series(spark, sf):
    """Unit NAV taken as the adjusted series: enough wherever adjusting is not the point."""
    return b.nav(spark, sf).withColumnRenamed("unit_nav", "adjusted_nav")


def unit_metrics(spark, sf):
    return metrics.metric_snapshot(unit_series(spark, sf), AS_OF, STALE_DAYS)


@query(
    "d1_purchase_with_overview",
    """SELECT p.fund_code AS fund_code, coalesce(o.short_name, p.short_name) AS fund_name, full_name, redeem_status
       FROM purchase p JOIN overview o ON o.fund_code = p.fund_code""",
)
def d1(spark, sf):
    joined = normalise.listed_with_overview(b.purchase(spark, sf), b.overview(spark, sf))
    return joined.select("fund_code", "fund_name", "full_name", "redeem_status")


@query(
    "d2_latest_personnel_date",
    """SELECT p.fund_code AS fund_code, max(notice_date) AS last_personnel_change_date
       FROM purchase p LEFT JOIN personnel n ON n.fund_code = p.fund_code AND notice_date <= DATE '2024-01-20' GROUP BY 1""",
)
def d2(spark, sf):
    notices = normalise.personnel(b.raw_personnel(spark, sf))
    funds = normalise.purchase(b.purchase(spark, sf)).select("fund_code")
    return funds.join(normalise.latest_personnel_date(notices, "2024-01-20"), "fund_code", "left")


@query(
    "d3_metrics_with_dim",
    f"""SELECT m.fund_code AS fund_code, d.fund_name AS fund_name, {sql_r6('m.annual_return')} AS annual_return
        FROM unit_metrics m JOIN dim_base d ON d.fund_code = m.fund_code WHERE NOT m.stale""",
)
def d3(spark, sf):
    joined = scoreboard.metrics_with_dim(unit_metrics(spark, sf), dim(spark, sf))
    return joined.select("fund_code", "fund_name", r6("annual_return").alias("annual_return"))


@query(
    "d4_dim_without_metrics",
    """SELECT fund_code, fund_name FROM dim_base
       WHERE fund_code NOT IN (SELECT fund_code FROM unit_metrics WHERE NOT stale)""",
)
def d4(spark, sf):
    return scoreboard.without_metrics(dim(spark, sf), unit_metrics(spark, sf)).select("fund_code", "fund_name")


@query(
    "d5_blacklist_removal",
    """SELECT fund_code, short_name, (SELECT count(*) FROM purchase) AS original_count,
              (SELECT count(*) FROM purchase WHERE fund_code IN (SELECT fund_code FROM blacklist)) AS blacklist_removed,
              (SELECT count(*) FROM purchase WHERE fund_code NOT IN (SELECT fund_code FROM blacklist)) AS effective_count
       FROM purchase WHERE fund_code NOT IN (SELECT fund_code FROM blacklist)""",
)
def d5(spark, sf):
    result = candidates.effective_purchase(b.purchase(spark, sf), b.blacklist(spark, sf))
    counts = result.counts.select(F.struct("*").alias("c")).scalar()
    names = ("original_count", "blacklist_removed", "effective_count")
    return result.purchase.select("fund_code", "short_name", *[counts.getField(n).alias(n) for n in names])


@query(
    "d6_unfiltered_purchase",
    "SELECT fund_code, short_name FROM purchase WHERE fund_code IN (SELECT fund_code FROM overview WHERE inception_date IS NULL)",
)
def d6(spark, sf):
    undated = F.col("inception_text") != "---"
    judged = b.overview(spark, sf).select("fund_code", undated.alias("is_filtered"))
    return candidates.filtered_purchase(b.purchase(spark, sf), judged).select("fund_code", "short_name")


@query(
    "d7_work_list",
    "SELECT fund_code FROM purchase WHERE fund_code NOT IN (SELECT fund_code FROM overview)",
)
def d7(spark, sf):
    return candidates.work_list(b.purchase(spark, sf), b.overview(spark, sf))


@query(
    "d8_retry_list",
    f"""SELECT fund_code FROM purchase WHERE fund_code IN (
          SELECT {b.sql_code('code')} FROM failure_log WHERE stage = 'step3_nav')""",
)
def d8(spark, sf):
    return candidates.retry_list(b.purchase(spark, sf), b.failure_log(spark, sf), "step3_nav")


@query(
    "d9_events_without_nav",
    "SELECT fund_code, event_date, 'dividend' AS kind FROM missing_events",
)
def d9(spark, sf):
    return adjusted_nav.missing_event_days(b.nav(spark, sf), b.bonus_mixed(spark, sf), b.split(spark, sf))


@query(
    "d10_both_sides_by_day",
    f"""SELECT coalesce(n.fund_code, c.fund_code) AS fund_code, coalesce(n.nav_date, c.date) AS date,
               {sql_r6('n.unit_nav')} AS local, {sql_r6('c.cum_return_pct')} AS remote
        FROM (SELECT * FROM nav WHERE day(nav_date) <> 7) n
        FULL OUTER JOIN cum_return c ON c.fund_code = n.fund_code AND c.date = n.nav_date""",
)
def d10(spark, sf):
    local = unit_series(spark, sf).where(F.dayofmonth("nav_date") != 7)
    return rounded(consistency.both_sides(local, b.cum_return(spark, sf)), "local", "remote")


@query(
    "d11_fund_day_grid",
    """SELECT o.fund_code AS fund_code, c.trade_date AS trade_date, n.nav_date IS NOT NULL AS "exists"
       FROM (SELECT fund_code FROM overview WHERE (inception_date IS NULL OR inception_date <= DATE '1996-01-01')
               AND fund_code IN (SELECT fund_code FROM nav)) o
       JOIN calendar c ON c.trade_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
       LEFT JOIN nav n ON n.fund_code = o.fund_code AND n.nav_date = c.trade_date""",
)
def d11(spark, sf):
    return integrity.detail(
        b.nav(spark, sf), b.overview(spark, sf), b.calendar(spark, sf), "1996-01-01", "1996-12-31"
    )


@query(
    "d12_candidate_flags",
    """SELECT fund_code, (CASE WHEN fund_code IN (SELECT fund_code FROM overview) THEN '' ELSE 'o' END)
              || (CASE WHEN fund_code IN (SELECT fund_code FROM blacklist) THEN 'n' ELSE '' END)
              || (CASE WHEN fund_code IN (SELECT fund_code FROM nav) THEN '' ELSE 'a' END) AS broken FROM purchase""",
)
def d12(spark, sf):
    """The candidate rules with blacklisted funds taken as funds without NAV."""
    nav = unit_series(spark, sf)
    nav_codes = nav.join(b.blacklist(spark, sf), "fund_code", "left_anti")
    details = consistency.detail(nav, b.cum_return(spark, sf))
    days = nav.select("fund_code", F.col("nav_date").alias("trade_date"), F.lit(True).alias("exists"))
    judged = candidates.filter_candidates(
        b.purchase(spark, sf), b.overview(spark, sf), nav_codes, nav, details, days
    )
    flags = [("规则1", "o"), ("规则2", "n"), ("规则3", "a")]
    broken = [F.when(F.col("reasons").contains(rule), F.lit(flag)) for rule, flag in flags]
    return judged.select("fund_code", F.concat_ws("", *broken).alias("broken"))


@query(
    "d13_scoreboard_with_recalculation",
    f"""SELECT d.fund_code AS fund_code, {sql_r6('m.annual_return')} AS annual_return,
               {sql_r6('m.max_drawdown_recovery_days_1y')} AS max_drawdown_recovery_days_1y
        FROM dim_base d LEFT JOIN fresh_metrics m ON m.fund_code = d.fund_code""",
)
def d13(spark, sf):
    """Left join of the listed funds with metrics recomputed whatever their age."""
    board = dim(spark, sf).select(
        "fund_code", *[F.lit(None).cast("double").alias(n) for n in metrics.METRICS]
    )
    result = scoreboard.recheck(board, unit_series(spark, sf), max_rows=None)
    return rounded(
        result.recalculated.select("fund_code", "annual_return", "max_drawdown_recovery_days_1y"),
        "annual_return",
        "max_drawdown_recovery_days_1y",
    )


RULES = backtest.Rules(
    start="1998-03-10", end="2001-12-31", rebalance_days=45, holding_days=120, limit=20,
    exclude_subscribe=("暂停申购",),
)

TABLES["anchors"] = f"""
SELECT CAST(row_number() OVER (ORDER BY d1) AS INTEGER) AS window_id, CAST(d1 AS DATE) AS d1
FROM generate_series(DATE '{RULES.start}', DATE '{RULES.end}', INTERVAL {RULES.rebalance_days} DAY) AS g(d1)"""
TABLES["windows_sql"] = f"""
SELECT window_id, d1, d2, d3, d4, CAST(date_diff('day', d3, d4) AS INTEGER) AS calendar_holding_days,
       (SELECT count(*) FROM month_calendar WHERE trade_date BETWEEN d3 AND d4) AS trading_holding_days
FROM (SELECT *, (SELECT min(trade_date) FROM month_calendar WHERE trade_date >= d3 + {RULES.holding_days}) AS d4
      FROM (SELECT *, (SELECT min(trade_date) FROM month_calendar WHERE trade_date > d2) AS d3
            FROM (SELECT *, (SELECT min(trade_date) FROM month_calendar WHERE trade_date >= d1) AS d2 FROM anchors)))
WHERE d4 IS NOT NULL"""


def planned(spark, sf):
    days = backtest.windows(spark, b.month_calendar(spark, sf), RULES)
    return days.withColumn("trading_holding_days", F.col("trading_holding_days").cast("long"))


TABLES["window_versions"] = """
SELECT w.window_id AS window_id, w.d2 AS d2, v.data_version AS data_version
FROM windows_sql w ASOF LEFT JOIN (SELECT data_version, max(as_of_date) AS as_of_date FROM board_versions GROUP BY 1) v
  ON w.d2 >= v.as_of_date"""


@query(
    "d14_version_as_of",
    """SELECT window_id, d2, data_version,
              CASE WHEN data_version IS NULL THEN 'no_data_version_before_d2' END AS skip_reason FROM window_versions""",
)
def d14(spark, sf):
    versions = backtest.version_dates(b.board_versions(spark, sf))
    return backtest.with_versions(planned(spark, sf), versions).select(
        "window_id", "d2", "data_version", "skip_reason"
    )


@query("d15_next_trade_days", "SELECT window_id, d1, d2, d3, d4 FROM windows_sql")
def d15(spark, sf):
    return planned(spark, sf).select("window_id", "d1", "d2", "d3", "d4")


TABLES["selection_sql"] = f"""
SELECT data_version, fund_code, 1e0 / count(*) OVER (PARTITION BY data_version) AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY data_version ORDER BY annual_return DESC, fund_code ASC) AS place
  FROM board_versions WHERE subscribe_status <> '暂停申购' OR subscribe_status IS NULL) WHERE place <= {RULES.limit}"""
TABLES["paths_sql"] = """
SELECT w.window_id AS window_id, s.fund_code AS fund_code, s.weight AS weight, c.trade_date AS nav_date, w.d3 AS d3, w.d4 AS d4,
       n.adjusted_nav AS adjusted_nav
FROM windows_sql w JOIN window_versions v ON v.window_id = w.window_id
JOIN selection_sql s ON s.data_version = v.data_version
JOIN month_calendar c ON c.trade_date BETWEEN w.d3 AND w.d4
LEFT JOIN (SELECT * FROM nav_versions WHERE data_version = 'n2') n ON n.fund_code = s.fund_code AND n.nav_date = c.trade_date"""


@query(
    "d16_position_paths",
    f"""SELECT window_id, fund_code, nav_date, {sql_r6('weight')} AS weight, {sql_r6('adjusted_nav')} AS adjusted_nav
        FROM paths_sql""",
)
def d16(spark, sf):
    board = written(b.board_versions(spark, sf), "board")
    calendar = written(b.month_calendar(spark, sf), "calendar")
    versioned = backtest.with_versions(backtest.windows(spark, calendar, RULES), backtest.version_dates(board))
    versioned, selections = written(versioned, "windows"), written(backtest.selection(board, RULES), "selections")
    stored = b.nav_versions(spark, sf)
    nav = stored.where(F.col("data_version") == backtest.latest_version(stored).first().data_version)
    paths = backtest.position_paths(versioned.where("skip_reason is null"), selections, calendar, nav)
    return rounded(paths.select("window_id", "fund_code", "nav_date", "weight", "adjusted_nav"), "weight", "adjusted_nav")


@query(
    "u1_union_of_codes",
    "SELECT fund_code FROM nav WHERE unit_nav > 1.1::DOUBLE UNION SELECT fund_code FROM blacklist",
)
def u1(spark, sf):
    high = b.nav(spark, sf).where("unit_nav > 1.1").select("fund_code")
    return high.union(b.blacklist(spark, sf)).distinct()


@query(
    "u2_common_and_one_sided_days",
    """SELECT fund_code, count(*) FILTER (WHERE l AND r) AS common, count(*) FILTER (WHERE l AND NOT r) AS local_only,
              count(*) FILTER (WHERE r AND NOT l) AS remote_only
       FROM (SELECT fund_code, d, bool_or(side = 'l') AS l, bool_or(side = 'r') AS r FROM (
               SELECT fund_code, nav_date AS d, 'l' AS side FROM nav WHERE day(nav_date) <> 7
               UNION ALL SELECT fund_code, date, 'r' FROM cum_return) GROUP BY 1, 2) GROUP BY 1""",
)
def u2(spark, sf):
    local = unit_series(spark, sf).where(F.dayofmonth("nav_date") != 7)
    days = consistency.both_sides(local, b.cum_return(spark, sf))
    has_local, has_remote = F.col("local").isNotNull(), F.col("remote").isNotNull()
    return days.groupBy("fund_code").agg(
        F.count_if(has_local & has_remote).alias("common"),
        F.count_if(has_local & ~has_remote).alias("local_only"),
        F.count_if(has_remote & ~has_local).alias("remote_only"),
    )


TABLES["exclusions_sql"] = """
SELECT fund_code, 'stale_nav_date' AS reason_code, 'latest nav date older than as_of_date-2' AS reason_detail
FROM unit_metrics WHERE stale
UNION ALL
SELECT fund_code, 'missing_nav', 'no adjusted nav data' FROM dim_base
WHERE fund_code NOT IN (SELECT fund_code FROM unit_metrics WHERE NOT stale)
UNION ALL
SELECT fund_code, 'metric_null', names FROM (
  SELECT m.fund_code AS fund_code, concat_ws(', ', {cases}) AS names
  FROM unit_metrics m JOIN dim_base d ON d.fund_code = m.fund_code WHERE NOT m.stale) WHERE names <> ''""".format(
    cases=", ".join(f"CASE WHEN m.{n} IS NULL THEN '{n}' END" for n in sorted(metrics.METRICS))
)


@query("u3_union_of_exclusions", "SELECT fund_code, reason_code, reason_detail FROM exclusions_sql")
def u3(spark, sf):
    assessed = scoreboard.assess(unit_metrics(spark, sf), dim(spark, sf), "v1", AS_OF)
    return scoreboard.exclusion_detail(assessed).select("fund_code", "reason_code", "reason_detail")


@query(
    "u4_code_difference_and_intersection",
    """SELECT fund_code, fund_code IN (SELECT fund_code FROM overview) AS known FROM purchase
       WHERE fund_code IN (SELECT fund_code FROM blacklist) OR fund_code NOT IN (SELECT fund_code FROM overview)""",
)
def u4(spark, sf):
    listed = normalise.purchase(b.purchase(spark, sf)).select("fund_code")
    known = b.overview(spark, sf).select(fund_code(F.col("fund_code")).alias("fund_code"))
    black = b.blacklist(spark, sf)
    both = listed.join(black, "fund_code", "left_semi").join(known, "fund_code", "left_semi")
    unknown = listed.join(known, "fund_code", "left_anti")
    return both.withColumn("known", F.lit(True)).unionByName(unknown.withColumn("known", F.lit(False)))


@query(
    "f9_complete_metrics_only",
    f"""SELECT fund_code, {sql_r6('annual_return')} AS annual_return FROM unit_metrics
        WHERE NOT stale AND {" AND ".join(f"{n} IS NOT NULL" for n in metrics.METRICS)}""",
)
def f9(spark, sf):
    fresh = unit_metrics(spark, sf).where(~F.col("stale"))
    return rounded(scoreboard.complete_only(fresh).select("fund_code", "annual_return"), "annual_return")
