"""What a user calls: the composed domain operators end to end."""

from __future__ import annotations

import functools
import re
from dataclasses import replace

from pyspark.sql import functions as F

from checks import bindings as b
from checks.aggregates import SHARES, SQL_SHARES, adjusted_metrics, backtested
from checks.catalog import TABLES, query, rounded, sql_r6
from checks.joins import RULES, STALE_DAYS, planned, unit_metrics, unit_series
from checks.metric_sql import ROUNDED_METRICS, define_metrics
from checks.projections import AS_OF, DIM_NUMBERS, SQL_STYLE, dim, sql_export
from navloom.operators import (
    adjusted_nav,
    backtest,
    candidates,
    consistency,
    contracts,
    integrity,
    metrics,
    month_states,
    normalise,
    score,
    scoreboard,
)
from navloom.plans import runs
from navloom.session import new_folder, written
from navloom.sinks import tables as sinks
from navloom.sources import files

CUTOFF = "1996-12-31"


@query(
    "a1_adjusted_nav",
    f"""SELECT fund_code, nav_date, {sql_r6('unit_nav')} AS unit_nav, {sql_r6('adjusted_nav')} AS adjusted_nav,
               {sql_r6('cumulative_factor')} AS cumulative_factor FROM adjusted""",
)
def a1(spark, sf):
    return rounded(b.adjusted(spark, sf), "unit_nav", "adjusted_nav", "cumulative_factor")


TABLES["rejected_sql"] = f"""
SELECT fund_code, 'missing bonus files' AS error FROM nav WHERE fund_code IN (SELECT fund_code FROM blacklist) GROUP BY 1
UNION ALL
SELECT fund_code, 'missing nav data on dividend dates: ' || string_agg(strftime(event_date, '%Y-%m-%d'), ',' ORDER BY event_date)
FROM missing_events WHERE fund_code NOT IN (SELECT fund_code FROM blacklist)
GROUP BY 1 HAVING max(event_date) > DATE '{CUTOFF}'"""
TABLES["mixed_factor"] = """
SELECT fund_code, nav_date, product(factor) AS factor FROM (
  SELECT n.fund_code, n.nav_date,
         (n.unit_nav + CAST(regexp_extract(b.per_share_text, '[0-9]+(?:\\.[0-9]+)?') AS DOUBLE)) / n.unit_nav AS factor
  FROM nav n JOIN bonus_mixed b ON b.fund_code = n.fund_code AND b.ex_date = n.nav_date
  UNION ALL
  SELECT n.fund_code, n.nav_date, CAST(split_part(s.ratio_text, ':', 2) AS DOUBLE)
  FROM nav n JOIN split s ON s.fund_code = n.fund_code AND s.split_date = n.nav_date
) GROUP BY 1, 2"""
TABLES["mixed_adjusted"] = """
SELECT n.fund_code AS fund_code, n.nav_date AS nav_date, n.unit_nav AS unit_nav,
       product(coalesce(f.factor, 1e0)) OVER (PARTITION BY n.fund_code ORDER BY n.nav_date
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_factor
FROM nav n LEFT JOIN mixed_factor f ON f.fund_code = n.fund_code AND f.nav_date = n.nav_date
WHERE n.fund_code NOT IN (SELECT fund_code FROM rejected_sql)"""


def adjusted_run(spark, sf):
    """All funds; blacklisted ones have no bonus data, some have dividends off their NAV days."""
    nav = b.nav(spark, sf)
    landed = nav.select("fund_code").join(b.blacklist(spark, sf), "fund_code", "left_anti")
    return adjusted_nav.adjust_all(
        nav,
        b.bonus_mixed(spark, sf),
        b.split(spark, sf),
        bonus_codes=landed,
        allow_missing_until=CUTOFF,
    )


@query(
    "a2_adjusted_nav_all_funds",
    f"""SELECT fund_code, nav_date, {sql_r6('unit_nav * cumulative_factor')} AS adjusted_nav,
               {sql_r6('cumulative_factor')} AS cumulative_factor FROM mixed_adjusted""",
)
def a2(spark, sf):
    adjusted = adjusted_run(spark, sf).adjusted.select(
        "fund_code", "nav_date", "adjusted_nav", "cumulative_factor"
    )
    return rounded(adjusted, "adjusted_nav", "cumulative_factor")


@query("a2_rejected_funds", "SELECT fund_code, 'adjusted_nav' AS stage, error FROM rejected_sql")
def a2_rejects(spark, sf):
    return adjusted_run(spark, sf).rejects


@query(
    "a3_return_comparison_detail",
    f"""SELECT fund_code, d AS start_date, e AS end_date, {sql_r6('l')} AS local_start, {sql_r6('le')} AS local_end,
               {sql_r6('r')} AS remote_start, {sql_r6('re')} AS remote_end, {sql_r6('lr')} AS local_return,
               {sql_r6('rr')} AS remote_return, {sql_r6('dev')} AS deviation, bucket
        FROM deviations_sql WHERE common AND d < e""",
)
def a3(spark, sf):
    detail = consistency.detail(b.adjusted(spark, sf), b.cum_return(spark, sf))
    numbers = [n for n, kind in detail.dtypes if kind == "double"]
    return rounded(detail, *numbers)


@query(
    "a3_return_comparison_errors",
    """SELECT fund_code, 'compare_adjusted_nav_cum_return' AS stage, 'fund file missing: adjusted_nav_missing' AS error
       FROM cum_return WHERE fund_code IN (SELECT fund_code FROM blacklist) GROUP BY 1
       UNION ALL SELECT fund_code, 'compare_adjusted_nav_cum_return', 'fund file missing: cum_return_missing'
       FROM nav WHERE fund_code LIKE '%7' AND fund_code NOT IN (SELECT fund_code FROM blacklist) GROUP BY 1""",
)
def a3_errors(spark, sf):
    local = unit_series(spark, sf).join(b.blacklist(spark, sf), "fund_code", "left_anti")
    remote = b.cum_return(spark, sf).where("fund_code not like '%7'")
    return consistency.compare(local, remote).errors


@query("a3_return_comparison_summary", f"SELECT *, {SQL_SHARES} FROM compare_summary_sql")
def a3_summary(spark, sf):
    return rounded(consistency.compare(b.adjusted(spark, sf), b.cum_return(spark, sf)).summary, *SHARES)


@query(
    "a4_trade_day_integrity",
    """SELECT r.fund_code AS fund_code, printf('%.6f', ratio) AS ratio, CASE WHEN n.nav_date IS NULL THEN '否' ELSE '是' END AS "exists",
              strftime(c.trade_date, '%Y-%m-%d') AS trade_date
       FROM ratio_sql r JOIN calendar c ON c.trade_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
       LEFT JOIN nav n ON n.fund_code = r.fund_code AND n.nav_date = c.trade_date""",
)
def a4(spark, sf):
    args = (b.nav(spark, sf), b.overview(spark, sf), b.calendar(spark, sf), "1996-01-01", "1999-12-31")
    shares = integrity.summary_text(integrity.summary(*args))
    days = integrity.detail_text(integrity.detail(*args))
    headers = integrity.SUMMARY_HEADERS, integrity.DETAIL_HEADERS
    shares = shares.select(F.col(headers[0]["fund_code"]).alias("fund_code"), F.col(headers[0]["ratio"]).alias("ratio"))
    return days.join(shares, "fund_code").select(
        "fund_code",
        "ratio",
        F.col(headers[1]["exists"]).alias("exists"),
        F.col(headers[1]["trade_date"]).alias("trade_date"),
    )


A5_START, A5_LIMIT = "2001-06-01", 0.5


@query(
    "a5_candidate_filter",
    f"""SELECT fund_code, reasons <> '' AS is_filtered, reasons FROM (
          SELECT p.fund_code AS fund_code, concat_ws('；',
            CASE WHEN p.fund_code NOT IN (SELECT fund_code FROM overview) THEN '规则1: fund_overview.csv 中不存在该基金' END,
            CASE WHEN p.fund_code NOT IN (SELECT fund_code FROM nav) THEN '规则2: fund_nav_by_code 中不存在该基金' END,
            CASE WHEN p.fund_code NOT IN (SELECT fund_code FROM mixed_adjusted) THEN '规则3: fund_adjusted_nav_by_code 中不存在该基金' END,
            CASE WHEN c.n IS NULL THEN '规则4: compare details 缺失或无比对记录'
                 WHEN c.n = 0 THEN '规则4: 指定日期后无任何比对记录'
                 WHEN c.bad THEN '规则4: 指定日期后存在偏差>=50.00%' END,
            CASE WHEN i.ok IS NULL THEN '规则5: trade day integrity details 缺失'
                 WHEN NOT i.ok THEN '规则5: 指定日期后存在交易日数据不完整' END) AS reasons
          FROM purchase p
          LEFT JOIN (SELECT fund_code, count(*) FILTER (WHERE d >= DATE '{A5_START}') AS n,
                            coalesce(bool_or(round(abs(dev), 10) >= 5e-1) FILTER (WHERE d >= DATE '{A5_START}'), FALSE) AS bad
                     FROM deviations_sql WHERE common AND d < e GROUP BY 1) c ON c.fund_code = p.fund_code
          LEFT JOIN (SELECT o.fund_code AS fund_code, bool_and(m.nav_date IS NOT NULL) FILTER (WHERE t.trade_date >= DATE '{A5_START}') AS ok
                     FROM (SELECT fund_code FROM overview WHERE (inception_date IS NULL OR inception_date <= DATE '1995-06-01')
                           AND fund_code IN (SELECT fund_code FROM month_nav)) o
                     JOIN month_calendar t ON t.trade_date BETWEEN DATE '1995-06-01' AND DATE '2001-10-31'
                     LEFT JOIN month_nav m ON m.fund_code = o.fund_code AND m.nav_date = t.trade_date GROUP BY 1) i
            ON i.fund_code = p.fund_code)""",
)
def a5(spark, sf):
    months = b.month_nav(spark, sf)
    details = integrity.detail(
        months, b.overview(spark, sf), b.month_calendar(spark, sf), "1995-06-01", "2001-10-31"
    )
    return candidates.filter_candidates(
        b.purchase(spark, sf),
        b.overview(spark, sf),
        b.nav(spark, sf),
        adjusted_run(spark, sf).adjusted,
        consistency.detail(b.adjusted(spark, sf), b.cum_return(spark, sf)),
        details,
        A5_START,
        A5_LIMIT,
    )


@query(
    "a6_daily_nav_fact",
    f"""SELECT a.fund_code AS fund_code, nav_date, {sql_r6('unit_nav')} AS unit_nav, {sql_r6('adjusted_nav')} AS adjusted_nav,
               {sql_r6('adjusted_nav / lag(adjusted_nav) OVER (PARTITION BY a.fund_code ORDER BY nav_date) - 1e0')} AS daily_return,
               e0 AS latest_nav_date
        FROM adjusted a JOIN full_range r ON r.fund_code = a.fund_code WHERE NOT stale""",
)
def a6(spark, sf):
    return rounded(
        metrics.daily_facts(b.adjusted(spark, sf), AS_OF, 60), "unit_nav", "adjusted_nav", "daily_return"
    )


@query(
    "a7_period_return_fact",
    f"""SELECT fund_code, ptype AS period_type, strftime(bucket, '%Y-%m-%d') AS period_key, prev_bucket AS period_start,
               bucket AS period_end, {sql_r6('r')} AS period_return
        FROM full_returns WHERE tag = 'a' AND r IS NOT NULL""",
)
def a7(spark, sf):
    return rounded(metrics.period_facts(b.adjusted(spark, sf), AS_OF, 60), "period_return")


@query(
    "a8_metric_snapshot",
    f"SELECT fund_code, nav_start_date, nav_end_date, stale, {ROUNDED_METRICS} FROM full_metrics",
)
def a8(spark, sf):
    return rounded(adjusted_metrics(spark, sf), *metrics.METRICS)


define_metrics("past", "adjusted", "1999-12-31", 60, latest="1999-12-31")


@query(
    "a8_metric_snapshot_at_date",
    f"SELECT fund_code, nav_start_date, nav_end_date, stale, {ROUNDED_METRICS} FROM past_metrics",
)
def a8_past(spark, sf):
    past = metrics.metric_snapshot(b.adjusted(spark, sf), "1999-12-31", 60, latest="1999-12-31")
    return rounded(past, *metrics.METRICS)


@query(
    "a8_from_month_states",
    f"SELECT fund_code, nav_start_date, nav_end_date, stale, {ROUNDED_METRICS} FROM full_metrics",
)
def a8_states(spark, sf):
    adjusted = written(b.adjusted(spark, sf), "adjusted")
    states = written(month_states.month_states(adjusted), "month_states")
    return rounded(month_states.snapshot(states, adjusted, AS_OF, 60), *metrics.METRICS)


@query(
    "a8_from_month_states_at_date",
    f"SELECT fund_code, nav_start_date, nav_end_date, stale, {ROUNDED_METRICS} FROM past_metrics",
)
def a8_states_past(spark, sf):
    adjusted = written(b.adjusted(spark, sf), "adjusted")
    first = month_states.month_states(adjusted.where("nav_date < date'1998-03-10'"))
    states = written(month_states.refreshed(first, adjusted, "1998-03-10"), "month_states")
    past = month_states.snapshot(states, adjusted, "1999-12-31", 60, latest="1999-12-31")
    return rounded(past, *metrics.METRICS)


_METRIC_CODES = "SELECT fund_code FROM exclusions_sql"
_DIM_SHOWN = [
    n for n in scoreboard.SCOREBOARD_COLUMNS
    if n not in metrics.METRICS and n not in ("nav_start_date", "nav_end_date")
]


@query(
    "a9_scoreboard",
    "SELECT "
    + ", ".join(f"{sql_r6('d.' + n) if n in DIM_NUMBERS else 'd.' + n} AS {n}" for n in _DIM_SHOWN)
    + f", nav_start_date, nav_end_date, {ROUNDED_METRICS}"
    + f" FROM unit_metrics m JOIN dim_base d ON d.fund_code = m.fund_code WHERE m.fund_code NOT IN ({_METRIC_CODES})",
)
def a9(spark, sf):
    kept = scoreboard.build(unit_metrics(spark, sf), dim(spark, sf), "v1", AS_OF).kept
    return rounded(kept, *DIM_NUMBERS, *metrics.METRICS)


@query(
    "a9_exclusion_detail",
    f"""SELECT 'v1' AS data_version, DATE '{AS_OF}' AS as_of_date, fund_code, reason_code, reason_detail FROM exclusions_sql""",
)
def a9_exclusions(spark, sf):
    return scoreboard.build(unit_metrics(spark, sf), dim(spark, sf), "v1", AS_OF).exclusion_detail


@query(
    "p9_export_whole",
    f"""SELECT {sql_export([name for name, _, _ in scoreboard.EXPORT])} FROM (
          SELECT d.*, m.* EXCLUDE (fund_code) FROM unit_metrics m JOIN dim_base d ON d.fund_code = m.fund_code
          WHERE m.fund_code NOT IN ({_METRIC_CODES}))""",
)
def p9_whole(spark, sf):
    """All 54 columns of the exported scoreboard."""
    shown = scoreboard.export(scoreboard.build(unit_metrics(spark, sf), dim(spark, sf), "v1", AS_OF).kept)
    return shown.select(
        *[(F.col(f"`{n}`") + F.lit(0.0)).alias(n) if kind == "double" else F.col(f"`{n}`") for n, kind in shown.dtypes]
    )


def _displayed(name, style):
    """A metric as displayed, as a double; the oracle rounds by printf."""
    return f"CASE WHEN {name} IS NOT NULL THEN CAST({SQL_STYLE[style].format(name)} AS DOUBLE) END"


TABLES["shown_metrics"] = (
    "SELECT fund_code, "
    + ", ".join(f"{_displayed(n, style)} AS {n}" for n, _, style in scoreboard.RECHECK_FIELDS)
    + f" FROM unit_metrics WHERE fund_code IN (SELECT fund_code FROM dim_base) AND fund_code NOT IN ({_METRIC_CODES})"
)
# Every tenth fund's exported annual return is made wrong by one.
TABLES["recheck_sql"] = " UNION ALL ".join(
    f"SELECT fund_code, '{header}' AS field, "
    + (
        f"{n} + CASE WHEN fund_code LIKE '%3' THEN 1e0 ELSE 0e0 END"
        if n == "annual_return"
        else n
    )
    + f" AS old, {n} AS new FROM shown_metrics"
    for n, header, _ in scoreboard.RECHECK_FIELDS
)


def exported_board(spark, sf):
    """The scoreboard as a user has it: exported to CSV and read back as text."""
    kept = scoreboard.build(unit_metrics(spark, sf), dim(spark, sf), "v1", AS_OF).kept
    folder = new_folder(spark, "scoreboard")
    sinks.write_csv(scoreboard.export(kept), folder)
    headers = {header: name for name, header, _ in scoreboard.EXPORT}
    return files.read_table(spark, folder, headers)


def rechecked(spark, sf):
    exported = exported_board(spark, sf)
    wrong = F.when(F.col("fund_code").like("%3"), F.lit(1.0)).otherwise(F.lit(0.0))
    changed = F.col("annual_return").cast("double") + wrong
    exported = exported.withColumn("annual_return", changed.cast("string"))
    return scoreboard.recheck(exported, unit_series(spark, sf), max_rows=None)


@query(
    "a10_recheck_detail",
    f"""SELECT fund_code, field, {sql_r6('old')} AS old, {sql_r6('new')} AS new, abs(old - new) <= 1e-12 AS passed FROM recheck_sql""",
)
def a10(spark, sf):
    return rounded(rechecked(spark, sf).detail, "old", "new")


@query(
    "a10_recheck_summary",
    """SELECT fund_code, bool_and(abs(old - new) <= 1e-12) AS passed,
              coalesce(string_agg(field, ',') FILTER (WHERE abs(old - new) > 1e-12), '') AS failed_fields
       FROM recheck_sql GROUP BY 1""",
)
def a10_summary(spark, sf):
    return rechecked(spark, sf).summary


def _sql_position(name, larger_is_better):
    low, high = f"(SELECT min({name}) FROM shown_metrics)", f"(SELECT max({name}) FROM shown_metrics)"
    position = f"({name} - {low}) / ({high} - {low})"
    if not larger_is_better:
        position = f"1e0 - {position}"
    return f"coalesce(CASE WHEN {low} <> {high} THEN {position} END, 0.5::DOUBLE)"


_GROUP_SQL = {
    group: "(" + " + ".join(f"{share}::DOUBLE * {_sql_position(n, better)}" for n, share, better in inputs) + ")"
    for group, (_, inputs) in score.GROUPS.items()
}
TABLES["scores_sql"] = (
    "SELECT *, "
    + " + ".join(f"{weight}::DOUBLE * score_{group}" for group, (weight, _) in score.GROUPS.items())
    + " AS score FROM (SELECT fund_code, "
    + ", ".join(f"{text} AS score_{group}" for group, text in _GROUP_SQL.items())
    + " FROM shown_metrics)"
)
_SCORES = [f"score_{group}" for group in score.GROUPS] + ["score"]


@query(
    "a11_composite_score",
    "SELECT fund_code, "
    + ", ".join(f"{sql_r6(n)} AS {n}" for n in _SCORES)
    + ", CAST(rank() OVER (ORDER BY score DESC) AS INTEGER) AS rank FROM scores_sql",
)
def a11(spark, sf):
    scored = score.composite_score(exported_board(spark, sf))
    return rounded(scored.select("fund_code", *_SCORES, "rank"), *_SCORES)


@query("a12_backtest_windows", "SELECT * FROM windows_sql")
def a12(spark, sf):
    return planned(spark, sf)


_WINDOW_NUMBERS = (
    "weight_sum", "portfolio_return", "portfolio_nav_start", "portfolio_nav_end", "max_drawdown_in_window",
    "volatility_in_window",
)


@query(
    "a13_backtest_windows",
    "SELECT * REPLACE (" + ", ".join(f"{sql_r6(n)} AS {n}" for n in _WINDOW_NUMBERS) + ") FROM backtest_sql",
)
def a13(spark, sf):
    detail = backtested(spark, sf).windows
    detail = detail.withColumn("trading_holding_days", F.col("trading_holding_days").cast("long"))
    return rounded(detail, *_WINDOW_NUMBERS)


@query(
    "a13_backtest_positions",
    f"""SELECT window_id, fund_code, {sql_r6('weight')} AS weight, {sql_r6('buy')} AS buy_nav_at_d3,
               {sql_r6('sell')} AS sell_nav_at_d4, {sql_r6('sell / buy - 1e0')} AS fund_return,
               {sql_r6('weight * (sell / buy - 1e0)')} AS contribution FROM positions_sql""",
)
def a13_positions(spark, sf):
    held = backtested(spark, sf).positions
    return rounded(held, "weight", "buy_nav_at_d3", "sell_nav_at_d4", "fund_return", "contribution")


_STAGE_ROWS = {
    "dim_base": "SELECT count(*) FROM dim_base",
    "metrics": "SELECT count(*) FROM unit_metrics",
    "nav_daily": "SELECT count(*) FROM nav WHERE fund_code IN (SELECT fund_code FROM unit_metrics WHERE NOT stale)",
    "return_period": "SELECT count(*) FROM unit_returns WHERE tag = 'a' AND r IS NOT NULL",
    "scoreboard": f"SELECT count(*) FROM unit_metrics m JOIN dim_base d ON d.fund_code = m.fund_code WHERE m.fund_code NOT IN ({_METRIC_CODES})",
    "exclusion_detail": "SELECT count(*) FROM (SELECT DISTINCT fund_code, reason_code FROM exclusions_sql)",
    "exclusion_summary": "SELECT count(DISTINCT reason_code) FROM exclusions_sql",
}
_OF_PURCHASE = ("dim_base", "scoreboard", "exclusion_detail", "exclusion_summary")


@query(
    "k9_reused_stage_tables",
    " UNION ALL ".join(
        f"SELECT {run} AS run, '{name}' AS stage, {run == 1 or (run == 2 and name in _OF_PURCHASE)} AS computed, ({sql}) AS n"
        for run in (1, 2, 3)
        for name, sql in _STAGE_ROWS.items()
    ),
)
def k9(spark, sf):
    """Seven stored outputs: the second run has other names in its purchase list, the third changes nothing."""
    root = new_folder(spark, "stages")
    purchase = normalise.purchase(b.purchase(spark, sf))
    renamed = purchase.withColumn("short_name", F.concat("short_name", F.lit(" II")))
    personnel = normalise.personnel(b.raw_personnel(spark, sf))
    series = unit_series(spark, sf).withColumn("unit_nav", F.col("adjusted_nav"))
    settings = runs.Settings("v1", as_of=AS_OF, stale_max_days=STALE_DAYS, metrics_only=False, resume=True)
    counts = []
    for number, listed in enumerate((purchase, renamed, renamed), 1):
        done = runs.scoreboard_stages(listed, b.overview(spark, sf), personnel, series, root, settings)
        counts += [
            done.tables[name].agg(F.count("*").alias("n")).select(
                F.lit(number).alias("run"), F.lit(name).alias("stage"), F.lit(name in done.computed).alias("computed"), "n"
            )
            for name in _STAGE_ROWS
        ]
    return functools.reduce(lambda x, y: x.unionByName(y), counts)


# The same backtest over daily NAV and the daily calendar: short windows, as few funds have a NAV every day.
DAILY_RULES = replace(RULES, rebalance_days=7, holding_days=1, limit=30)
TABLES["daily_nav_versions"] = TABLES["nav_versions"].replace("adjusted_nav", "unit_nav AS adjusted_nav").replace("month_nav", "nav")
for _name in ("anchors", "windows_sql", "window_versions", "selection_sql", "paths_sql", "usable_sql", "positions_sql",
              "portfolio_sql", "results_sql", "backtest_sql"):
    _text = re.sub(r"\b(anchors|nav_versions|window_versions|\w+_sql)\b", r"daily_\1", TABLES[_name]).replace("month_calendar", "calendar")
    for _old, _new in ((RULES.rebalance_days, DAILY_RULES.rebalance_days), (RULES.holding_days, DAILY_RULES.holding_days)):
        _text = _text.replace(f"INTERVAL {_old} DAY", f"INTERVAL {_new} DAY").replace(f"d3 + {_old})", f"d3 + {_new})")
    TABLES[f"daily_{_name}"] = _text.replace(f"place <= {RULES.limit}", f"place <= {DAILY_RULES.limit}")


@query(
    "a13_backtest_daily",
    "SELECT * REPLACE (" + ", ".join(f"{sql_r6(n)} AS {n}" for n in _WINDOW_NUMBERS) + ") FROM daily_backtest_sql",
)
def a13_daily(spark, sf):
    stored = b.nav(spark, sf).withColumnRenamed("unit_nav", "adjusted_nav").select("*", b.version_rows(b.NAV_VERSIONS))
    detail = backtest.run_backtest(
        spark, b.calendar(spark, sf), b.board_versions(spark, sf), stored.where("nav_date <= as_of_date"), DAILY_RULES
    ).windows
    return rounded(detail.withColumn("trading_holding_days", F.col("trading_holding_days").cast("long")), *_WINDOW_NUMBERS)


@query(
    "a14_table_contract",
    f"""SELECT 'overview' AS artifact, 'unique_key' AS rule, 'fund_code' AS columns, CAST(sum(n) AS BIGINT) AS bad_rows, '' AS detail
        FROM (SELECT c_custkey % 970 AS k, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0
        UNION ALL SELECT 'purchase', 'numeric', 'purchase_min_amount', count(*), '' FROM purchase WHERE purchase_min_amount = '1,000元' HAVING count(*) > 0
        UNION ALL SELECT 'purchase', 'numeric', 'purchase_fee', count(*), '' FROM purchase
        UNION ALL SELECT 'calendar', 'date', 'trade_date', count(*), '' FROM raw_calendar WHERE trade_date IS NULL HAVING count(*) > 0
        UNION ALL SELECT 'candidates', 'allowed', 'is_filtered', count(*), redeem_status FROM purchase GROUP BY 5""",
)
def a14(spark, sf):
    repeated = b.read(spark, sf, "customer").select(
        (F.col("c_custkey") % 970).alias("fund_code"), F.lit("1999-01-01").alias("inception_text")
    )
    purchase = b.purchase(spark, sf)
    judged = purchase.select("fund_code", F.col("redeem_status").alias("is_filtered"), F.lit("").alias("reasons"))
    found = None
    for name, table in (
        ("overview", repeated),
        ("purchase", purchase),
        ("calendar", b.raw_calendar(spark, sf)),
        ("candidates", judged),
    ):
        part = contracts.check_table(name, table, contracts.CONTRACTS[name])
        found = part if found is None else found.unionByName(part)
    return found


@query(
    "a15_fund_set_contract",
    """SELECT 'personnel' AS artifact, 'min_funds' AS rule, 'fund_code' AS columns, count(DISTINCT fund_code) AS bad_rows,
              'min_funds=1000000000' AS detail FROM personnel""",
)
def a15(spark, sf):
    notices = normalise.personnel(b.raw_personnel(spark, sf))
    enough = contracts.check_fund_set("nav", b.nav(spark, sf), contracts.FundSetContract(1))
    too_few = contracts.check_fund_set("personnel", notices, contracts.FundSetContract(10**9))
    return enough.unionByName(too_few)


@query(
    "a16_stage_contracts",
    """SELECT 'purchase' AS artifact, 'numeric' AS rule, 'purchase_min_amount' AS columns, count(*) AS bad_rows, '' AS detail
       FROM purchase WHERE purchase_min_amount = '1,000元' HAVING count(*) > 0
       UNION ALL SELECT 'purchase', 'numeric', 'purchase_fee', count(*), '' FROM purchase
       UNION ALL SELECT 'integrity_details', 'artifact', '', 0, 'missing table for stage filter_input'
       UNION ALL SELECT 'compare_details', 'min_funds', 'fund_code', 0, 'min_funds=1'""",
)
def a16(spark, sf):
    nav = b.nav(spark, sf)
    return contracts.check_stage(
        spark,
        "filter_input",
        {
            "purchase": b.purchase(spark, sf),
            "overview": b.overview(spark, sf),
            "nav": nav,
            "adjusted_nav": nav,
            "compare_details": nav.where("unit_nav < 0"),
        },
    )


@query(
    "a17_source_report",
    """SELECT 'purchase' AS source, count(*) AS rows, 'fund_code,short_name,subscribe_status,redeem_status,next_open_day,purchase_min_amount,daily_limit_amount,purchase_fee' AS columns, TRUE AS complete, '' AS missing_required, '' AS asset_scale_source FROM purchase
       UNION ALL SELECT 'overview', count(*), 'fund_code,full_name,fund_type,issue_date,inception_text,net_asset_scale,share_scale,manager_co,custodian,dividends_text,mgmt_fee,custody_fee,sales_fee,max_subscribe_fee,benchmark,tracking', FALSE, 'short_name,manager', 'net_asset_scale' FROM overview
       UNION ALL SELECT 'nav', count(*), 'fund_code,nav_date,unit_nav', FALSE, 'daily_growth', '' FROM nav
       UNION ALL SELECT 'bonus', count(*), 'fund_code,year,record_date,ex_date,per_share_text,pay_date', TRUE, '', '' FROM bonus
       UNION ALL SELECT 'split', count(*), 'fund_code,year,split_date,split_type,ratio_text', TRUE, '', '' FROM split
       UNION ALL SELECT 'cum_return', count(*), 'fund_code,date,cum_return_pct', TRUE, '', '' FROM cum_return
       UNION ALL SELECT 'personnel', count(*), 'fund_code,title,fund_name,notice_date', FALSE, 'report_id', '' FROM personnel""",
)
def a17(spark, sf):
    tables = {
        "purchase": b.purchase(spark, sf),
        "overview": b.overview(spark, sf)
        .drop("short_name", "manager")
        .withColumnRenamed("asset_scale", "net_asset_scale"),
        "nav": b.nav(spark, sf),
        "bonus": b.bonus(spark, sf),
        "split": b.split(spark, sf),
        "cum_return": b.cum_return(spark, sf),
        "personnel": b.raw_personnel(spark, sf).drop("report_id"),
    }
    return contracts.source_report(tables)
