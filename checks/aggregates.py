"""Aggregations, window functions, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.catalog import TABLES, query, r6, rounded, sql_r6
from checks.joins import RULES, unit_metrics, unit_series
from checks.metric_sql import define_metrics
from checks.projections import AS_OF, dim
from navloom.functions import text
from navloom.operators import (
    adjusted_nav,
    backtest,
    candidates,
    consistency,
    integrity,
    metrics,
    normalise,
    score,
    scoreboard,
)
from navloom.operators.dedupe import distinct_codes, keep_first, keep_last
from navloom.session import written

define_metrics("full", "adjusted", AS_OF, 60)
TABLES["adjusted_metrics"] = "SELECT * FROM full_metrics"


def adjusted_metrics(spark, sf):
    return metrics.metric_snapshot(b.adjusted(spark, sf), AS_OF, 60)


def metric_query(name, columns, table="unit"):
    """Register a query for some of the metrics, over unit or adjusted NAV."""
    shown = ", ".join(f"{sql_r6(c)} AS {c}" for c in columns)
    source = unit_metrics if table == "unit" else adjusted_metrics

    @query(name, f"SELECT fund_code, {shown} FROM {table}_metrics WHERE NOT stale")
    def run(spark, sf):
        fresh = source(spark, sf).where(~F.col("stale"))
        return rounded(fresh.select("fund_code", *columns), *columns)


@query(
    "g1_range_and_count_per_fund",
    """SELECT fund_code, count(*) AS rows, min(nav_date) AS start_date, max(nav_date) AS end_date FROM nav GROUP BY 1""",
)
def g1(spark, sf):
    return adjusted_nav.load_summary(b.nav(spark, sf))


@query("g2_dataset_as_of_date", "SELECT max(nav_date) AS as_of_date FROM nav")
def g2(spark, sf):
    return metrics.latest_day(b.nav(spark, sf))


@query(
    "g3_keep_first_and_last",
    f"""SELECT {b.sql_code('l_suppkey')} AS fund_code, CAST(l_shipdate AS DATE) AS day,
               min((l_orderkey * 10 + l_linenumber) * 1000000 + CAST(floor(l_extendedprice) AS BIGINT)) AS first_row,
               max((l_orderkey * 10 + l_linenumber) * 1000000 + CAST(floor(l_extendedprice) AS BIGINT)) AS last_row
        FROM lineitem WHERE {b.sql_code('l_suppkey')} IN (SELECT fund_code FROM nav) GROUP BY 1, 2""",
)
def g3(spark, sf):
    key = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.floor("l_extendedprice")
    rows = b.read(spark, sf, "lineitem").select(
        b.code("l_suppkey").alias("fund_code"), F.to_date("l_shipdate").alias("day"), key.alias("value")
    )
    first = keep_first(rows, ["fund_code", "day"], [F.col("value")]).withColumnRenamed("value", "first_row")
    last = keep_last(rows, ["fund_code", "day"], [F.col("value")]).withColumnRenamed("value", "last_row")
    known = distinct_codes(b.nav(spark, sf))
    return first.join(last, ["fund_code", "day"]).join(known, "fund_code", "left_semi")


SPANS = ("", "_3y", "_1y")
metric_query("g4_annual_return", [f"annual_return{s}" for s in SPANS])
metric_query(
    "g5_up_ratio",
    [f"up_{p}_ratio{s}" for s in SPANS for p in ("quarter", "month", "week") if (p, s) != ("quarter", "_1y")],
)
metric_query(
    "g6_period_return_std",
    [f"{p}_return_std{s}" for s in SPANS for p in ("quarter", "month", "week") if (p, s) != ("quarter", "_1y")],
)
metric_query("g7_max_drawdown", [f"max_drawdown{s}" for s in SPANS])
metric_query("g8_longest_recovery", [f"max_drawdown_recovery_days{s}" for s in SPANS])
metric_query("g9_worst_day", [f"max_single_day_drop{s}" for s in SPANS])
metric_query("g10_recent_month_return", ["recent_month_return"])
metric_query("g11_sharpe", [f"sharpe_ratio{s}" for s in SPANS if s])
metric_query("g12_calmar", [f"calmar_ratio{s}" for s in SPANS if s])
metric_query(
    "g13_full_history_metrics", [n for n in metrics.METRICS if not n.endswith(("_1y", "_3y"))], "adjusted"
)
metric_query(
    "g14_trailing_metrics", [n for n in metrics.METRICS if n.endswith(("_1y", "_3y"))], "adjusted"
)


@query(
    "g15_exclusion_summary",
    f"""SELECT 'v1' AS data_version, DATE '{AS_OF}' AS as_of_date, reason_code, count(*) AS fund_count
        FROM exclusions_sql GROUP BY 3""",
)
def g15(spark, sf):
    return scoreboard.build(unit_metrics(spark, sf), dim(spark, sf), "v1", AS_OF).exclusion_summary


TABLES["sides_sql"] = """
SELECT coalesce(n.fund_code, c.fund_code) AS fund_code, coalesce(n.nav_date, c.date) AS d, n.adjusted_nav AS l, c.cum_return_pct AS r
FROM adjusted n FULL OUTER JOIN cum_return c ON c.fund_code = n.fund_code AND c.date = n.nav_date"""
TABLES["judged_sql"] = """
SELECT s.fund_code AS fund_code, d, l, r, e, le, re, l IS NOT NULL AND r IS NOT NULL AS common,
       CASE WHEN l <> 0 THEN (le - l) / l END AS lr, CASE WHEN r + 100 <> 0 THEN (re - r) / (r + 100e0) END AS rr
FROM sides_sql s LEFT JOIN (
  SELECT fund_code, max(d) AS e, arg_max(l, d) AS le, arg_max(r, d) AS re FROM sides_sql
  WHERE l IS NOT NULL AND r IS NOT NULL GROUP BY 1) x ON x.fund_code = s.fund_code"""
TABLES["deviations_sql"] = """
SELECT *, CASE WHEN dev IS NULL THEN '-' WHEN abs(dev) < 0.01::DOUBLE THEN '<1%' WHEN abs(dev) < 0.02::DOUBLE THEN '1%～2%'
               WHEN abs(dev) < 0.05::DOUBLE THEN '2%～5%' WHEN abs(dev) < 0.1::DOUBLE THEN '5%～10%' ELSE '10%以上' END AS bucket
FROM (SELECT *, CASE WHEN lr <> 0 AND rr IS NOT NULL THEN (lr - rr) / lr END AS dev FROM judged_sql)"""
_BUCKETS = dict(zip(consistency.BUCKET_NAMES, ("<1%", "1%～2%", "2%～5%", "5%～10%", "10%以上"), strict=True))
TABLES["compare_summary_sql"] = (
    "SELECT fund_code, max(e) IS NULL AS missing, count(*) FILTER (WHERE common AND d < e) AS compared_days,"
    " count(*) FILTER (WHERE NOT common AND d <= e) AS skipped_days, "
    + ", ".join(f"count(*) FILTER (WHERE common AND d < e AND bucket = '{v}') AS {k}" for k, v in _BUCKETS.items())
    + " FROM deviations_sql GROUP BY 1"
)
SHARES = [f"{k}_share" for k in _BUCKETS]
SQL_SHARES = ", ".join(
    f"CASE WHEN compared_days > 0 THEN {sql_r6(f'{k} / CAST(compared_days AS DOUBLE)')} ELSE 0e0 END AS {k}_share"
    for k in _BUCKETS
)


@query("g16_deviation_shares", f"SELECT *, {SQL_SHARES} FROM compare_summary_sql")
def g16(spark, sf):
    return rounded(consistency.summary(b.adjusted(spark, sf), b.cum_return(spark, sf)), *SHARES)


TABLES["ratio_sql"] = """
SELECT o.fund_code AS fund_code, avg(CASE WHEN n.nav_date IS NULL THEN 0e0 ELSE 1e0 END) AS ratio
FROM (SELECT fund_code FROM overview WHERE (inception_date IS NULL OR inception_date <= DATE '1996-01-01')
        AND fund_code IN (SELECT fund_code FROM nav)) o
JOIN calendar c ON c.trade_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
LEFT JOIN nav n ON n.fund_code = o.fund_code AND n.nav_date = c.trade_date GROUP BY 1"""


@query("g17_integrity_ratio", f"SELECT fund_code, {sql_r6('ratio')} AS ratio FROM ratio_sql")
def g17(spark, sf):
    shares = integrity.summary(
        b.nav(spark, sf), b.overview(spark, sf), b.calendar(spark, sf), "1996-01-01", "1999-12-31"
    )
    return rounded(shares, "ratio")


@query(
    "g18_score_input_ranges",
    "SELECT "
    + ", ".join(
        f"{sql_r6(f'{agg}({n})')} AS {n}_{agg}" for n in score.INPUTS for agg in ("min", "max")
    )
    + " FROM unit_metrics WHERE NOT stale",
)
def g18(spark, sf):
    ranges = score.input_ranges(unit_metrics(spark, sf).where(~F.col("stale")))
    return rounded(ranges, *ranges.columns)


TABLES["usable_sql"] = """
SELECT p.window_id AS window_id, p.fund_code AS fund_code, weight, nav_date, d3, adjusted_nav, buy, sell FROM paths_sql p
JOIN (SELECT window_id, fund_code, max(CASE WHEN nav_date = d3 THEN adjusted_nav END) AS buy,
             max(CASE WHEN nav_date = d4 THEN adjusted_nav END) AS sell
      FROM paths_sql GROUP BY 1, 2 HAVING count(*) = count(adjusted_nav)) g
  ON g.window_id = p.window_id AND g.fund_code = p.fund_code
WHERE buy > 0"""
TABLES["positions_sql"] = """
SELECT window_id, fund_code, weight / sum(weight) OVER (PARTITION BY window_id) AS weight, buy, sell
FROM usable_sql WHERE nav_date = d3"""
TABLES["portfolio_sql"] = """
SELECT u.window_id AS window_id, u.nav_date AS nav_date, sum(p.weight * u.adjusted_nav / u.buy) AS value
FROM usable_sql u JOIN positions_sql p ON p.window_id = u.window_id AND p.fund_code = u.fund_code GROUP BY 1, 2"""
TABLES["results_sql"] = """
SELECT window_id, arg_min(value, nav_date) AS s, arg_max(value, nav_date) AS e, max(1e0 - value / peak) AS drawdown,
       CASE WHEN count(step) > 1 THEN stddev_samp(step) ELSE 0e0 END AS volatility
FROM (SELECT *, value / lag(value) OVER (PARTITION BY window_id ORDER BY nav_date) - 1e0 AS step,
             max(value) OVER (PARTITION BY window_id ORDER BY nav_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak
      FROM portfolio_sql) GROUP BY 1"""
TABLES["backtest_sql"] = """
SELECT w.window_id AS window_id, w.d1 AS d1, w.d2 AS d2, w.d3 AS d3, w.d4 AS d4, w.calendar_holding_days AS calendar_holding_days,
       w.trading_holding_days AS trading_holding_days, v.data_version AS selection_data_version,
       coalesce(h.n, 0) AS selected_fund_count, coalesce(h.total, 0e0) AS weight_sum, r.e - 1e0 AS portfolio_return,
       r.s AS portfolio_nav_start, r.e AS portfolio_nav_end, r.drawdown AS max_drawdown_in_window,
       r.volatility AS volatility_in_window, CASE WHEN r.window_id IS NULL THEN 'skipped' ELSE 'ok' END AS status,
       CASE WHEN v.data_version IS NULL THEN 'no_data_version_before_d2' WHEN r.window_id IS NOT NULL THEN ''
            WHEN v.data_version NOT IN (SELECT data_version FROM selection_sql) THEN 'empty_selection'
            ELSE 'no_fund_with_valid_nav_on_d3_d4' END AS skip_reason
FROM windows_sql w JOIN window_versions v ON v.window_id = w.window_id
LEFT JOIN results_sql r ON r.window_id = w.window_id
LEFT JOIN (SELECT window_id, count(*) AS n, sum(weight) AS total FROM positions_sql GROUP BY 1) h ON h.window_id = w.window_id"""


def backtested(spark, sf):
    """Over stored snapshots, as a backtest is run: each is derived once."""
    board, nav = written(b.board_versions(spark, sf), "board"), written(b.nav_versions(spark, sf), "nav")
    return backtest.run_backtest(spark, b.month_calendar(spark, sf), board, nav, RULES)


_RETURNS = ("mean_return", "median_return", "std_return", "p10_return", "p50_return", "p90_return",
            "best_window_return", "worst_window_return")


@query(
    "g19_backtest_distribution",
    f"""SELECT count(*) AS total_windows, count(portfolio_return) AS valid_windows,
               count(*) FILTER (WHERE status <> 'ok') AS skipped_windows,
               {sql_r6("coalesce(avg(CASE WHEN portfolio_return > 0 THEN 1e0 WHEN portfolio_return <= 0 THEN 0e0 END), 0e0)")} AS win_rate,
               {sql_r6('avg(portfolio_return)')} AS mean_return, {sql_r6('median(portfolio_return)')} AS median_return,
               {sql_r6('CASE WHEN count(portfolio_return) = 1 THEN 0e0 ELSE stddev_samp(portfolio_return) END')} AS std_return,
               {sql_r6('quantile_cont(portfolio_return, 0.1)')} AS p10_return,
               {sql_r6('quantile_cont(portfolio_return, 0.5)')} AS p50_return,
               {sql_r6('quantile_cont(portfolio_return, 0.9)')} AS p90_return,
               {sql_r6('max(portfolio_return)')} AS best_window_return, {sql_r6('min(portfolio_return)')} AS worst_window_return
        FROM backtest_sql""",
)
def g19(spark, sf):
    return rounded(backtested(spark, sf).aggregate, "win_rate", *_RETURNS)


@query(
    "g20_version_dates",
    """SELECT data_version, max(as_of_date) AS as_of_date,
              (SELECT max(data_version) FROM nav_versions WHERE as_of_date = (SELECT max(as_of_date) FROM nav_versions)) AS latest_nav
       FROM board_versions GROUP BY 1""",
)
def g20(spark, sf):
    latest = backtest.latest_version(b.nav_versions(spark, sf)).scalar()
    return backtest.version_dates(b.board_versions(spark, sf)).withColumn("latest_nav", latest)


@query(
    "g21_load_report",
    f"""SELECT count(*) AS total_codes, count(*) FILTER (WHERE done) AS already_done,
               count(*) FILTER (WHERE NOT done AND n > 0) AS loaded,
               count(*) FILTER (WHERE NOT done AND n = 0 AND failed) AS failed,
               CAST(coalesce(sum(n) FILTER (WHERE NOT done), 0) AS BIGINT) AS rows_written
        FROM (SELECT fund_code, fund_code IN (SELECT fund_code FROM blacklist) AS done,
                     (SELECT count(*) FROM nav x WHERE x.fund_code = p.fund_code AND x.fund_code NOT LIKE '%7') AS n,
                     fund_code IN (SELECT {b.sql_code('code')} FROM failure_log) AS failed FROM purchase p)""",
)
def g21(spark, sf):
    failed = b.failure_log(spark, sf).select(text.fund_code(F.col("code")).alias("fund_code"))
    loaded = b.nav(spark, sf).where("fund_code not like '%7'")
    return candidates.load_report(
        normalise.purchase(b.purchase(spark, sf)), b.blacklist(spark, sf), loaded, failed
    )


@query(
    "g22_run_report",
    """SELECT 'original' AS measure, count(*) AS n FROM purchase
       UNION ALL SELECT 'blacklist_removed', count(*) FROM purchase WHERE fund_code IN (SELECT fund_code FROM blacklist)
       UNION ALL SELECT 'effective', count(*) FROM purchase WHERE fund_code NOT IN (SELECT fund_code FROM blacklist)
       UNION ALL SELECT 'after_filter', count(*) FROM purchase WHERE fund_code IN (SELECT fund_code FROM overview WHERE inception_date IS NULL)
       UNION ALL SELECT 'filtered', count(*) FROM overview WHERE inception_date IS NOT NULL
       UNION ALL SELECT 'failures in ' || CASE WHEN trim(stage) = '' THEN 'unknown' ELSE stage END, count(*)
       FROM failure_log GROUP BY 1""",
)
def g22(spark, sf):
    filtered = b.overview(spark, sf).select(
        "fund_code", (F.col("inception_text") != "---").alias("is_filtered")
    )
    purchase = b.purchase(spark, sf)
    report = candidates.run_report(
        purchase, b.blacklist(spark, sf), filtered, candidates.unfiltered(purchase, filtered)
    )
    failures = candidates.failures_by_stage(b.failure_log(spark, sf)).select(
        F.concat(F.lit("failures in "), "stage").alias("measure"), F.col("failures").alias("n")
    )
    return report.withColumnRenamed("funds", "n").unionByName(failures)


@query(
    "w1_daily_return",
    f"""SELECT fund_code, nav_date,
               {sql_r6('unit_nav / lag(unit_nav) OVER (PARTITION BY fund_code ORDER BY nav_date) - 1e0')} AS daily_return
        FROM nav""",
)
def w1(spark, sf):
    return metrics.with_daily_return(unit_series(spark, sf)).select(
        "fund_code", "nav_date", r6("daily_return").alias("daily_return")
    )


@query(
    "w2_cumulative_factor",
    f"SELECT fund_code, nav_date, {sql_r6('cumulative_factor')} AS cumulative_factor FROM adjusted",
)
def w2(spark, sf):
    return b.adjusted(spark, sf).select(
        "fund_code", "nav_date", r6("cumulative_factor").alias("cumulative_factor")
    )


@query(
    "w3_running_drawdown",
    f"""SELECT fund_code, nav_date, {sql_r6('1e0 - unit_nav / peak')} AS drawdown FROM (
          SELECT *, max(unit_nav) OVER (PARTITION BY fund_code ORDER BY nav_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak FROM nav)""",
)
def w3(spark, sf):
    state = metrics.with_drawdown_state(unit_series(spark, sf), suffixes=("",))
    drawdown = F.lit(1.0) - F.col("adjusted_nav") / F.greatest("adjusted_nav", "peak")
    return state.select("fund_code", "nav_date", r6(drawdown).alias("drawdown"))


@query(
    "w4_recovery_episodes",
    """SELECT fund_code, first_day AS recovered_on, CAST(date_diff('day', d, first_day) AS INTEGER) AS recovery_days FROM (
         SELECT fund_code, first_day, lag(trough.d) OVER (PARTITION BY fund_code ORDER BY episode) AS d
         FROM fresh_episodes WHERE tag = 'a') WHERE d IS NOT NULL""",
)
def w4(spark, sf):
    state = metrics.with_drawdown_state(unit_series(spark, sf), suffixes=("",))
    return state.where("recovery_days is not null").select(
        "fund_code", F.col("nav_date").alias("recovered_on"), "recovery_days"
    )


@query(
    "w5_period_resample",
    f"""SELECT fund_code, ptype AS period_type, strftime(bucket, '%Y-%m-%d') AS period_key, prev_bucket AS period_start,
               bucket AS period_end, {sql_r6('r')} AS period_return
        FROM fresh_returns WHERE tag = 'a' AND r IS NOT NULL""",
)
def w5(spark, sf):
    return rounded(metrics.period_facts(unit_series(spark, sf), AS_OF, 100000), "period_return")


@query(
    "w6_last_common_values",
    f"""SELECT fund_code, d AS date, e AS end_date, {sql_r6('le')} AS local_end, {sql_r6('re')} AS remote_end FROM judged_sql""",
)
def w6(spark, sf):
    days = consistency.with_last_common(consistency.both_sides(b.adjusted(spark, sf), b.cum_return(spark, sf)))
    return rounded(
        days.select("fund_code", "date", "end_date", "local_end", "remote_end"), "local_end", "remote_end"
    )


@query(
    "w7_global_rank",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
              CAST(rank() OVER (ORDER BY l_quantity * (1 + l_linenumber) DESC) AS INTEGER) AS rank FROM lineitem""",
)
def w7(spark, sf):
    """Few distinct values over all order lines: most rows are ties."""
    value = (F.col("l_quantity") * (1 + F.col("l_linenumber"))).alias("value")
    lines = b.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", value)
    return score.global_rank(lines, "value").drop("value")


@query(
    "w8_next_trade_day",
    """SELECT trade_date, lead(trade_date) OVER (ORDER BY trade_date) AS next_trade_date FROM calendar""",
)
def w8(spark, sf):
    days = backtest.next_trade_days(b.calendar(spark, sf))
    return days.where("day = trade_date").select("trade_date", "next_trade_date")


@query(
    "l1_top_k_selection",
    f"SELECT data_version, fund_code, {sql_r6('weight')} AS weight FROM selection_sql",
)
def l1(spark, sf):
    return rounded(backtest.selection(b.board_versions(spark, sf), RULES), "weight")


@query(
    "l2_top_windows",
    f"""SELECT window_id, d3, d4, {sql_r6('portfolio_return')} AS portfolio_return FROM backtest_sql
        WHERE status = 'ok' ORDER BY portfolio_return DESC, window_id LIMIT 3""",
)
def l2(spark, sf):
    return rounded(backtest.top_windows(backtested(spark, sf).windows), "portfolio_return")


@query(
    "l3_sorted_positions",
    f"""SELECT window_id, fund_code, {sql_r6('weight')} AS weight, {sql_r6('sell / buy - 1e0')} AS fund_return
        FROM positions_sql ORDER BY window_id, fund_code""",
)
def l3(spark, sf):
    """Sorted only here, at the end: a range-partitioned sort, no single task."""
    held = backtested(spark, sf).positions.select("window_id", "fund_code", "weight", "fund_return")
    return rounded(held, "weight", "fund_return").orderBy("window_id", "fund_code")


@query(
    "l4_pinned_sample",
    """SELECT fund_code, short_name, redeem_status FROM (SELECT * FROM purchase WHERE fund_code <> '163402'
         ORDER BY fund_code DESC LIMIT 20)
       UNION ALL SELECT '163402', '', ''""",
)
def l4(spark, sf):
    sample = candidates.pinned_sample(
        b.purchase(spark, sf), [-F.col("fund_code").cast("int")]
    )
    return sample.select("fund_code", "short_name", "redeem_status")
