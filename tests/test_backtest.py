import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from navloom.operators import backtest
from tests.helpers import by_key, day, days_from

BOARD = (
    "data_version string, as_of_date date, fund_code string, annual_return double, "
    "subscribe_status string, redeem_status string"
)
NAV = "data_version string, as_of_date date, fund_code string, nav_date date, adjusted_nav double"


@pytest.fixture
def calendar(spark):
    return spark.createDataFrame([(d,) for d in days_from("2024-01-01", 91)], "trade_date date")


def rules(**changes):
    base = {"start": "2024-01-01", "end": "2024-01-31", "rebalance_days": 15, "holding_days": 30}
    return backtest.Rules(**{**base, **changes})


def board(spark, rows):
    return spark.createDataFrame([(v, day(d), c, a, None, None) for v, d, c, a in rows], BOARD)


def nav(spark, values):
    rows = [("n1", day("2024-03-31"), c, d, float(v)) for c, points in values.items() for d, v in points]
    return spark.createDataFrame(rows, NAV)


def test_windows(spark, calendar):
    rows = by_key(backtest.windows(spark, calendar, rules()), "window_id")
    assert len(rows) == 3
    first = rows[1]
    assert (first["d2"], first["d3"], first["d4"]) == (day("2024-01-01"), day("2024-01-02"), day("2024-02-01"))
    assert (first["calendar_holding_days"], first["trading_holding_days"]) == (30, 31)


def test_windows_end_with_the_calendar_and_skip_closed_days(spark):
    open_days = [d for d in days_from("2024-01-08", 60) if d.weekday() < 5]
    table = spark.createDataFrame([(d,) for d in open_days], "trade_date date")
    plan = rules(start="2024-01-01", end="2024-12-31", rebalance_days=6, holding_days=13)
    got = by_key(backtest.windows(spark, table, plan), "window_id")
    anchor, number = day("2024-01-01"), 1
    while True:
        later = [d for d in open_days if d >= anchor]
        if len(later) < 2:
            break
        sell = [d for d in open_days if d >= later[1] + dt.timedelta(days=13)]
        if not sell:
            break
        row = got[number]
        assert (row["d1"], row["d2"], row["d3"], row["d4"]) == (anchor, later[0], later[1], sell[0])
        assert row["trading_holding_days"] == sum(later[1] <= d <= sell[0] for d in open_days)
        anchor, number = anchor + dt.timedelta(days=6), number + 1
    assert len(got) == number - 1


def test_versions_as_of(spark, calendar):
    planned = backtest.windows(spark, calendar, rules())
    versions = spark.createDataFrame(
        [("v1", day("2024-01-10")), ("v2", day("2024-01-30")), ("v2b", day("2024-01-30"))],
        "data_version string, as_of_date date",
    )
    got = by_key(backtest.with_versions(planned, versions), "window_id")
    assert [got[i]["data_version"] for i in (1, 2, 3)] == [None, "v1", "v2b"]
    assert got[1]["skip_reason"] == backtest.NO_VERSION_YET
    none = backtest.with_versions(planned, versions.where("false"))
    assert {r.skip_reason for r in none.collect()} == {backtest.NO_VERSIONS}
    assert {r.data_version for r in backtest.with_versions(planned, versions, "x").collect()} == {"x"}


def test_end_to_end(spark, calendar):
    values = {
        "000001": [(d, 1.0 + 0.01 * i) for i, d in enumerate(days_from("2024-01-02", 90))],
        "000002": [(d, 1.0) for d in days_from("2024-01-02", 90)],
    }
    scores = board(spark, [("v1", "2024-01-01", "1", 0.2), ("v1", "2024-01-01", "000002", 0.1)])
    result = backtest.run_backtest(spark, calendar, scores, nav(spark, values), rules())
    windows = by_key(result.windows, "window_id")
    assert [w["status"] for w in windows.values()] == ["ok"] * 3
    assert windows[1]["portfolio_return"] == pytest.approx(0.15)
    assert result.positions.count() == 6
    row = result.aggregate.collect()[0]
    assert (row.total_windows, row.valid_windows, row.win_rate) == (3, 3, 1.0)
    assert [r.window_id for r in backtest.top_windows(result.windows, 1).collect()] == [1]
    assert result.run.collect()[0].nav_data_version == "n1"


def test_nothing_selected(spark, calendar):
    scores = board(spark, [("v1", "2024-01-01", "000001", 0.2)])
    result = backtest.run_backtest(
        spark, calendar, scores, nav(spark, {"000001": [(day("2024-01-02"), 1.0)]}), rules(where="annual_return > 1")
    )
    assert {r.skip_reason for r in result.windows.collect()} == {backtest.NOTHING_SELECTED}
    row = result.aggregate.collect()[0]
    assert row.valid_windows == 0 and row.win_rate == 0.0 and row.mean_return is None
    assert result.positions.count() == 0


def test_gaps_drop_funds_and_weights_are_renormalised(spark, calendar):
    random.seed(3)
    values = {}
    for n in range(1, 6):
        points, v = [], 1.0
        for d in days_from("2024-01-02", 90):
            v *= 1 + random.uniform(-0.03, 0.03)
            points.append((d, v))
        values[f"00000{n}"] = points
    values["000002"] = [p for p in values["000002"] if p[0] != day("2024-01-20")]
    values["000003"] = [(d, 0.0 if d == day("2024-01-02") else v) for d, v in values["000003"]]
    scores = board(spark, [("v1", "2024-01-01", c, 1.0) for c in values])
    result = backtest.run_backtest(spark, calendar, scores, nav(spark, values), rules(limit=4, end="2024-01-01"))
    window = result.windows.collect()[0]
    held = by_key(result.positions, "fund_code")
    assert set(held) == {"000001", "000004"} and window.selected_fund_count == 2
    days = days_from("2024-01-02", 31)
    maps = {c: dict(values[c]) for c in held}
    path = [sum(0.5 * m[d] / m[days[0]] for m in maps.values()) for d in days]
    steps = [b / a - 1 for a, b in zip(path, path[1:])]
    assert window.portfolio_return == pytest.approx(path[-1] - 1)
    assert window.volatility_in_window == pytest.approx(statistics.stdev(steps))
    assert window.max_drawdown_in_window == pytest.approx(max(1 - v / max(path[: i + 1]) for i, v in enumerate(path)))
    assert held["000001"]["weight"] == 0.5


def test_no_usable_fund(spark, calendar):
    scores = board(spark, [("v1", "2024-01-01", "000001", 1.0)])
    result = backtest.run_backtest(
        spark, calendar, scores, nav(spark, {"000001": [(day("2024-01-02"), 1.0)]}), rules()
    )
    assert {r.skip_reason for r in result.windows.collect()} == {backtest.NO_USABLE_FUND}


def test_salted_selection_equals_a_plain_sort(spark):
    random.seed(1)
    rows = [("v1", "2024-01-01", f"{i:06d}", random.choice([None, 0.1, 0.2, i / 500])) for i in range(500)]
    rows += [("v2", "2024-01-02", "1", 0.3), ("v2", "2024-01-02", "000001", 0.2), ("v2", "2024-01-02", "000002", 0.1)]
    got = backtest.selection(board(spark, rows), rules(limit=2, order_by="annual_return DESC, fund_code"))
    picked = by_key(got, "data_version", "fund_code")
    best = sorted((r for r in rows if r[0] == "v1" and r[3] is not None), key=lambda r: (-r[3], r[2]))[:2]
    assert {k[1] for k in picked if k[0] == "v1"} == {r[2] for r in best}
    # The cut to two comes before repeated codes are removed.
    assert {k: v["weight"] for k, v in picked.items() if k[0] == "v2"} == {("v2", "000001"): 1.0}


def test_excluded_statuses_and_order_terms(spark):
    table = spark.createDataFrame(
        [("v1", day("2024-01-01"), f"00000{i}", 1.0, s, "开放赎回") for i, s in enumerate(["暂停申购", None, "开放申购"])], BOARD
    )
    got = backtest.selection(table, rules(exclude_subscribe=("暂停申购",)))
    assert {r.fund_code for r in got.collect()} == {"000001", "000002"}
    assert backtest.order_terms("coalesce(a, b) desc, c nulls first") == "coalesce(a, b) desc NULLS LAST, c nulls first"


def test_stretches_tell_gapless_windows(spark):
    random.seed(8)
    open_days = [d for d in days_from("2024-01-01", 80) if d.weekday() < 5]
    calendar = spark.createDataFrame([(d,) for d in open_days] * 2, "trade_date date")
    held = {f"00000{n}": [d for d in days_from("2024-01-01", 80) if random.random() < share] for n, share in enumerate((1, 0.95, 0.9, 0.6), 1)}
    table = nav(spark, {c: [(d, 1.0 + i / 100) for i, d in enumerate(days)] for c, days in held.items()})
    gone = held["000001"][9]
    table = table.withColumn("adjusted_nav", F.when((F.col("fund_code") != "000001") | (F.col("nav_date") != gone), F.col("adjusted_nav")))
    held["000001"].remove(gone)
    windows = [(i, "v", a, b) for i, (a, b) in enumerate((a, b) for a in open_days[::3] for b in open_days[::4] if a <= b)]
    wanted = spark.createDataFrame(windows, "window_id int, data_version string, d3 date, d4 date")
    chosen = spark.createDataFrame([("v", c, 0.25) for c in held], "data_version string, fund_code string, weight double")
    got = backtest.usable_funds(wanted, chosen, backtest.stretches(table, calendar)).collect()
    want = {(i, c) for i, _, a, b in windows for c, days in held.items() if all(d in days for d in open_days if a <= d <= b)}
    assert {(r.window_id, r.fund_code) for r in got} == want and len(got) == len(want) > 40


def test_run_record_and_plan(spark, calendar):
    values = {"000001": [(d, 1.0) for d in days_from("2024-01-01", 91)]}
    scores = board(spark, [("v1", "2024-01-01", "000001", 1.0)])
    result = backtest.run_backtest(spark, calendar, scores, nav(spark, values), rules(trade_calendar="days.csv"))
    record = result.run.collect()[0].asDict()
    assert {"run_id", "run_time", "selection_rule_id"} <= set(record) and len(record["run_id"]) == 14
    assert (record["trade_calendar"], record["fee_mode"], record["overlap_mode"]) == (
        "days.csv", "ignore_subscribe_redeem_conversion_fee", "independent_windows"
    )
    for frame in (result.windows, result.positions, result.aggregate):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") <= 20 and "scalar-subquery" not in plan and "nav_daily" not in plan
