"""Month summaries against the day-by-day definition and the snapshot over whole histories."""

import pytest

from navloom.operators import metrics, month_states
from tests.helpers import by_key, day, days_from, series
from tests.test_metrics import expected, random_series


def assert_same(got, code, wanted):
    for name, value in wanted.items():
        mine = got[code][name]
        if not isinstance(value, float):
            assert mine == value, (code, name)
        else:
            assert mine == pytest.approx(value, rel=1e-9, abs=1e-12), (code, name)


def stored(states, tmp_path):
    path = str(tmp_path / "states")
    states.write.parquet(path)
    return states.sparkSession.read.parquet(path)


def test_random_series_match_the_definition(spark, tmp_path):
    data = {f"{i:06d}": random_series(i) for i in range(60)}
    table = series(spark, data)
    got = by_key(month_states.snapshot(stored(month_states.month_states(table), tmp_path), table, "2030-01-01", 100000), "fund_code")
    assert set(got) == set(data)
    for code, points in data.items():
        assert_same(got, code, expected(points))


@pytest.mark.parametrize("latest", ["2019-12-31", "2020-02-29", "2020-03-01", "2021-07-14", "2018-01-01"])
def test_as_of_any_day_equals_the_run_over_whole_histories(spark, tmp_path, latest):
    table = series(spark, {f"{i:06d}": random_series(i) for i in range(25)})
    states = stored(month_states.month_states(table), tmp_path)
    right = by_key(metrics.metric_snapshot(table, latest, 40, latest=latest), "fund_code")
    left = by_key(month_states.snapshot(states, table, latest, 40, latest=latest), "fund_code")
    assert set(left) == set(right)
    for code in right:
        assert_same(left, code, right[code])


def test_new_days_change_the_summaries_of_their_months_alone(spark, tmp_path):
    table = series(spark, {f"{i:06d}": random_series(i) for i in (3, 4, 9, 14)})
    old = stored(month_states.month_states(table.where("nav_date < date'2019-11-12'")), tmp_path)
    new = month_states.refreshed(old, table, "2019-11-12")
    assert sorted(map(str, new.collect())) == sorted(map(str, month_states.month_states(table).collect()))
    poisoned = table.where("nav_date >= date'2019-11-01'")
    assert sorted(map(str, month_states.refreshed(old, poisoned, "2019-11-12").collect())) == sorted(map(str, new.collect()))


def test_only_days_of_cut_months_are_read(spark, tmp_path):
    """Days outside the months in which a span begins or ends may be wrong without effect."""
    points = [(d, 1 + i % 17 / 10) for i, d in enumerate(days_from("2019-02-20", 1836)) if d <= day("2024-02-29")]
    table = series(spark, {"000001": points})
    states = stored(month_states.month_states(table), tmp_path)
    few = table.where("trunc(nav_date, 'month') in (date'2021-02-01', date'2023-02-01', date'2024-02-01')")
    got = by_key(month_states.snapshot(states, few, "2024-02-15", latest="2024-02-15"), "fund_code")
    assert_same(got, "000001", expected([(d, v) for d, v in points if d <= day("2024-02-15")]))


def test_recovery_runs_over_months_without_a_new_peak(spark):
    dates = [day(d) for d in ("2024-01-30", "2024-02-05", "2024-02-20", "2024-03-04", "2024-04-01")]
    table = series(spark, {"000001": list(zip(dates, (2.0, 1.0, 1.5, 1.0, 2.0)))})
    got = by_key(month_states.snapshot(month_states.month_states(table), table, "2024-04-01"), "fund_code")["000001"]
    assert got["max_drawdown_recovery_days"] == 56 and got["max_drawdown"] == 0.5


def test_stale_funds_and_empty_tables(spark):
    table = series(spark, {"000001": list(zip(days_from("2024-01-01", 3), (1.0, 1.1, 1.2)))})
    states = month_states.month_states(table)
    row = month_states.snapshot(states, table, "2024-02-15").collect()[0]
    assert row.stale and row.annual_return is None and row.nav_end_date == day("2024-01-03")
    none = table.where("false")
    assert month_states.snapshot(month_states.month_states(none), none, "2024-02-15", latest="2024-02-15").count() == 0
    assert month_states.snapshot(states, table, "2024-02-15").columns == metrics.metric_snapshot(table, "2024-02-15").columns


def test_summaries_need_one_shuffle(spark):
    plan = month_states.month_states(series(spark, {"000001": random_series(3)}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_days_of_cut_months_are_pushed_to_the_scan(spark, tmp_path):
    points = [(d, 1 + i % 17 / 10) for i, d in enumerate(days_from("2019-02-20", 1836))]
    table = series(spark, {"000001": points})
    states = stored(month_states.month_states(table), tmp_path)
    path = str(tmp_path / "adjusted")
    table.write.parquet(path)
    plan = month_states.snapshot(states, spark.read.parquet(path), "2024-02-15", latest="2024-02-15")
    scans = [
        line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines()
        if "FileScan" in line and "adjusted_nav" in line
    ]
    assert scans and all("GreaterThanOrEqual(nav_date" in line for line in scans)
