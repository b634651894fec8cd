"""Metrics against a plain day-by-day computation on random series."""

import datetime as dt
import math
import random
import statistics

import pytest

from navloom.operators import metrics
from tests.helpers import by_key, day, days_from, series


def bucket(d, kind):
    if kind == "W":
        return d + dt.timedelta(days=(4 - d.weekday()) % 7)
    month = d.month if kind == "M" else (d.month - 1) // 3 * 3 + 3
    following = dt.date(d.year + month // 12, month % 12 + 1, 1)
    return following - dt.timedelta(days=1)


def period_returns(points, kind):
    last = {}
    for d, v in points:
        last[bucket(d, kind)] = v
    ordered = [last[k] for k in sorted(last)]
    return [b / a - 1 for a, b in zip(ordered, ordered[1:])]


def years_before(d, years):
    try:
        return d.replace(year=d.year - years)
    except ValueError:
        return d.replace(year=d.year - years, day=28)


def brute(points, suffix):
    """The metric set of one span, straight from its definition."""
    out, values = {}, [v for _, v in points]
    days = (points[-1][0] - points[0][0]).days
    ok = len(points) > 1 and values[0] > 0 and values[-1] > 0 and days > 0
    annual = (values[-1] / values[0]) ** (365.0 / days) - 1 if ok else None
    drawdown = max(1 - v / max(values[: i + 1]) for i, v in enumerate(values))
    steps = [b / a - 1 for a, b in zip(values, values[1:])]
    gaps, start = [], 0
    for j in range(1, len(points)):
        if values[j] >= max(values[:j]):
            low = min(range(start, j), key=lambda i: (values[i], i))
            gaps.append((points[j][0] - points[low][0]).days)
            start = j
    out[f"annual_return{suffix}"] = annual
    out[f"max_drawdown{suffix}"] = drawdown
    out[f"max_drawdown_recovery_days{suffix}"] = float(max(gaps)) if gaps else None
    out[f"max_single_day_drop{suffix}"] = min(steps) if steps else None
    for kind, name in (("W", "week"), ("M", "month"), ("Q", "quarter")):
        r = period_returns(points, kind)
        out[f"up_{name}_ratio{suffix}"] = sum(x > 0 for x in r) / len(r) if r else None
        out[f"{name}_return_std{suffix}"] = (statistics.stdev(r) if len(r) > 1 else 0.0) if r else None
        if kind == "W" and suffix:
            good = len(r) > 1 and statistics.stdev(r) > 0
            out[f"sharpe_ratio{suffix}"] = (
                (statistics.mean(r) * 52 - 0.015) / (statistics.stdev(r) * math.sqrt(52)) if good else None
            )
    if suffix:
        out[f"calmar_ratio{suffix}"] = annual / drawdown if annual is not None and drawdown > 0 else None
    return out


def expected(points):
    end = points[-1][0]
    out = brute(points, "")
    for years in (3, 1):
        inside = [(d, v) for d, v in points if d >= years_before(end, years)]
        out.update(brute(inside, f"_{years}y"))
    first = end.replace(day=1)
    month = [(d, v) for d, v in points if (first - dt.timedelta(days=1)).replace(day=1) <= d < first]
    out["recent_month_return"] = month[-1][1] / month[0][1] - 1 if len(month) > 1 else None
    return {name: out[name] for name in metrics.METRICS}


def random_series(seed):
    random.seed(seed)
    d, v, points = day("2019-01-01") + dt.timedelta(days=seed * 13), 1.0, []
    for _ in range(random.choice([1, 2, 5, 40, 400])):
        points.append((d, round(v, random.choice([1, 2, 6]))))
        d += dt.timedelta(days=random.choice([1, 1, 1, 2, 3, 9]))
        v = max(0.3, v * (1 + random.uniform(-0.04, 0.045)))
    return points


def test_random_series_match_the_definition(spark):
    data = {f"{i:06d}": random_series(i) for i in range(60)}
    got = by_key(metrics.metric_snapshot(series(spark, data), "2030-01-01", 100000), "fund_code")
    assert set(got) == set(data)
    for code, points in data.items():
        for name, value in expected(points).items():
            mine = got[code][name]
            if value is None:
                assert mine is None, (code, name, mine)
            else:
                assert mine == pytest.approx(value, rel=1e-9, abs=1e-12), (code, name)


def test_leap_day_end(spark):
    points = [(d, 1 + i % 7 / 10) for i, d in enumerate(days_from("2019-02-20", 1836)) if d <= day("2024-02-29")]
    got = by_key(metrics.metric_snapshot(series(spark, {"000001": points}), "2024-02-29"), "fund_code")["000001"]
    assert got["nav_end_date"] == day("2024-02-29")
    for name, value in expected(points).items():
        assert got[name] == pytest.approx(value, rel=1e-9, abs=1e-12), name


def test_single_point_and_single_day_drop(spark):
    data = {
        "000001": [(day("2024-01-01"), 1.0)],
        "000002": list(zip(days_from("2024-01-01", 3), (1.0, 0.95, 0.98))),
    }
    got = by_key(metrics.metric_snapshot(series(spark, data), "2024-01-03"), "fund_code")
    assert got["000001"]["annual_return"] is None and got["000001"]["max_drawdown"] == 0.0
    assert got["000002"]["max_single_day_drop"] == pytest.approx(-0.05)


def test_monotone_series_returns_the_largest_gap_and_falling_none(spark):
    dates = [day(d) for d in ("2024-01-01", "2024-01-02", "2024-01-09", "2024-01-10")]
    data = {"000001": list(zip(dates, (1.0, 1.1, 1.2, 1.3))), "000002": list(zip(dates, (1.3, 1.2, 1.1, 1.0)))}
    got = by_key(metrics.metric_snapshot(series(spark, data), "2024-01-10"), "fund_code")
    assert got["000001"]["max_drawdown_recovery_days"] == 7
    assert got["000002"]["max_drawdown_recovery_days"] is None


def test_stale_funds_have_no_metrics_or_facts(spark):
    data = {"000001": list(zip(days_from("2024-01-01", 30), [1 + i / 100 for i in range(30)]))}
    table = series(spark, data)
    row = metrics.metric_snapshot(table, "2024-02-15").collect()[0]
    assert row.stale and row.annual_return is None and row.nav_end_date == day("2024-01-30")
    assert metrics.daily_facts(table, "2024-02-15").count() == 0
    assert metrics.period_facts(table, "2024-02-01").count() > 0


def test_truncation_equals_running_on_cut_data(spark):
    table = series(spark, {f"{i:06d}": random_series(i) for i in (3, 4, 9, 14)})
    cut = table.where("nav_date <= date'2019-12-31'")
    left = metrics.metric_snapshot(table, "2019-12-31", 9999, latest="2019-12-31").collect()
    right = metrics.metric_snapshot(cut, "2019-12-31", 9999).collect()
    assert sorted(left) == sorted(right)


def test_zero_nav_gives_infinite_change_not_an_error(spark):
    data = {"000001": list(zip(days_from("2024-01-01", 4), (1.0, 0.0, 0.0, 1.0)))}
    facts = by_key(metrics.daily_facts(series(spark, data), "2024-01-04"), "nav_date")
    assert facts[day("2024-01-03")]["daily_return"] is None
    assert facts[day("2024-01-04")]["daily_return"] == float("inf")


def test_snapshot_needs_one_shuffle(spark):
    """Every window and aggregate after the shuffle by fund reuses its partitioning and one sort."""
    table = series(spark, {"000001": random_series(3)})
    plan = metrics.metric_snapshot(table, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
