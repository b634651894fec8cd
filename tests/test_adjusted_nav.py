import re

import pytest
from pyspark.sql import functions as F

from navloom.operators import adjusted_nav, consistency
from tests.helpers import by_key, day

BONUS = "fund_code string, ex_date date, per_share_text string"
SPLIT = "fund_code string, split_date date, ratio_text string"


@pytest.fixture
def tables(spark):
    nav = spark.createDataFrame(
        [("000001", day(f"2024-01-0{i}"), v) for i, v in ((1, 1.0), (2, 2.0), (3, 1.0))],
        "fund_code string, nav_date date, unit_nav double",
    )
    bonus = spark.createDataFrame([("000001", day("2024-01-02"), "每份派现金0.5元")], BONUS)
    split = spark.createDataFrame([("000001", day("2024-01-03"), "1:3")], SPLIT)
    return nav, bonus, split


def test_factors_accumulate(tables):
    rows = by_key(adjusted_nav.adjust(*tables), "nav_date")
    assert [rows[day(f"2024-01-0{i}")]["cumulative_factor"] for i in (1, 2, 3)] == [1.0, 1.25, 3.75]
    assert rows[day("2024-01-03")]["adjusted_nav"] == 3.75


def test_same_day_dividends_multiply_and_equal_ones_count_twice(spark, tables):
    nav, _, split = tables
    events = [("000001", day("2024-01-02"), t) for t in ("每份派现金0.5元", "每份派现金0.5元", "每份派现金1元")]
    rows = by_key(adjusted_nav.adjust(nav, spark.createDataFrame(events, BONUS), split), "nav_date")
    assert rows[day("2024-01-02")]["cumulative_factor"] == pytest.approx(1.25 * 1.25 * 1.5)


def test_non_positive_values_leave_the_nav_alone(spark, tables):
    nav, _, _ = tables
    zero = nav.withColumn("unit_nav", nav.unit_nav * 0)
    bonus = spark.createDataFrame([("000001", day("2024-01-02"), "0.5")], BONUS)
    split = spark.createDataFrame([("000001", day("2024-01-03"), "1:0")], SPLIT)
    assert {r.cumulative_factor for r in adjusted_nav.adjust(zero, bonus, split).collect()} == {1.0}


@pytest.mark.parametrize(
    "cutoff, rejected",
    [(None, True), ("2020-01-01", False), ("2020-01-02", False), ("2019-12-31", True)],
)
def test_event_without_nav(spark, tables, cutoff, rejected):
    nav, _, split = tables
    bonus = spark.createDataFrame([("000001", day("2020-01-01"), "0.5"), ("000009", day("2020-01-01"), "1")], BONUS)
    result = adjusted_nav.adjust_all(nav, bonus, split, allow_missing_until=cutoff)
    errors = by_key(result.rejects, "fund_code")
    if rejected:
        assert errors["000001"]["error"] == "missing nav data on dividend dates: 2020-01-01"
        assert result.adjusted.count() == 0
    else:
        assert not errors
        assert result.adjusted.count() == 3
        assert by_key(result.summary, "fund_code")["000001"]["rows"] == 3
    assert "000009" not in errors


def test_tolerance_is_all_or_nothing_and_names_dividends_first(spark, tables):
    nav, _, _ = tables
    bonus = spark.createDataFrame([("000001", day(d), "0.5") for d in ("2020-01-01", "2023-01-01")], BONUS)
    split = spark.createDataFrame([("000001", day("2023-06-01"), "1:2")], SPLIT)
    errors = by_key(adjusted_nav.adjust_all(nav, bonus, split, allow_missing_until="2021-01-01").rejects, "fund_code")
    assert errors["000001"]["error"] == "missing nav data on dividend dates: 2020-01-01,2023-01-01"
    only_split = adjusted_nav.adjust_all(nav, bonus, split, allow_missing_until="2023-03-01").rejects
    assert by_key(only_split, "fund_code")["000001"]["error"] == "missing nav data on split dates: 2023-06-01"


def test_missing_landed_data_and_done_funds(spark, tables):
    nav, bonus, split = tables
    codes = spark.createDataFrame([("000001",), ("000002",)], "fund_code string")
    none = codes.where("false")
    errors = by_key(adjusted_nav.adjust_all(nav, bonus, split, codes=codes, bonus_codes=none).rejects, "fund_code")
    assert errors["000001"]["error"] == "missing bonus files"
    assert errors["000002"]["error"] == "missing bonus files"
    skipped = adjusted_nav.adjust_all(nav, bonus, split, codes=codes, done=codes)
    assert skipped.adjusted.count() == 0 and skipped.rejects.count() == 0


def test_all_funds_take_one_shuffle_by_fund(tables):
    nav, bonus, split = tables
    result = adjusted_nav.adjust_all(nav, bonus, split, allow_missing_until="2020-01-01")
    plan = result.adjusted._jdf.queryExecution().executedPlan().toString()
    by_fund = [line for line in plan.splitlines() if "Exchange hashpartitioning(fund_code#" in line and "nav_date" not in line and "event_date" not in line]
    assert len(by_fund) == 1


def test_last_line_of_a_repeated_day_stays_and_is_counted(spark):
    rows = [("000001", "2024-01-02", 2.0, ("f", 0)), ("000001", "2024-01-02", 1.0, ("f", 1)), ("000001", "2024-01-03", 3.0, ("f", 2))]
    schema = "fund_code string, nav_date string, unit_nav double, line_order struct<file:string,row:int>"
    nav = spark.createDataFrame(rows, schema).withColumn("nav_date", F.to_date("nav_date"))
    assert sorted(r.unit_nav for r in adjusted_nav.one_row_per_day(nav).collect()) == [1.0, 3.0]
    assert sorted(r.unit_nav for r in adjusted_nav.one_row_per_day(nav.drop("line_order")).collect()) == [2.0, 3.0]
    assert [tuple(r) for r in adjusted_nav.repeated_days(nav).collect()] == [("000001", 1, 1)]
    adjusted = nav.withColumn("adjusted_nav", F.col("unit_nav"))
    remote = nav.select("fund_code", F.col("nav_date").alias("date"), (F.col("unit_nav") * 10).alias("cum_return_pct"), "line_order")
    both = consistency.both_sides(adjusted.drop("line_order"), remote).orderBy("date").collect()
    assert [(r.local, r.remote) for r in both] == [(2.0, 10.0), (3.0, 30.0)]


def test_days_of_a_task_are_not_held_in_hash_tables(tables):
    """NAV days are sorted once for aggregate and join, and not grouped again behind the join."""
    plan = adjusted_nav.adjust(*tables)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(?<!Object)HashAggregate\(keys=\[fund_code#\d+, nav_date#", plan)
