import pytest
from pyspark.sql import functions as F

from navloom.operators import metrics, normalise, score, scoreboard
from tests.helpers import by_key, day, days_from, series


def linear(start, count, step=7, slope=0.01):
    return [(d, 1 + i * slope - (0.02 if i % 5 == 3 else 0)) for i, d in enumerate(days_from(start, count, step))]


@pytest.fixture
def inputs(spark):
    """1 complete, 2 stale, 3 too short for some metrics, 4 without series, 9 not listed."""
    data = {
        "000001": linear("2019-01-04", 262),
        "000002": linear("2019-01-04", 100),
        "000003": [(day("2024-01-05"), 1.0)],
        "000009": linear("2019-01-04", 262),
    }
    listed = [(c, "n" + c) for c in ("1", "2", "3", "4", "4")]
    purchase = spark.createDataFrame(
        [(c, n, "开放申购", "开放赎回", "---", "10", "1e5", "0.15%") for c, n in listed],
        "fund_code string, short_name string, subscribe_status string, redeem_status string, "
        "next_open_day string, purchase_min_amount string, daily_limit_amount string, purchase_fee string",
    )
    overview = spark.createDataFrame(
        [(c, None if c == "1" else "o" + c, "f", "t", "2010年1月2日", "3.5亿元", "1%", "0.2%", "---", "1.2%") for c in "1234"],
        "fund_code string, short_name string, full_name string, fund_type string, inception_text string, "
        "asset_scale string, mgmt_fee string, custody_fee string, sales_fee string, max_subscribe_fee string",
    )
    notices = spark.createDataFrame([("000001", day("2020-05-05"))], "fund_code string, notice_date date")
    dim = normalise.dim_base(purchase, overview, normalise.latest_personnel_date(notices), "v1", "2024-01-05")
    table = series(spark, data)
    return table, dim, metrics.metric_snapshot(table, "2024-01-05")


def test_kept_and_excluded(inputs):
    _, dim, measured = inputs
    result = scoreboard.build(measured, dim, "v1", "2024-01-05")
    assert [r.fund_code for r in result.kept.collect()] == ["000001"]
    assert result.kept.columns == list(scoreboard.SCOREBOARD_COLUMNS) and len(result.kept.columns) == 56
    detail = {(r.fund_code, r.reason_code): r.reason_detail for r in result.exclusion_detail.collect()}
    assert set(detail) == {
        ("000002", "stale_nav_date"), ("000002", "missing_nav"), ("000004", "missing_nav"), ("000003", "metric_null"),
    }
    names = detail[("000003", "metric_null")].split(", ")
    assert names == sorted(names) and "annual_return" in names
    counts = by_key(result.exclusion_summary, "reason_code")
    assert counts["missing_nav"]["fund_count"] == 2


def test_dim_falls_back_to_the_purchase_name(inputs):
    _, dim, _ = inputs
    rows = by_key(dim, "fund_code")
    assert len(dim.columns) == 23 and len(rows) == 4
    assert rows["000001"]["fund_name"] == "n1" and rows["000002"]["fund_name"] == "o2"
    assert rows["000001"]["last_personnel_change_date"] == day("2020-05-05")
    assert rows["000001"]["inception_years"] == pytest.approx(5116 / 365.25)


def test_export_and_recheck_round_trip(spark, inputs):
    table, dim, measured = inputs
    board = scoreboard.build(measured, dim, "v1", "2024-01-05").kept
    exported = scoreboard.export(board)
    assert len(exported.columns) == 54
    shown = spark.createDataFrame(exported.collect(), exported.schema)
    again = scoreboard.recheck(scoreboard.from_export(shown), table)
    assert [(r.passed, r.failed_fields) for r in again.summary.collect()] == [(True, "")]
    assert again.detail.count() == 33 and again.recalculated.count() == 1
    wrong = scoreboard.from_export(shown).withColumn("annual_return", F.col("annual_return") + 0.01)
    failed = scoreboard.recheck(wrong, table).summary.collect()
    assert [(r.passed, r.failed_fields) for r in failed] == [(False, "年化收益率")]


def test_recheck_row_limit(inputs):
    table, dim, measured = inputs
    board = scoreboard.export(scoreboard.build(measured, dim, "v1", "2024-01-05").kept, headers="ours")
    with pytest.raises(ValueError, match="more than 0 rows"):
        scoreboard.recheck(board, table, max_rows=0)
    with pytest.raises(ValueError, match="misses columns"):
        scoreboard.recheck(board.drop("max_drawdown"), table)


def brute_rank(values):
    return [1 + sum(o > v for o in values) for v in values]


def test_global_rank_with_heavy_ties(spark):
    values = [float(v % 7) for v in range(300)] + [0.5] * 400 + [i / 997 for i in range(500)]
    table = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = [r["rank"] for r in score.global_rank(table, "v", range_rows=16).orderBy("i").collect()]
    assert got == brute_rank(values)


def test_composite_score_against_definition(spark):
    import random

    random.seed(5)
    rows = [[random.choice([None, round(random.uniform(-5, 30), 2)]) for _ in score.INPUTS] for _ in range(40)]
    for row in rows:
        row[3] = 7.0  # all equal: neutral for everyone
    schema = "fund_code string, " + ", ".join(f"{n} double" for n in score.INPUTS)
    table = spark.createDataFrame([(f"{i:06d}", *r) for i, r in enumerate(rows)], schema)
    got = by_key(score.composite_score(table), "fund_code")
    totals = []
    for i, row in enumerate(rows):
        values, total = dict(zip(score.INPUTS, row)), 0.0
        for weight, inputs in score.GROUPS.values():
            part = 0.0
            for name, share, better in inputs:
                column = [r[score.INPUTS.index(name)] for r in rows if r[score.INPUTS.index(name)] is not None]
                low, high = min(column), max(column)
                position = 0.5
                if values[name] is not None and low != high:
                    position = (values[name] - low) / (high - low)
                    position = position if better else 1 - position
                part += share * position
            total += weight * part
        totals.append(total)
        assert got[f"{i:06d}"]["score"] == pytest.approx(total)
    assert [got[f"{i:06d}"]["rank"] for i in range(40)] == brute_rank(totals)


def test_absent_inputs_reweight_their_group(spark):
    table = spark.createDataFrame([("1", 1.0), ("2", 3.0)], "fund_code string, max_drawdown_1y double")
    got = by_key(score.composite_score(table), "fund_code")
    assert got["1"]["score_risk_control"] == 1.0 and got["2"]["score_risk_control"] == 0.0
    assert got["1"]["rank"] == 1 and got["1"]["score_long_term"] == 0.0
