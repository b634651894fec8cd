"""Small wrong answers of earlier rounds: infinities, absent columns, order terms, contract stages."""

import pytest
from navloom.operators import backtest, contracts, metrics, score, scoreboard
from tests.helpers import day


def test_infinite_and_missing_scores(spark):
    name = next(iter(score.INPUTS))
    rows = [(1, 1.0), (2, 2.0), (3, float("inf")), (4, None), (5, float("nan"))]
    table = spark.createDataFrame(rows, f"i int, {name} double")
    got = {r.i: r.score for r in score.composite_score(table, ranked=False).collect()}
    assert all(v == v for v in got.values())
    assert got[4] == got[5] == got[3]


def test_null_and_nan_have_no_rank(spark):
    rows = [(1, 2.0), (2, float("nan")), (3, None), (4, 2.0), (5, 1.0)]
    ranked = score.global_rank(spark.createDataFrame(rows, "i int, v double"), "v", range_rows=1)
    assert {r.i: r["rank"] for r in ranked.collect()} == {1: 1, 4: 1, 5: 3, 2: None, 3: None}


def test_daily_facts_without_unit_nav(spark):
    table = spark.createDataFrame([("000001", day("2024-01-02"), 1.0)], "fund_code string, nav_date date, adjusted_nav double")
    assert metrics.daily_facts(table, "2024-01-03").collect()[0].unit_nav is None


def test_export_of_absent_columns_can_be_written(spark, tmp_path):
    exported = scoreboard.export(spark.createDataFrame([("000001",)], "fund_code string"))
    assert len(exported.columns) == 54 and all(kind != "void" for _, kind in exported.dtypes)
    exported.write.parquet(str(tmp_path / "board"))


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("nulls_share DESC", "nulls_share DESC NULLS LAST"),
        ("a, b desc nulls  first", "a NULLS LAST, b desc nulls  first"),
        ("coalesce(a, b)", "coalesce(a, b) NULLS LAST"),
    ],
)
def test_order_terms(given, expected):
    assert backtest.order_terms(given) == expected


def test_candidates_contract_takes_our_own_table(spark):
    own = spark.createDataFrame([("000001", True, "x"), ("000002", False, "")], "fund_code string, is_filtered boolean, reasons string")
    contracts.require_stage(spark, "filtered_candidates_output", {"candidates": own})
    other = own.selectExpr("fund_code", "cast(fund_code as string) is_filtered", "reasons")
    many = other.selectExpr("fund_code", "explode(transform(sequence(1, 150), i -> concat('v', i))) is_filtered", "reasons")
    with pytest.raises(ValueError, match=r"allowed violated: candidates \[is_filtered\] rows=300 .*unique_key violated"):
        contracts.require_stage(spark, "filtered_candidates_output", {"candidates": many})
