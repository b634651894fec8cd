import pytest
from pyspark.sql import functions as F

from navloom.operators import candidates, consistency, contracts, integrity
from tests.helpers import by_key, day

ADJUSTED = "fund_code string, nav_date date, adjusted_nav double"
CUM = "fund_code string, date date, cum_return_pct double"


def adjusted(spark, rows):
    return spark.createDataFrame([(c, day(d), v) for c, d, v in rows], ADJUSTED)


def cum(spark, rows):
    return spark.createDataFrame([(c, day(d), v) for c, d, v in rows], CUM)


def test_compare_counts_and_buckets(spark):
    local = adjusted(
        spark,
        [("000001", f"2024-01-0{i}", v) for i, v in ((1, 1.00), (2, 1.06), (3, 1.05), (4, 1.08), (5, 2.0))],
    )
    remote = cum(spark, [("000001", f"2024-01-0{i}", v) for i, v in ((1, 0.0), (3, 1.05), (4, 1.08))])
    result = consistency.compare(local, remote)
    row = result.summary.collect()[0]
    assert (row.compared_days, row.skipped_days, row.ge10, row.missing) == (2, 1, 2, False)
    assert row.ge10_share == 1.0 and result.errors.count() == 0
    texts = by_key(consistency.detail_text(result.detail), "start_date")
    assert texts[day("2024-01-01")]["local_return"] == f"{(1.08 - 1.0) / 1.0:.10f}"
    shown = consistency.summary_text(result.summary).collect()[0]
    assert shown["数据是否缺失"] == "否" and shown["10%以上偏差占比"] == "100.00%"


def test_compare_errors(spark):
    local = adjusted(spark, [("000001", "2024-01-01", 1.0), ("000003", "2024-01-01", 1.0)])
    remote = cum(spark, [("000002", "2024-01-01", 1.0), ("000003", "2024-01-02", 1.0)])
    result = consistency.compare(local, remote)
    errors = {r.fund_code: r.error for r in result.errors.collect()}
    assert errors == {
        "000001": "fund file missing: cum_return_missing",
        "000002": "fund file missing: adjusted_nav_missing",
        "000003": "no common date found",
    }
    assert result.detail.count() == 0
    assert {(r.missing, r.compared_days, r.skipped_days) for r in result.summary.collect()} == {(True, 0, 0)}


def test_zero_local_return_has_no_deviation(spark):
    local = adjusted(spark, [("000001", "2024-01-01", 1.0), ("000001", "2024-01-02", 1.0)])
    remote = cum(spark, [("000001", "2024-01-01", 0.0), ("000001", "2024-01-02", 5.0)])
    row = consistency.detail(local, remote).collect()[0]
    assert row.deviation is None and row.bucket == "-"


def test_integrity(spark):
    series = adjusted(spark, [("000001", "2024-01-02", 1.0), ("000002", "2024-01-02", 1.0), ("000003", "2024-01-02", 1.0)])
    overview = spark.createDataFrame(
        [("1", "2020年1月1日"), ("2", "2024-06-01"), ("3", "unknown")], "fund_code string, inception_text string"
    )
    calendar = spark.createDataFrame([("2024-01-02",), ("2024-01-03",), ("bad",), ("2025-01-01",)], "trade_date string")
    args = (series, overview, calendar, "2024-01-01", "2024-12-31")
    assert {r.fund_code: r.ratio for r in integrity.summary(*args).collect()} == {"000001": 0.5, "000003": 0.5}
    flags = {(r.fund_code, str(r.trade_date)): r.exists for r in integrity.detail(*args).collect()}
    assert flags[("000001", "2024-01-02")] and not flags[("000001", "2024-01-03")] and len(flags) == 4
    empty = integrity.summary(series, overview, calendar, "2023-01-01", "2023-12-31")
    assert {r.ratio for r in empty.collect()} == {0.0}
    with pytest.raises(ValueError, match="must not be after"):
        integrity.detail(series, overview, calendar, "2024-02-01", "2024-01-01")


def test_candidate_rules(spark):
    def codes(*names):
        return spark.createDataFrame([(n,) for n in names], "fund_code string")

    everyone = [f"00000{i}" for i in range(1, 8)]
    details = spark.createDataFrame(
        [
            (c, day(d), v)
            for c, d, v in [
                ("000001", "2024-01-01", 0.00999), ("000002", "2024-01-01", 0.0), ("000003", "2024-01-01", 0.0),
                ("000004", "2024-01-01", -0.02), ("000005", "2022-01-01", 0.0), ("000006", "2024-01-01", None),
                ("000007", "2024-01-01", 0.01999999999),
            ]
        ],
        "fund_code string, start_date date, deviation double",
    )
    whole = spark.createDataFrame(
        [(c, day(d), e) for c, d, e in [(c, "2024-01-02", c != "000007") for c in everyone if c != "000006"]],
        "fund_code string, trade_date date, exists boolean",
    )
    got = by_key(
        candidates.filter_candidates(
            codes(*everyone),
            codes(*[c for c in everyone if c != "000002"]),
            codes(*everyone),
            codes(*[c for c in everyone if c != "000003"]),
            details,
            whole,
        ),
        "fund_code",
    )
    assert not got["000001"]["is_filtered"] and got["000001"]["reasons"] == ""
    assert got["000002"]["reasons"].startswith("规则1") and got["000003"]["reasons"].startswith("规则3")
    assert got["000004"]["reasons"] == "规则4: 指定日期后存在偏差>=2.00%"
    assert got["000005"]["reasons"] == "规则4: 指定日期后无任何比对记录"
    assert got["000006"]["reasons"] == "规则5: trade day integrity details 缺失"
    # 0.01999999999 is exported as 0.0200000000, which reaches the limit.
    assert got["000007"]["reasons"] == "规则4: 指定日期后存在偏差>=2.00%；规则5: 指定日期后存在交易日数据不完整"


def test_blacklist_and_lists(spark):
    purchase = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "fund_code string, short_name string")
    black = spark.createDataFrame([("000002",)], "fund_code string")
    result = candidates.effective_purchase(purchase, black)
    assert sorted(r.fund_code for r in result.purchase.collect()) == ["000001", "000003"]
    assert tuple(result.counts.collect()[0]) == (3, 1, 2)
    everyone = spark.createDataFrame([("000001",), ("000002",), ("000003",)], "fund_code string")
    with pytest.raises(ValueError):
        candidates.effective_purchase(purchase, everyone)
    with pytest.raises(ValueError):
        candidates.filtered_purchase(purchase, everyone.withColumn("is_filtered", F.lit(True)))
    log = spark.createDataFrame([("nav", "2"), ("nav", ""), ("bonus", "1"), (None, "3")], "stage string, code string")
    assert [r.fund_code for r in candidates.retry_list(purchase, log, "nav").collect()] == ["000002"]
    assert {(r.stage, r.failures) for r in candidates.failures_by_stage(log).collect()} == {
        ("nav", 2), ("bonus", 1), ("unknown", 1),
    }


def test_pinned_sample_keeps_or_blanks_the_pinned_row(spark):
    rows = [(str(i), f"n{i}") for i in range(1, 31)]
    table = spark.createDataFrame(rows, "fund_code string, short_name string")
    order = [F.col("fund_code").cast("int")]
    blank = by_key(candidates.pinned_sample(table, order), "fund_code")
    assert len(blank) == 21 and blank["163402"]["short_name"] == "" and "000020" in blank and "000021" not in blank
    found = by_key(candidates.pinned_sample(table, order, pinned="000005"), "fund_code")
    assert len(found) == 21 and found["000005"]["short_name"] == "n5" and "000021" in found


def test_contract_violations(spark):
    contract = contracts.TableContract(
        required=("fund_code", "flag"), non_null=("fund_code", "flag"), unique_key=("fund_code",),
        numeric=("n",), dates=("d",), allowed={"flag": ("是", "否")},
    )
    table = spark.createDataFrame(
        [("1", "是", "1", "2024-01-01"), ("1", "maybe", "x", "2024-13-01"), (None, " ", "", None), ("", "否", None, "")],
        "fund_code string, flag string, n string, d string",
    )
    found = {(r.rule, r.columns): (r.bad_rows, r.detail) for r in contracts.check_table("t", table, contract).collect()}
    assert found == {
        ("non_null", "flag"): (1, ""),
        ("numeric", "n"): (1, ""),
        ("date", "d"): (1, ""),
        ("unique_key", "fund_code"): (4, ""),
        ("allowed", "flag"): (1, "maybe"),
    }
    missing = contracts.check_table("t", table.drop("flag"), contract).collect()
    assert [(r.rule, r.columns) for r in missing] == [("required", "flag")]
    small = contracts.check_table("t", table.where("false"), contract).collect()
    assert [(r.rule, r.detail) for r in small] == [("min_rows", "min_rows=1")]


def test_stages(spark):
    assert len(contracts.STAGES) == 23 and len(contracts.CONTRACTS) == 17
    assert [r.rule for r in contracts.check_stage(spark, "nowhere", {}).collect()] == ["stage"]
    assert [r.rule for r in contracts.check_stage(spark, "compare_input", {}).collect()] == ["artifact", "artifact"]
    codes = spark.createDataFrame([("1",)], "fund_code string")
    contracts.require_stage(spark, "compare_input", {"adjusted_nav": codes, "cum_return": codes})
    with pytest.raises(ValueError, match="min_funds"):
        contracts.require_stage(spark, "compare_input", {"adjusted_nav": codes, "cum_return": codes.where("false")})


def test_observed_rules_are_those_of_a_check(spark, tmp_path):
    contract = contracts.TableContract(
        required=("fund_code", "flag", "n", "d"), non_null=("flag",), unique_key=("fund_code",), numeric=("n",), dates=("d",),
        allowed={"flag": ("yes", "no")}, min_rows=2,
    )
    rows = [("1", "yes", "1", "2024-01-01"), ("000001", "maybe", "x", "bad"), ("2", " ", "2", ""), ("", "no", None, None), (None, "no", "", "")]
    table = spark.createDataFrame(rows, "fund_code string, flag string, n string, d string")
    for number, given in enumerate((table, table.limit(1), table.where("false"), table.drop("flag"), spark.createDataFrame([], table.schema))):
        seen = contracts.observed("t", given, contract)
        seen.table.write.parquet(str(tmp_path / str(number)))
        got = seen.violations(spark.read.schema(given.schema).parquet(str(tmp_path / str(number))))
        want = contracts.check_table("t", given, contract).collect()
        assert {v[:4] for v in got} == {tuple(v)[:4] for v in want}
