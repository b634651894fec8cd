"""Declared table rules per artifact and stage, checked as DataFrame aggregates."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from navloom.functions import text
from navloom.operators.metrics import METRICS
from navloom.sources import schemas

VIOLATION = "artifact string, rule string, columns string, bad_rows long, detail string"


@dataclass(frozen=True)
class TableContract:
    required: tuple[str, ...]
    non_null: tuple[str, ...] = ()
    unique_key: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    min_rows: int = 1


@dataclass(frozen=True)
class FundSetContract:
    """Rule for a long table of per-fund inputs: at least this many funds."""

    min_funds: int = 1


_CODE = ("fund_code",)
_PURCHASE = TableContract(
    required=(
        "fund_code",
        "short_name",
        "subscribe_status",
        "redeem_status",
        "purchase_min_amount",
        "daily_limit_amount",
        "purchase_fee",
    ),
    non_null=_CODE,
    unique_key=_CODE,
    numeric=("purchase_min_amount", "daily_limit_amount", "purchase_fee"),
)

# The rules per artifact.
CONTRACTS: dict[str, TableContract | FundSetContract] = {
    "purchase": _PURCHASE,
    "purchase_effective": _PURCHASE,
    "blacklist": TableContract(required=_CODE, min_rows=0),
    "overview": TableContract(
        required=("fund_code", "inception_text"), non_null=_CODE, unique_key=_CODE
    ),
    "candidates": TableContract(
        required=("fund_code", "is_filtered", "reasons"),
        non_null=("fund_code", "is_filtered"),
        unique_key=_CODE,
        allowed={"is_filtered": ("true", "false")},
    ),
    "purchase_filtered": TableContract(required=_CODE, non_null=_CODE, unique_key=_CODE),
    "scoreboard": TableContract(
        required=(
            "fund_code",
            "fund_name",
            "nav_start_date",
            "nav_end_date",
            "annual_return",
            "max_drawdown",
            "sharpe_ratio_1y",
            "sharpe_ratio_3y",
            "calmar_ratio_1y",
            "calmar_ratio_3y",
            "max_drawdown_recovery_days",
            "max_single_day_drop",
        ),
        non_null=("fund_code", "fund_name", "nav_start_date", "nav_end_date"),
        unique_key=_CODE,
        numeric=(
            "annual_return",
            "max_drawdown",
            "sharpe_ratio_1y",
            "sharpe_ratio_3y",
            "calmar_ratio_1y",
            "calmar_ratio_3y",
        ),
        dates=("nav_start_date", "nav_end_date"),
        min_rows=0,
    ),
    "scoreboard_to_recheck": TableContract(
        required=("fund_code", *METRICS), non_null=_CODE, unique_key=_CODE
    ),
    "calendar": TableContract(
        required=("trade_date",), non_null=("trade_date",), dates=("trade_date",)
    ),
    "nav": FundSetContract(),
    "bonus": FundSetContract(),
    "split": FundSetContract(),
    "personnel": FundSetContract(),
    "cum_return": FundSetContract(),
    "adjusted_nav": FundSetContract(),
    "compare_details": FundSetContract(),
    "integrity_details": FundSetContract(),
}

# The stages a run is checked at, by name, with (contract, name of the table handed in).
STAGES: dict[str, tuple[tuple[str, str], ...]] = {
    "fund_etl_step2_input": (("purchase", "purchase"),),
    "fund_etl_step3_input": (("purchase", "purchase"),),
    "fund_etl_step4_input": (("purchase", "purchase"),),
    "fund_etl_step5_input": (("purchase", "purchase"),),
    "fund_etl_step6_input": (("purchase", "purchase"),),
    "fund_etl_step7_input": (("purchase", "purchase"),),
    "fund_etl_step2_input_effective": (("purchase_effective", "purchase"),),
    "fund_etl_step3_input_effective": (("purchase_effective", "purchase"),),
    "fund_etl_step4_input_effective": (("purchase_effective", "purchase"),),
    "fund_etl_step5_input_effective": (("purchase_effective", "purchase"),),
    "fund_etl_step6_input_effective": (("purchase_effective", "purchase"),),
    "fund_etl_step7_input_effective": (("purchase_effective", "purchase"),),
    "build_effective_purchase_input": (("purchase", "purchase"),),
    "build_effective_purchase_output": (("purchase_effective", "purchase"),),
    "adjusted_nav_input": (("nav", "nav"), ("bonus", "bonus"), ("split", "split")),
    "integrity_input": (("adjusted_nav", "adjusted_nav"), ("overview", "overview"), ("calendar", "calendar")),
    "compare_input": (("adjusted_nav", "adjusted_nav"), ("cum_return", "cum_return")),
    "filter_input": (
        ("purchase", "purchase"),
        ("overview", "overview"),
        ("nav", "nav"),
        ("adjusted_nav", "adjusted_nav"),
        ("compare_details", "compare_details"),
        ("integrity_details", "integrity_details"),
    ),
    "scoreboard_input": (
        ("purchase_filtered", "purchase"),
        ("overview", "overview"),
        ("personnel", "personnel"),
        ("adjusted_nav", "adjusted_nav"),
    ),
    "scoreboard_output": (("scoreboard", "scoreboard"),),
    "filtered_candidates_output": (("candidates", "candidates"),),
    "filtered_purchase_output": (("purchase_filtered", "purchase"),),
    "verify_scoreboard_recalc_input": (("scoreboard_to_recheck", "scoreboard"), ("adjusted_nav", "adjusted_nav")),
}


def _violations(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, VIOLATION)


class RowRule(NamedTuple):
    """A rule that one aggregate over all rows decides: broken and bad rows are of the aggregate's row."""

    rule: str
    columns: str
    broken: Column
    bad: Column
    detail: str


def _row_rules(table: DataFrame, contract: TableContract) -> tuple[DataFrame, list[Column], list[RowRule]]:
    """The table with codes padded and text trimmed, the measures to aggregate, and the rules over them."""

    def cleaned(name: str) -> Column:
        # A code is padded before the check, so an empty one is "000000", never null.
        if name == "fund_code":
            return text.fund_code(F.coalesce(F.col(name).cast("string"), F.lit("")))
        return F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))

    touched = {c: cleaned(c) for c in (*contract.non_null, *contract.unique_key) if c in table.columns}
    work = table.withColumns(touched) if touched else table
    measures = [F.count("*").alias("n")]
    checks = [RowRule("min_rows", "", F.col("n") < contract.min_rows, F.col("n"), f"min_rows={contract.min_rows}")]
    for rule, names, bad_row in (
        ("non_null", contract.non_null, lambda c: cleaned(c) == ""),
        ("numeric", contract.numeric, lambda c: _filled(c) & text.to_number(F.col(c)).isNull()),
        ("date", contract.dates, lambda c: _filled(c) & text.to_date(F.col(c)).isNull()),
    ):
        for name in names:
            if name not in table.columns:
                continue
            measure = f"{rule}_{name}"
            measures.append(F.count_if(bad_row(name)).alias(measure))
            checks.append(RowRule(rule, name, F.col(measure) > 0, F.col(measure), ""))
    return work, measures, checks


def _filled(name: str) -> Column:
    value = F.col(name).cast("string")
    return value.isNotNull() & (value != "")


class Observed(NamedTuple):
    """A table whose rules are measured while it is written, and the violations afterwards."""

    table: DataFrame
    violations: Callable[[DataFrame], list[tuple]]


def observed(artifact: str, table: DataFrame, contract: TableContract) -> Observed:
    """The table with its row rules attached as metrics of whatever job writes it: no scan of its own.

    Call `violations` with the stored table after the write. Values outside an enumeration are counted
    in the same pass, as one number per column. Only a unique key costs an aggregate, over the key
    columns of the stored table. Missing columns end the check, as in `check_table`.
    """
    missing = [c for c in contract.required if c not in table.columns]
    _, measures, checks = _row_rules(table, contract)
    for name, values in contract.allowed.items():
        if name in table.columns:
            value = F.trim(F.col(name).cast("string"))
            filled = value != "" if name in (*contract.non_null, *contract.unique_key) else _filled(name)
            measures.append(F.count_if(filled & ~value.isin(*values)).alias(f"allowed_{name}"))
            checks.append(RowRule("allowed", name, F.col(f"allowed_{name}") > 0, F.col(f"allowed_{name}"), ""))
    seen = Observation()

    def violations(stored: DataFrame) -> list[tuple]:
        got = seen.get
        if "n" not in got:  # an empty plan measures nothing
            return [tuple(row) for row in check_table(artifact, stored, contract).collect()]
        count = got["n"]
        found = [(artifact, "required", ",".join(missing), 0, "missing required columns")] if missing else []
        if count < contract.min_rows:
            found.append((artifact, "min_rows", "", count, f"min_rows={contract.min_rows}"))
        if missing:
            return found
        for check in checks[1:]:
            bad = got[f"{check.rule}_{check.columns}"]
            if bad:
                found.append((artifact, check.rule, check.columns, bad, check.detail))
        repeated = _repeated_keys(_row_rules(stored, contract)[0], contract).first() if contract.unique_key else None
        if repeated:
            found.append((artifact, "unique_key", ",".join(contract.unique_key), repeated["bad_rows"], ""))
        return found

    return Observed(table.observe(seen, *measures), violations)


def _repeated_keys(work: DataFrame, contract: TableContract) -> DataFrame:
    """One row with the number of rows whose key is not their own, or none."""
    members = work.groupBy(*contract.unique_key).agg(F.count("*").alias("members")).where("members > 1")
    return members.agg(F.sum("members").alias("bad_rows")).where("bad_rows is not null")


def required(violations: list[tuple]) -> None:
    """Fail with the violations, a line for each."""
    if violations:
        raise ValueError(
            "; ".join(f"{rule} violated: {artifact} [{columns}] rows={bad} {detail}" for artifact, rule, columns, bad, detail in violations)
        )


def check_table(artifact: str, table: DataFrame, contract: TableContract) -> DataFrame:
    """Violations of one table (artifact, rule, columns, bad_rows, detail); empty when it is sound.

    One aggregate scan for the per-row rules, one grouping for the key, and one
    distinct per enumerated column. Missing columns end the check.
    """
    spark = table.sparkSession
    missing = [c for c in contract.required if c not in table.columns]
    if missing:
        rows = table.agg(F.count("*").alias("n")).where(F.col("n") < contract.min_rows)
        too_small = rows.select(
            F.lit(artifact).alias("artifact"),
            F.lit("min_rows").alias("rule"),
            F.lit("").alias("columns"),
            F.col("n").alias("bad_rows"),
            F.lit(f"min_rows={contract.min_rows}").alias("detail"),
        )
        absent = (artifact, "required", ",".join(missing), 0, "missing required columns")
        return _violations(spark, [absent]).unionByName(too_small)

    work, measures, checks = _row_rules(table, contract)
    found = [
        F.when(
            broken,
            F.struct(
                F.lit(artifact).alias("artifact"),
                F.lit(rule).alias("rule"),
                F.lit(columns).alias("columns"),
                bad.cast("long").alias("bad_rows"),
                F.lit(detail).alias("detail"),
            ),
        )
        for rule, columns, broken, bad, detail in checks
    ]
    result = work.agg(*measures).select(F.inline(F.array_compact(F.array(*found))))

    if contract.unique_key:
        result = result.unionByName(
            _repeated_keys(work, contract).select(
                F.lit(artifact).alias("artifact"),
                F.lit("unique_key").alias("rule"),
                F.lit(",".join(contract.unique_key)).alias("columns"),
                "bad_rows",
                F.lit("").alias("detail"),
            )
        )
    for name, values in contract.allowed.items():
        value = F.trim(F.col(name).cast("string"))
        others = (
            work.where(_filled(name))
            .select(value.alias("detail"))
            .where(~F.col("detail").isin(*values))
            .groupBy("detail")
            .agg(F.count("*").alias("bad_rows"))
        )
        result = result.unionByName(
            others.select(
                F.lit(artifact).alias("artifact"),
                F.lit("allowed").alias("rule"),
                F.lit(name).alias("columns"),
                "bad_rows",
                "detail",
            )
        )
    return result


def check_fund_set(artifact: str, table: DataFrame, contract: FundSetContract) -> DataFrame:
    """A violation if the long table has fewer funds than required."""
    funds = table.select("fund_code").distinct().agg(F.count("*").alias("bad_rows"))
    return funds.where(F.col("bad_rows") < contract.min_funds).select(
        F.lit(artifact).alias("artifact"),
        F.lit("min_funds").alias("rule"),
        F.lit("fund_code").alias("columns"),
        "bad_rows",
        F.lit(f"min_funds={contract.min_funds}").alias("detail"),
    )


def require_funds(tables: Mapping[str, DataFrame]) -> None:
    """Fail unless every long table of per-fund inputs has the funds its contract asks for."""
    found = [check_fund_set(name, table, CONTRACTS[name]) for name, table in tables.items()]
    required([tuple(row) for part in found for row in part.collect()])


def check_stage(spark: SparkSession, stage: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """All violations of a stage's inputs or outputs."""
    if stage not in STAGES:
        return _violations(spark, [(stage, "stage", "", 0, "unsupported stage")])
    result = _violations(spark, [])
    for name, key in STAGES[stage]:
        if key not in tables:
            found = _violations(spark, [(key, "artifact", "", 0, f"missing table for stage {stage}")])
        elif isinstance(CONTRACTS[name], TableContract):
            found = check_table(name, tables[key], CONTRACTS[name])
        else:
            found = check_fund_set(name, tables[key], CONTRACTS[name])
        result = result.unionByName(found)
    return result


def require_stage(spark: SparkSession, stage: str, tables: Mapping[str, DataFrame]) -> None:
    """Fail with the violations of a stage, a line for each rule and column with one example.

    The full table of violations is `check_stage`.
    """
    every = check_stage(spark, stage, tables)
    per_rule = every.groupBy("artifact", "rule", "columns").agg(
        F.sum("bad_rows").alias("bad_rows"), F.min("detail").alias("detail")
    )
    found = per_rule.orderBy("artifact", "rule", "columns").collect()
    required([(v.artifact, v.rule, v.columns, v.bad_rows, v.detail) for v in found])


# Columns each landed source must bring, by table: those of its schema, but the code where the file names it
# and the asset scale, which some overviews bring under another name.
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "purchase": tuple(schemas.PURCHASE.values()),
    "overview": tuple(n for n in schemas.OVERVIEW.values() if n != "asset_scale"),
    **{
        name: tuple(n for n in columns.values() if n != "fund_code")
        for name, columns in (("nav", schemas.NAV), ("bonus", schemas.BONUS), ("split", schemas.SPLIT), ("cum_return", schemas.CUM_RETURN))
    },
    "personnel": tuple(schemas.PERSONNEL.values()),
}
# The overview's asset scale lands from this source column.
ASSET_SCALE_SOURCE = "net_asset_scale"


def source_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per landed source: rows, columns, missing required columns, asset-scale source column."""
    reports = []
    for name, table in tables.items():
        missing = [c for c in SOURCE_COLUMNS[name] if c not in table.columns]
        renamed = ASSET_SCALE_SOURCE if name == "overview" and ASSET_SCALE_SOURCE in table.columns else ""
        reports.append(
            table.agg(F.count("*").alias("rows")).select(
                F.lit(name).alias("source"),
                "rows",
                F.lit(",".join(table.columns)).alias("columns"),
                F.lit(not missing).alias("complete"),
                F.lit(",".join(missing)).alias("missing_required"),
                F.lit(renamed).alias("asset_scale_source"),
            )
        )
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result
