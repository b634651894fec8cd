"""Scoreboard of one version: funds kept, funds excluded with reasons, export and recheck."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.functions import display, text
from navloom.operators.metrics import METRICS, metric_snapshot

# Exclusion reasons. The stale text is constant whatever the allowed age is.
STALE, STALE_DETAIL = "stale_nav_date", "latest nav date older than as_of_date-2"
MISSING, MISSING_DETAIL = "missing_nav", "no adjusted nav data"
NULL_METRIC = "metric_null"

# Exported columns as (our name, exported header, display style).
EXPORT = (
    ("fund_code", "基金代码", "raw"),
    ("fund_name", "基金名称", "raw"),
    ("nav_start_date", "期初日期", "date"),
    ("nav_end_date", "期末日期", "date"),
    ("scale_billion", "规模-亿元", "round2"),
    ("inception_years", "成立年数", "round2"),
    ("annual_return", "年化收益率", "percent2"),
    ("up_quarter_ratio", "上涨季度比例", "percent0"),
    ("up_month_ratio", "上涨月份比例", "percent0"),
    ("up_week_ratio", "上涨星期比例", "percent0"),
    ("quarter_return_std", "季涨跌幅标准差", "percent2"),
    ("month_return_std", "月涨跌幅标准差", "percent2"),
    ("week_return_std", "周涨跌幅标准差", "percent2"),
    ("max_drawdown", "最大回撤率", "percent2"),
    ("annual_return_3y", "近3年年化收益率", "percent2"),
    ("up_quarter_ratio_3y", "近3年上涨季度比例", "percent0"),
    ("up_month_ratio_3y", "近3年上涨月份比例", "percent0"),
    ("up_week_ratio_3y", "近3年上涨星期比例", "percent0"),
    ("quarter_return_std_3y", "近3年季涨跌幅标准差", "percent2"),
    ("month_return_std_3y", "近3年月涨跌幅标准差", "percent2"),
    ("week_return_std_3y", "近3年周涨跌幅标准差", "percent2"),
    ("max_drawdown_3y", "近3年最大回撤率", "percent2"),
    ("annual_return_1y", "近1年年化收益率", "percent2"),
    ("up_month_ratio_1y", "近1年上涨月份比例", "percent0"),
    ("up_week_ratio_1y", "近1年上涨星期比例", "percent0"),
    ("month_return_std_1y", "近1年月涨跌幅标准差", "percent2"),
    ("week_return_std_1y", "近1年周涨跌幅标准差", "percent2"),
    ("max_drawdown_1y", "近1年最大回撤率", "percent2"),
    ("recent_month_return", "最近一个月涨跌幅", "percent2"),
    ("sharpe_ratio_1y", "近1年夏普比率", "round2"),
    ("sharpe_ratio_3y", "近3年夏普比率", "round2"),
    ("calmar_ratio_1y", "近1年卡玛比率", "round2"),
    ("calmar_ratio_3y", "近3年卡玛比率", "round2"),
    ("max_drawdown_recovery_days", "全期最长回撤修复天数", "int"),
    ("max_drawdown_recovery_days_1y", "近1年最长回撤修复天数", "int"),
    ("max_drawdown_recovery_days_3y", "近3年最长回撤修复天数", "int"),
    ("max_single_day_drop", "全期最大单日跌幅", "percent2"),
    ("max_single_day_drop_1y", "近1年最大单日跌幅", "percent2"),
    ("max_single_day_drop_3y", "近3年最大单日跌幅", "percent2"),
    ("fund_type", "基金类型", "raw"),
    ("subscribe_status", "申购状态", "raw"),
    ("redeem_status", "赎回状态", "raw"),
    ("next_open_day", "下一开放日", "date"),
    ("purchase_min_amount", "购买起点", "round2"),
    ("daily_limit_amount", "日累计限定金额", "round2"),
    ("management_fee_rate", "管理费率", "percent2"),
    ("custodian_fee_rate", "托管费率", "percent2"),
    ("sales_service_fee_rate", "销售服务费率", "percent2"),
    ("max_subscribe_fee_rate", "最高认购费率", "percent2"),
    ("fee_source_max_subscribe", "最高认购费率来源", "raw"),
    ("purchase_fee_rate", "手续费", "percent2"),
    ("fee_source_purchase", "手续费来源", "raw"),
    ("last_updated_date", "最近更新日期", "date"),
    ("last_personnel_change_date", "最近人事变动日期", "date"),
)
_SPEC = {name: (header, style) for name, header, style in EXPORT}
RECHECK_FIELDS = tuple((name, *_SPEC[name]) for name in METRICS)

# Columns of the stored snapshots.
METRICS_COLUMNS = ("data_version", "as_of_date", "fund_code", "nav_start_date", "nav_end_date", *METRICS)
SCOREBOARD_COLUMNS = ("data_version", "as_of_date", *[name for name, _, _ in EXPORT])


class Scoreboard(NamedTuple):
    kept: DataFrame
    exclusion_detail: DataFrame
    exclusion_summary: DataFrame


def _null_metric() -> Column:
    return F.array_contains(F.array(*[F.col(name).isNull() for name in METRICS]), True)


def metrics_with_dim(metrics: DataFrame, dim: DataFrame) -> DataFrame:
    """Fresh funds that are both measured and in the dimension (inner)."""
    return metrics.where(~F.col("stale")).drop("stale").join(dim, "fund_code", "inner")


def without_metrics(dim: DataFrame, metrics: DataFrame) -> DataFrame:
    """Funds of the dimension without usable metrics."""
    return dim.join(metrics.where(~F.col("stale")), "fund_code", "left_anti")


def complete_only(scored: DataFrame) -> DataFrame:
    """Funds with a value in every metric."""
    return scored.dropna(how="any", subset=list(METRICS))


def assess(metrics: DataFrame, dim: DataFrame, data_version: str, as_of: str) -> DataFrame:
    """Every fund of either side with its exclusion reasons; one join serves all results."""
    measured = metrics.withColumn("measured", F.lit(True))
    known = dim.drop("data_version", "as_of_date").withColumn("in_dim", F.lit(True))
    joined = measured.join(known, "fund_code", "full_outer")
    in_dim = F.coalesce("in_dim", F.lit(False))
    measured_flag = F.coalesce("measured", F.lit(False))
    stale = F.coalesce("stale", F.lit(False))
    fresh = measured_flag & ~stale

    def reason(holds: Column, code: str, detail: Column) -> Column:
        return F.when(
            holds, F.struct(F.lit(code).alias("reason_code"), detail.alias("reason_detail"))
        )

    null_names = display.names_where(
        [(name, F.col(name).isNull()) for name in METRICS], ", ", in_order=False
    )
    reasons = F.array_compact(
        F.array(
            reason(stale, STALE, F.lit(STALE_DETAIL)),
            reason(in_dim & ~fresh, MISSING, F.lit(MISSING_DETAIL)),
            reason(in_dim & fresh & _null_metric(), NULL_METRIC, null_names),
        )
    )
    return joined.select(
        F.lit(data_version).alias("data_version"),
        F.lit(as_of).cast("date").alias("as_of_date"),
        *[c for c in joined.columns if c not in ("measured", "in_dim", "stale")],
        reasons.alias("reasons"),
        (in_dim & fresh).alias("scored"),
    )


def kept_funds(assessed: DataFrame) -> DataFrame:
    kept = assessed.where(F.col("scored") & (F.size("reasons") == 0))
    return kept.select(*SCOREBOARD_COLUMNS)


def exclusion_detail(assessed: DataFrame) -> DataFrame:
    return assessed.select("data_version", "as_of_date", "fund_code", F.inline("reasons"))


def exclusion_summary(detail: DataFrame) -> DataFrame:
    return detail.groupBy("data_version", "as_of_date", "reason_code").agg(
        F.count("*").alias("fund_count")
    )


def build(metrics: DataFrame, dim: DataFrame, data_version: str, as_of: str) -> Scoreboard:
    assessed = assess(metrics, dim, data_version, as_of)
    detail = exclusion_detail(assessed)
    return Scoreboard(kept_funds(assessed), detail, exclusion_summary(detail))


def export(scoreboard: DataFrame, headers: str = "exported") -> DataFrame:
    """The 54 exported columns in display form; an absent source column is null.

    The values shown with two decimals are rounded as one array: the rounding is then
    in the plan once and not once per column, which would outgrow generated code.
    """
    scale = {"round2": 1.0, "percent2": 100.0}
    decimals = [
        (name, style) for name, _, style in EXPORT if style in scale and name in scoreboard.columns
    ]
    values = [
        F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")) * F.lit(scale[style])
        for name, style in decimals
    ]
    places = {name: i for i, (name, _) in enumerate(decimals)}
    table = scoreboard.withColumn(
        "rounded", F.transform(F.array(*values), lambda v: display.round_exact(v, 2))
    )

    def shown(name: str, style: str) -> Column:
        if name in places:
            return F.col("rounded")[places[name]]
        return display.styled(F.col(name) if name in scoreboard.columns else F.lit(None).cast("string"), style)

    return table.select(
        *[shown(name, style).alias(header if headers == "exported" else name) for name, header, style in EXPORT]
    )


class Recheck(NamedTuple):
    detail: DataFrame  # fund_code, field, old, new, passed
    summary: DataFrame  # fund_code, passed, failed_fields
    recalculated: DataFrame  # fund_code and the 33 metrics


def _guard_rows(exported: DataFrame, max_rows: int | None) -> None:
    if max_rows is None:
        return
    # Counting stops right above the limit instead of counting everything.
    seen = exported.select("fund_code").limit(max_rows + 1).count()
    if seen > max_rows:
        raise ValueError(f"scoreboard has more than {max_rows} rows; the recheck needs all of them")


def recheck(
    exported: DataFrame,
    adjusted: DataFrame,
    max_rows: int | None = None,
    latest: str | None = None,
) -> Recheck:
    """Recompute the metrics and compare them, as displayed, with an exported scoreboard.

    `exported` has the exported values under our names. Staleness plays no role here.
    """
    missing = [header for name, header, _ in RECHECK_FIELDS if name not in exported.columns]
    if missing:
        raise ValueError(f"scoreboard misses columns to check: {missing}")
    _guard_rows(exported, max_rows)
    board = exported.withColumn("fund_code", text.fund_code(F.col("fund_code")))
    wanted = board.select("fund_code").distinct()
    measured = metric_snapshot(
        adjusted.join(wanted, "fund_code", "left_semi"), F.col("end_date"), 0, latest
    )
    recalculated = wanted.join(measured.select("fund_code", *METRICS), "fund_code", "left")
    old = board.select("fund_code", *[F.col(n).alias(f"old_{n}") for n in METRICS])
    both = old.join(measured.select("fund_code", *METRICS), "fund_code", "left")

    # Long form first: the rounding below is then one expression instead of one per field.
    fields = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(header).alias("field"),
            F.lit(style).alias("style"),
            F.col(f"old_{name}").cast("string").alias("old"),
            F.col(name).alias("new"),
        )
        for position, (name, header, style) in enumerate(RECHECK_FIELDS)
    ]
    long = both.select("fund_code", F.inline(F.array(*fields)))
    whole = F.col("style").isin("int", "percent0")
    percent = F.when(F.col("style").startswith("percent"), F.lit(100.0)).otherwise(F.lit(1.0))

    def shown(value: Column) -> Column:
        return F.when(whole, F.rint(value)).otherwise(display.round_exact(value, 2))

    compared = (
        long.withColumns({"old": F.trim("old").try_cast("double"), "new": F.col("new") * percent})
        .withColumns({"old": shown(F.col("old")), "new": shown(F.col("new"))})
        .withColumn("passed", display.same_displayed(F.col("old"), F.col("new")))
    )
    failed = F.array_sort(
        F.collect_list(F.when(~F.col("passed"), F.struct("position", "field")))
    )
    return Recheck(
        compared.select("fund_code", "field", "old", "new", "passed"),
        compared.groupBy("fund_code").agg(
            F.bool_and("passed").alias("passed"),
            F.array_join(F.transform(failed, lambda f: f["field"]), ",").alias("failed_fields"),
        ),
        recalculated,
    )


def from_export(exported: DataFrame) -> DataFrame:
    """An exported scoreboard back under our names."""
    return exported.select(
        *[F.col(f"`{header}`").alias(name) for name, header, _ in EXPORT if header in exported.columns]
    )
