"""Landed text tables to typed tables, and the fund dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.functions import text
from navloom.operators.dedupe import keep_first
from navloom.sources.files import LINE_ORDER
from navloom.sources.schemas import OVERVIEW, PURCHASE


def _with_optional(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Optional source columns that are absent become empty text."""
    absent = {name: F.lit("") for name in names if name not in table.columns}
    return table.withColumns(absent) if absent else table


def _require(table: DataFrame, names: Sequence[str]) -> None:
    missing = [name for name in names if name not in table.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def purchase(raw: DataFrame) -> DataFrame:
    """Purchase list with padded codes; all eight columns are required."""
    names = list(PURCHASE.values())
    _require(raw, names)
    return raw.select(text.fund_code(F.col("fund_code")).alias("fund_code"), *names[1:])


def overview(raw: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """First row per code, trimmed, null as empty text; takes the source's asset-scale name."""
    table = raw
    if "net_asset_scale" in raw.columns and "asset_scale" not in raw.columns:
        table = raw.withColumnRenamed("net_asset_scale", "asset_scale")
    names = list(OVERVIEW.values())
    table = _with_optional(table, names).withColumn("fund_code", text.fund_code(F.col("fund_code")))
    return keep_first(table, ["fund_code"], order).select(
        "fund_code",
        *[F.coalesce(text.stripped(F.col(name)), F.lit("")).alias(name) for name in names[1:]],
    )


def nav(raw: DataFrame) -> DataFrame:
    """Unit NAV with parsed dates and numbers; rows without either are dropped."""
    _require(raw, ["nav_date", "unit_nav"])
    table = _with_optional(raw, ["daily_growth"])
    lines = [LINE_ORDER] if LINE_ORDER in raw.columns else []
    return table.select(
        text.fund_code(F.col("fund_code")).alias("fund_code"),
        text.to_date(F.col("nav_date")).alias("nav_date"),
        text.to_number(F.col("unit_nav")).alias("unit_nav"),
        text.to_number(F.col("daily_growth")).alias("daily_growth"),
        *lines,
    ).dropna(subset=["nav_date", "unit_nav"])


def _dated(raw: DataFrame, columns: Sequence[str], dates: Sequence[str]) -> DataFrame:
    table = _with_optional(raw, columns)
    return table.select(
        text.fund_code(F.col("fund_code")).alias("fund_code"),
        *[text.to_date(F.col(c)).alias(c) if c in dates else F.col(c) for c in columns],
    )


def bonus(raw: DataFrame) -> DataFrame:
    return _dated(
        raw,
        ["year", "record_date", "ex_date", "per_share_text", "pay_date"],
        dates=["record_date", "ex_date", "pay_date"],
    )


def split(raw: DataFrame) -> DataFrame:
    return _dated(raw, ["year", "split_date", "split_type", "ratio_text"], dates=["split_date"])


def personnel(raw: DataFrame) -> DataFrame:
    """Personnel notices; a fund without any is simply absent."""
    return _dated(raw, ["title", "fund_name", "notice_date", "report_id"], dates=["notice_date"])


def cum_return(raw: DataFrame) -> DataFrame:
    table = _with_optional(raw, ["date", "cum_return_pct"])
    lines = [LINE_ORDER] if LINE_ORDER in raw.columns else []
    return table.select(
        text.fund_code(F.col("fund_code")).alias("fund_code"),
        text.to_date(F.col("date")).alias("date"),
        text.to_number(F.col("cum_return_pct")).alias("cum_return_pct"),
        *lines,
    ).dropna(subset=["date", "cum_return_pct"])


def adjusted_nav(raw: DataFrame) -> DataFrame:
    """Stored adjusted NAV read back; rows without date or adjusted value are dropped."""
    return raw.select(
        text.fund_code(F.col("fund_code")).alias("fund_code"),
        text.to_date(F.col("nav_date")).alias("nav_date"),
        *[text.to_number(F.col(c)).alias(c) for c in ("unit_nav", "adjusted_nav", "cumulative_factor")],
    ).dropna(subset=["nav_date", "adjusted_nav"])


def tagged(table: DataFrame, data_version: str, as_of: str) -> DataFrame:
    """Version columns in front."""
    return table.select(
        F.lit(data_version).alias("data_version"), F.lit(as_of).cast("date").alias("as_of_date"), "*"
    )


def latest_personnel_date(notices: DataFrame, latest: str | None = None) -> DataFrame:
    """Last notice date per fund, optionally only up to a date."""
    if latest is not None:
        notices = notices.where(F.col("notice_date") <= F.lit(latest).cast("date"))
    return (
        notices.where(F.col("notice_date").isNotNull())
        .groupBy("fund_code")
        .agg(F.max("notice_date").alias("last_personnel_change_date"))
    )


# Where the two fee columns of the dimension come from.
FEE_SOURCE_MAX_SUBSCRIBE = "fund_overview.最高认购费率"
FEE_SOURCE_PURCHASE = "fund_purchase.手续费"


def listed_with_overview(
    purchases: DataFrame, overviews: DataFrame, order: Sequence[Column] = ()
) -> DataFrame:
    """Purchase and overview rows of one fund side by side (inner, first row per code each)."""
    left = keep_first(
        purchases.withColumn("fund_code", text.fund_code(F.col("fund_code")))
        .withColumnRenamed("short_name", "purchase_name"),
        ["fund_code"],
        order,
    )
    right = keep_first(
        overviews.withColumn("fund_code", text.fund_code(F.col("fund_code")))
        .withColumnRenamed("short_name", "overview_name"),
        ["fund_code"],
        order,
    )
    joined = left.join(right, "fund_code", "inner")
    return joined.withColumn("fund_name", F.coalesce("overview_name", "purchase_name")).drop(
        "overview_name", "purchase_name"
    )


def dim_base(
    purchases: DataFrame,
    overviews: DataFrame,
    personnel_latest: DataFrame,
    data_version: str,
    as_of: str,
    order: Sequence[Column] = (),
) -> DataFrame:
    """The 23-column fund dimension of one version."""
    col = F.col
    day = F.lit(as_of).cast("date")
    funds = listed_with_overview(purchases, overviews, order).withColumn(
        "inception_date", text.general_date(col("inception_text"))
    )
    joined = funds.join(personnel_latest, "fund_code", "left")
    return joined.select(
        F.lit(data_version).alias("data_version"),
        day.alias("as_of_date"),
        "fund_code",
        "fund_name",
        col("full_name").alias("fund_full_name"),
        "fund_type",
        "inception_date",
        (F.datediff(day, "inception_date") / F.lit(365.25)).alias("inception_years"),
        text.clamp_money(text.number_or_blank(col("asset_scale"))).alias("scale_billion"),
        "subscribe_status",
        "redeem_status",
        text.general_date(col("next_open_day")).alias("next_open_day"),
        text.clamp_money(text.number_or_blank(col("purchase_min_amount"))).alias("purchase_min_amount"),
        text.clamp_money(text.number_or_blank(col("daily_limit_amount"))).alias("daily_limit_amount"),
        text.rate_to_ratio(col("mgmt_fee")).alias("management_fee_rate"),
        text.rate_to_ratio(col("custody_fee")).alias("custodian_fee_rate"),
        text.rate_to_ratio(col("sales_fee")).alias("sales_service_fee_rate"),
        text.rate_to_ratio(col("max_subscribe_fee")).alias("max_subscribe_fee_rate"),
        text.rate_to_ratio(col("purchase_fee")).alias("purchase_fee_rate"),
        F.lit(FEE_SOURCE_MAX_SUBSCRIBE).alias("fee_source_max_subscribe"),
        F.lit(FEE_SOURCE_PURCHASE).alias("fee_source_purchase"),
        day.alias("last_updated_date"),
        "last_personnel_change_date",
    )
