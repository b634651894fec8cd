"""Completeness of each fund's NAV days against the trade calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.functions import display, text
from navloom.sources.files import trade_days_between


def eligible_funds(overview: DataFrame, start: str) -> DataFrame:
    """Funds not founded after the start; an unreadable founding date keeps the fund."""
    founded = text.inception_date(F.col("inception_text"))
    return (
        overview.where(founded.isNull() | (founded <= F.lit(start).cast("date")))
        .select(text.fund_code(F.col("fund_code")).alias("fund_code"))
        .distinct()
    )


def checked_funds(adjusted: DataFrame, overview: DataFrame, start: str) -> DataFrame:
    """Eligible funds that have an adjusted series."""
    series = adjusted.select("fund_code").distinct()
    return series.join(eligible_funds(overview, start), "fund_code", "left_semi")


def detail(
    adjusted: DataFrame, overview: DataFrame, calendar: DataFrame, start: str, end: str
) -> DataFrame:
    """One row per checked fund and trade day in [start, end]: does the fund have a NAV?

    Each fund's days come from a date sequence that is joined to the calendar by day,
    so no fund-by-calendar product is built and both joins hash on their keys.
    """
    days = trade_days_between(calendar, start, end)
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    grid = checked_funds(adjusted, overview, start).select(
        "fund_code", F.explode(span).alias("trade_date")
    ).join(days, "trade_date")
    have = adjusted.select("fund_code", F.col("nav_date").alias("trade_date"), F.lit(True).alias("has"))
    return grid.join(have.distinct(), ["fund_code", "trade_date"], "left").select(
        "fund_code", "trade_date", F.coalesce("has", F.lit(False)).alias("exists")
    )


def summary(
    adjusted: DataFrame, overview: DataFrame, calendar: DataFrame, start: str, end: str
) -> DataFrame:
    """Existing share of the trade days per checked fund (0 when there are no trade days).

    Counts matching NAV days per fund; the fund-by-day grid of `detail` is not needed.
    """
    days = trade_days_between(calendar, start, end)
    in_range = adjusted.where(
        F.col("nav_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    hits = (
        in_range.select("fund_code", F.col("nav_date").alias("trade_date"))
        .distinct()
        .join(days, "trade_date")
        .groupBy("fund_code")
        .agg(F.count("*").alias("hits"))
    )
    total = days.agg(F.count("*").alias("n")).scalar()
    share = F.when(total > 0, F.coalesce("hits", F.lit(0)) / total).otherwise(F.lit(0.0))
    return (
        checked_funds(adjusted, overview, start)
        .join(hits, "fund_code", "left")
        .select("fund_code", share.alias("ratio"))
    )


# Exported headers.
SUMMARY_HEADERS = {"fund_code": "基金编码", "ratio": "数据完整比例"}
DETAIL_HEADERS = {"trade_date": "交易日日期", "exists": "该日期数据是否存在"}


def summary_text(summaries: DataFrame) -> DataFrame:
    return summaries.select(
        F.col("fund_code").alias(SUMMARY_HEADERS["fund_code"]),
        display.fixed_text(F.col("ratio"), 6).alias(SUMMARY_HEADERS["ratio"]),
    )


def detail_text(details: DataFrame) -> DataFrame:
    return details.select(
        "fund_code",
        F.date_format("trade_date", "yyyy-MM-dd").alias(DETAIL_HEADERS["trade_date"]),
        display.yes_no(F.col("exists")).alias(DETAIL_HEADERS["exists"]),
    )
