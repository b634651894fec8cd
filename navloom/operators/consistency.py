"""Local adjusted NAV against remote cumulative returns."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from navloom.functions import display
from navloom.functions.returns import finite_or_null
from navloom.sources.files import LINE_ORDER

STAGE = "compare_adjusted_nav_cum_return"
# Short names of the deviation buckets, in display order.
BUCKET_NAMES = ("lt1", "from1_to2", "from2_to5", "from5_to10", "ge10")


class Comparison(NamedTuple):
    detail: DataFrame
    summary: DataFrame
    errors: DataFrame


def both_sides(adjusted: DataFrame, cum_return: DataFrame) -> DataFrame:
    """One row per fund and day with the value of either side (null: that side lacks the day).

    A union that is grouped, not a join: repeated days collapse before the shuffle. Of a
    repeated day the last line stays where the tables have line_order, else the larger value.
    """
    def side(table: DataFrame, day: str, local: Column, remote: Column) -> DataFrame:
        at = F.col(LINE_ORDER)
        known = LINE_ORDER in table.columns
        line = F.struct(at["file"].alias("file"), at["row"].alias("row")) if known else F.lit(None)
        return table.select(
            "fund_code", F.col(day).alias("date"), local.alias("local"), remote.alias("remote"),
            line.cast("struct<file:string,row:bigint>").alias("line"),
        )

    def last(value: str) -> Column:
        """The value of the last line, of equal lines (or without lines) the largest."""
        there = F.col(value).isNotNull()
        return F.max(F.when(there, F.struct("line", F.col(value).alias("value"))))["value"].alias(value)

    none = F.lit(None).cast("double")
    rows = side(
        adjusted, "nav_date", finite_or_null(F.col("adjusted_nav").cast("double")), none
    ).unionByName(side(cum_return, "date", none, finite_or_null(F.col("cum_return_pct").cast("double"))))
    return (
        rows.where("date is not null and (local is not null or remote is not null)")
        .groupBy("fund_code", "date")
        .agg(last("local"), last("remote"))
    )


def with_last_common(days: DataFrame) -> DataFrame:
    """Add the fund's last common day and both values on it to every row."""
    fund = W.partitionBy("fund_code")
    common = F.col("local").isNotNull() & F.col("remote").isNotNull()
    last = F.max(F.when(common, F.struct("date", "local", "remote"))).over(fund)
    return (
        days.withColumn("last", last)
        .withColumn("common", common)
        .select(
            "fund_code",
            "date",
            "local",
            "remote",
            "common",
            F.col("last.date").alias("end_date"),
            F.col("last.local").alias("local_end"),
            F.col("last.remote").alias("remote_end"),
        )
    )


def local_return(start: Column, end: Column) -> Column:
    return F.when(start != 0, (end - start) / start)


def remote_return(start: Column, end: Column) -> Column:
    """Return between two cumulative percentages (100 is the value at inception)."""
    base = start + F.lit(100.0)
    return F.when(base != 0, (end - start) / base)


def with_deviation(days: DataFrame) -> DataFrame:
    local = local_return(F.col("local"), F.col("local_end"))
    remote = remote_return(F.col("remote"), F.col("remote_end"))
    deviation = F.when(
        (F.col("local_return") != 0) & F.col("remote_return").isNotNull(),
        (F.col("local_return") - F.col("remote_return")) / F.col("local_return"),
    )
    return (
        days.withColumns({"local_return": local, "remote_return": remote})
        .withColumn("deviation", deviation)
        .withColumn("bucket", display.deviation_bucket(F.col("deviation")))
    )


def _compared() -> Column:
    return F.col("common") & (F.col("date") < F.col("end_date"))


def _details(days: DataFrame) -> DataFrame:
    return with_deviation(days.where(_compared())).select(
        "fund_code",
        F.col("date").alias("start_date"),
        "end_date",
        F.col("local").alias("local_start"),
        "local_end",
        F.col("remote").alias("remote_start"),
        "remote_end",
        "local_return",
        "remote_return",
        "deviation",
        "bucket",
    )


def detail(adjusted: DataFrame, cum_return: DataFrame) -> DataFrame:
    """Every common day before the last one, compared with the last common day."""
    return _details(with_last_common(both_sides(adjusted, cum_return)))


def _summaries(days: DataFrame) -> DataFrame:
    judged = with_deviation(days)
    compared = F.count_if(_compared())
    counts = [
        F.count_if(_compared() & (F.col("bucket") == label)).alias(name)
        for name, (label, _) in zip(BUCKET_NAMES, display.DEVIATION_BUCKETS, strict=True)
    ]
    skipped = F.count_if(~F.col("common") & (F.col("date") <= F.col("end_date")))
    per_fund = judged.groupBy("fund_code").agg(
        F.max("end_date").isNull().alias("missing"),
        compared.alias("compared_days"),
        skipped.alias("skipped_days"),
        *counts,
        (F.count("local") > 0).alias("has_local"),
        (F.count("remote") > 0).alias("has_remote"),
    )
    shares = [
        F.when(F.col("compared_days") > 0, F.col(name) / F.col("compared_days"))
        .otherwise(F.lit(0.0))
        .alias(f"{name}_share")
        for name in BUCKET_NAMES
    ]
    return per_fund.select("*", *shares)


def summary(adjusted: DataFrame, cum_return: DataFrame) -> DataFrame:
    """Compared and skipped days and the bucket shares (of all compared days) per fund."""
    return _public(_summaries(with_last_common(both_sides(adjusted, cum_return))))


def _public(summaries: DataFrame) -> DataFrame:
    return summaries.drop("has_local", "has_remote")


def _errors(summaries: DataFrame) -> DataFrame:
    error = (
        F.when(~F.col("has_local"), F.lit("fund file missing: adjusted_nav_missing"))
        .when(~F.col("has_remote"), F.lit("fund file missing: cum_return_missing"))
        .otherwise(F.lit("no common date found"))
    )
    return summaries.where("missing").select("fund_code", F.lit(STAGE).alias("stage"), error.alias("error"))


def compare(adjusted: DataFrame, cum_return: DataFrame) -> Comparison:
    days = with_last_common(both_sides(adjusted, cum_return))
    summaries = _summaries(days)
    return Comparison(_details(days), _public(summaries), _errors(summaries))


# Exported headers.
DETAIL_HEADERS = {
    "start_date": "期初日期",
    "end_date": "期末日期",
    "local_start": "本地期初值",
    "local_end": "本地期末值",
    "remote_start": "远程期初值",
    "remote_end": "远程期末值",
    "local_return": "该时段本地计算的收益率",
    "remote_return": "该时段远程收益率",
    "deviation": "本地远程收益率偏差",
    "bucket": "偏差类型",
}
SUMMARY_HEADERS = {
    "fund_code": "基金代码",
    "missing": "数据是否缺失",
    "compared_days": "参与比对收益率的天数",
    "skipped_days": "因日期数据缺失跳过的天数",
    "lt1_share": "<1%偏差占比",
    "from1_to2_share": "1%～2%偏差占比",
    "from2_to5_share": "2%～5%偏差占比",
    "from5_to10_share": "5%～10%偏差占比",
    "ge10_share": "10%以上偏差占比",
}


def detail_text(details: DataFrame) -> DataFrame:
    """Details with numbers as ten-decimal text and "-" for null, under our names."""
    numbers = [n for n in DETAIL_HEADERS if n not in ("start_date", "end_date", "bucket")]
    return details.select(
        "fund_code",
        *[
            display.fixed_text(F.col(n), 10, missing="-").alias(n) if n in numbers else F.col(n)
            for n in DETAIL_HEADERS
        ],
    )


def summary_text(summaries: DataFrame) -> DataFrame:
    """The exported summary: yes/no flag and percentages with two decimals."""
    def shown(name: str) -> Column:
        if name == "missing":
            return display.yes_no(F.col(name))
        return display.percent_text(F.col(name)) if name.endswith("_share") else F.col(name)

    return summaries.select(*[shown(n).alias(header) for n, header in SUMMARY_HEADERS.items()])
