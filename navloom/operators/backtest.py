"""Backtest of rule-selected portfolios over rolling windows.

Calendar lookups are equi-joins on a day table (every calendar day mapped to its
next trade day), so no range join and no driver loop is needed. Whether a fund has a NAV
on every trade day of a window is a comparison of two numbers, one at each end (see
`stretches`); days of a path are an equi-join of (fund, day) pairs with the NAV table,
for funds that passed only.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from navloom.functions import text
from navloom.session import written

# Skip reasons.
NO_VERSIONS = "no_scoreboard_data_version"
NO_VERSION_YET = "no_data_version_before_d2"
NOTHING_SELECTED = "empty_selection"
NO_USABLE_FUND = "no_fund_with_valid_nav_on_d3_d4"
# How every run treats fees and windows that overlap.
FEE_MODE = "ignore_subscribe_redeem_conversion_fee"
OVERLAP_MODE = "independent_windows"


@dataclass(frozen=True)
class Rules:
    start: str
    end: str
    rebalance_days: int
    holding_days: int
    limit: int = 20
    where: str = "1"
    order_by: str | Sequence[str] = ("annual_return DESC", "fund_code ASC")
    exclude_subscribe: Sequence[str] = ()
    exclude_redeem: Sequence[str] = ()
    scoreboard_version: str | None = None
    nav_version: str | None = None
    rule_id: str = "custom"
    trade_calendar: str = ""  # where the calendar comes from, for the run's record


class Backtest(NamedTuple):
    run: DataFrame
    windows: DataFrame
    positions: DataFrame
    aggregate: DataFrame


def next_trade_days(calendar: DataFrame) -> DataFrame:
    """Every calendar day -> first trade day on or after it, the one after, and its number.

    One row per day of the calendar's span, so the single window over the calendar is
    small whatever the NAV volume: distinct days are all it ever sees.
    """
    in_order = W.orderBy("trade_date")
    numbered = calendar.distinct().select(
        "trade_date",
        F.lag("trade_date").over(in_order).alias("previous"),
        F.lead("trade_date").over(in_order).alias("next_trade_date"),
        F.row_number().over(in_order).alias("trade_number"),
    )
    first = F.coalesce(F.date_add("previous", 1), F.col("trade_date"))
    return numbered.select(
        F.explode(F.sequence(first, F.col("trade_date"))).alias("day"),
        "trade_date",
        "next_trade_date",
        "trade_number",
    )


def windows(spark: SparkSession, calendar: DataFrame, rules: Rules) -> DataFrame:
    """Anchors every N days; d2 first trade day on or after, d3 the next one, d4 after holding.

    All dates grow with the anchor, so the windows past the calendar's end are exactly
    the last ones and dropping them ends the sequence. A start before the calendar's
    first day maps to that first day.
    """
    if rules.start > rules.end:
        raise ValueError("start must not be after end")
    anchors = spark.range(1).select(
        F.posexplode(
            F.sequence(
                F.lit(rules.start).cast("date"),
                F.lit(rules.end).cast("date"),
                F.make_interval(days=F.lit(rules.rebalance_days)),
            )
        ).alias("position", "d1")
    )
    days = next_trade_days(calendar)
    first_day = calendar.agg(F.min("trade_date").alias("first")).scalar()
    from_start = F.greatest("d1", first_day)
    bought = anchors.withColumn("day", from_start).join(days, "day").select(
        (F.col("position") + 1).cast("int").alias("window_id"),
        "d1",
        F.col("trade_date").alias("d2"),
        F.col("next_trade_date").alias("d3"),
        (F.col("trade_number") + 1).alias("buy_number"),
    ).where(F.col("d3").isNotNull())
    sold = days.select("day", F.col("trade_date").alias("d4"), F.col("trade_number").alias("sell_number"))
    return bought.withColumn("day", F.date_add("d3", rules.holding_days)).join(sold, "day").select(
        "window_id",
        "d1",
        "d2",
        "d3",
        "d4",
        F.datediff("d4", "d3").alias("calendar_holding_days"),
        (F.col("sell_number") - F.col("buy_number") + 1).alias("trading_holding_days"),
    )


def version_dates(snapshot: DataFrame) -> DataFrame:
    """As-of date of each stored version (its largest)."""
    return snapshot.groupBy("data_version").agg(F.max("as_of_date").alias("as_of_date"))


def latest_version(snapshot: DataFrame) -> DataFrame:
    """The version with the largest as-of date; of equal ones the last by name."""
    return version_dates(snapshot).agg(
        F.max_by("data_version", F.struct("as_of_date", "data_version")).alias("data_version")
    )


def versions_by_day(versions: DataFrame, last_day: Column) -> DataFrame:
    """Day -> version in force: the newest with an as-of date on or before the day.

    Versions collapse to one per as-of day first, so the window sees at most one row
    per calendar day.
    """
    per_day = (
        versions.where(F.col("as_of_date").isNotNull())
        .groupBy("as_of_date")
        .agg(F.max("data_version").alias("data_version"))
    )
    following = F.lead("as_of_date").over(W.orderBy("as_of_date"))
    until = F.greatest(F.coalesce(F.date_sub(following, 1), last_day), F.col("as_of_date"))
    return per_day.withColumn("until", until).select(
        F.explode(F.sequence("as_of_date", "until")).alias("day"), "data_version"
    )


def with_versions(window_rows: DataFrame, versions: DataFrame, fixed: str | None = None) -> DataFrame:
    """Add the selection version of each window and, where there is none, the skip reason."""
    if fixed:
        return window_rows.withColumns(
            {"data_version": F.lit(fixed), "skip_reason": F.lit(None).cast("string")}
        )
    last_day = window_rows.agg(F.max("d2").alias("last")).scalar()
    lookup = versions_by_day(versions, last_day).withColumnRenamed("day", "d2")
    any_version = versions.where(F.col("as_of_date").isNotNull()).agg(F.count("*").alias("n")).scalar()
    reason = F.when(
        F.col("data_version").isNull(),
        F.when(any_version == 0, F.lit(NO_VERSIONS)).otherwise(F.lit(NO_VERSION_YET)),
    )
    return window_rows.join(lookup, "d2", "left").withColumn("skip_reason", reason)


def status_filter(table: DataFrame, column: str, excluded: Sequence[str]) -> DataFrame:
    """Rows whose status is not excluded; an unknown status stays."""
    if not excluded:
        return table
    return table.where(~F.col(column).isin(*excluded) | F.col(column).isNull())


def user_condition(condition: str) -> Column:
    """The user's SQL text; the customary "1" means everything."""
    return F.lit(True) if condition.strip() == "1" else F.expr(condition)


def order_terms(order_by: str | Sequence[str]) -> str:
    """ORDER BY text with nulls last in either direction unless the user says otherwise."""
    terms = re.split(r",(?![^()]*\))", order_by) if isinstance(order_by, str) else list(order_by)
    terms = [term.strip() for term in terms]
    return ", ".join(t if re.search(r"\bnulls\s+(first|last)\b", t, re.IGNORECASE) else f"{t} NULLS LAST" for t in terms)


def selection(scoreboard: DataFrame, rules: Rules, salts: int = 64) -> DataFrame:
    """Top funds of each version by the user's rules, with equal weights.

    A version can hold most of the rows, so each is first cut to its top k within
    `salts` slices, and only those candidates are ranked together; the result is the
    same top k. Repeated codes are removed after the cut.
    """
    order = order_terms(rules.order_by)
    chosen = scoreboard.where(user_condition(rules.where))
    chosen = status_filter(chosen, "subscribe_status", rules.exclude_subscribe)
    chosen = status_filter(chosen, "redeem_status", rules.exclude_redeem)
    chosen = chosen.withColumn("slice", F.pmod(F.xxhash64("fund_code"), F.lit(salts)))
    sliced = chosen.withColumn(
        "place", F.expr(f"row_number() over (partition by data_version, slice order by {order})")
    ).where(F.col("place") <= rules.limit)
    top = sliced.withColumn(
        "place", F.expr(f"row_number() over (partition by data_version order by {order})")
    ).where(F.col("place") <= rules.limit)
    codes = top.select("data_version", text.fund_code(F.col("fund_code")).alias("fund_code")).distinct()
    # At most `limit` rows per version meet in this window.
    size = F.count("*").over(W.partitionBy("data_version"))
    return codes.withColumn("weight", F.lit(1.0) / size)


def _between_windows(nav: DataFrame, selected_windows: DataFrame, selections: DataFrame) -> DataFrame:
    """NAV of the selected funds from the first buy to the last sale.

    Both days are read as one row of the (small) window table, so that they reach the scan as literals.
    """
    span = selected_windows.agg(F.min("d3").alias("first"), F.max("d4").alias("last")).first()
    days = nav.where(F.col("nav_date").between(F.lit(span["first"]), F.lit(span["last"])))
    return days.join(selections.select("fund_code").distinct(), "fund_code", "left_semi")


def position_paths(
    selected_windows: DataFrame, selections: DataFrame, calendar: DataFrame, nav: DataFrame
) -> DataFrame:
    """Selected funds with their NAV on every trade day of their window (null where missing).

    Of the NAV history only the selected funds between the first buy and the last sale are read on.
    Pass stored windows and selections: both are read several times.
    """
    nav = _between_windows(nav, selected_windows, selections)
    days = calendar.distinct().withColumnRenamed("trade_date", "nav_date")
    grid = (
        selected_windows.select(
            "window_id", "data_version", "d3", "d4", F.explode(F.sequence("d3", "d4")).alias("nav_date")
        )
        .join(days, "nav_date")
        .join(selections, "data_version")
    )
    return grid.join(nav.select("fund_code", "nav_date", "adjusted_nav"), ["fund_code", "nav_date"], "left")


def stretches(nav: DataFrame, calendar: DataFrame) -> DataFrame:
    """NAV on trade days with the number of the gapless stretch each belongs to, per fund.

    The number is the trade day's place in the calendar less its place among the fund's own days: it
    grows by one with every day the fund has no NAV on, so it is equal at two days exactly if none is
    missing between them. One window over NAV; a null NAV is a missing one.
    """
    numbered = next_trade_days(calendar).where("day = trade_date").select(F.col("day").alias("nav_date"), "trade_number")
    own = W.partitionBy("fund_code").orderBy("nav_date")
    days = nav.where("adjusted_nav is not null").select("fund_code", "nav_date", "adjusted_nav").join(numbered, "nav_date")
    return days.select("fund_code", "nav_date", "adjusted_nav", (F.col("trade_number") - F.dense_rank().over(own)).alias("stretch"))


def usable_funds(selected_windows: DataFrame, selections: DataFrame, days: DataFrame) -> DataFrame:
    """Selected funds per window with a NAV on every trade day of it and a positive buy NAV.

    `days` are the `stretches` of the funds; a window looks at two of them, however long it is.
    """
    wanted = selected_windows.select("window_id", "data_version", "d3", "d4").join(selections, "data_version")

    def at(end: str, value: str, stretch: str) -> DataFrame:
        return days.select("fund_code", F.col("nav_date").alias(end), F.col("adjusted_nav").alias(value), F.col("stretch").alias(stretch))

    both = wanted.join(at("d3", "buy_nav", "buy_stretch"), ["fund_code", "d3"]).join(
        at("d4", "sell_nav", "sell_stretch"), ["fund_code", "d4"]
    )
    return both.where("buy_stretch = sell_stretch and buy_nav > 0").select(
        "window_id", "fund_code", "weight", "d3", "d4", "buy_nav", "sell_nav"
    )


def usable_paths(usable: DataFrame, days: DataFrame) -> DataFrame:
    """NAV of usable funds on the trade days of their windows."""
    grid = usable.withColumn("nav_date", F.explode(F.sequence("d3", "d4")))
    return grid.join(days.select("fund_code", "nav_date", "adjusted_nav"), ["fund_code", "nav_date"])


def portfolio_path(paths: DataFrame) -> DataFrame:
    """Value of each window's portfolio per day, one at the buy date.

    Weights are renormalised over the usable funds by the quotient of two sums.
    """
    relative = F.col("adjusted_nav") / F.col("buy_nav")
    return paths.groupBy("window_id", "nav_date").agg(
        (F.sum(F.col("weight") * relative) / F.sum("weight")).alias("value")
    )


def window_results(path: DataFrame) -> DataFrame:
    """Return, volatility and drawdown per window from its daily path (bounded by its days)."""
    in_order = W.partitionBy("window_id").orderBy("nav_date")
    so_far = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    stepped = path.select(
        "window_id",
        "nav_date",
        "value",
        (F.col("value") / F.lag("value").over(in_order) - F.lit(1.0)).alias("step"),
        F.max("value").over(so_far).alias("peak"),
    )
    return stepped.groupBy("window_id").agg(
        F.min_by("value", "nav_date").alias("portfolio_nav_start"),
        F.max_by("value", "nav_date").alias("portfolio_nav_end"),
        F.max(F.lit(1.0) - F.col("value") / F.col("peak")).alias("max_drawdown_in_window"),
        F.when(F.count("step") > 1, F.stddev_samp("step")).otherwise(F.lit(0.0)).alias("volatility_in_window"),
    )


def positions(usable: DataFrame) -> DataFrame:
    """Bought funds per window with renormalised weight, return and contribution."""
    # At most `limit` funds per window meet here.
    total = F.sum("weight").over(W.partitionBy("window_id"))
    weight = F.col("weight") / total
    gain = F.col("sell_nav") / F.col("buy_nav") - F.lit(1.0)
    return usable.select(
        "window_id",
        "fund_code",
        weight.alias("weight"),
        F.col("buy_nav").alias("buy_nav_at_d3"),
        F.col("sell_nav").alias("sell_nav_at_d4"),
        gain.alias("fund_return"),
        (weight * gain).alias("contribution"),
    )


def aggregate(window_detail: DataFrame) -> DataFrame:
    """Counts, win rate and distribution of the valid windows' returns, in one row."""
    ok = F.col("status") == "ok"
    value = F.when(ok, F.col("portfolio_return"))
    valid = F.count(value)
    tails = {"p10_return": 0.1, "p50_return": 0.5, "p90_return": 0.9}
    return window_detail.agg(
        F.count("*").alias("total_windows"),
        valid.alias("valid_windows"),
        F.count_if(~ok).alias("skipped_windows"),
        F.coalesce(F.avg((value > 0).cast("double")), F.lit(0.0)).alias("win_rate"),
        F.avg(value).alias("mean_return"),
        F.median(value).alias("median_return"),
        F.when(valid == 1, F.lit(0.0)).otherwise(F.stddev_samp(value)).alias("std_return"),
        *[F.percentile(value, share).alias(name) for name, share in tails.items()],
        F.max(value).alias("best_window_return"),
        F.min(value).alias("worst_window_return"),
    )


def top_windows(window_detail: DataFrame, count: int = 3) -> DataFrame:
    """The best valid windows by return."""
    best = window_detail.where("status = 'ok'").orderBy(F.desc("portfolio_return"), "window_id").limit(count)
    return best.select("window_id", "d3", "d4", "portfolio_return")


def run_backtest(
    spark: SparkSession, calendar: DataFrame, scoreboard: DataFrame, nav_daily: DataFrame, rules: Rules
) -> Backtest:
    """Windows, selections and portfolios of one rule set.

    `scoreboard` and `nav_daily` are the stored snapshots of all versions. Calendar, windows with their
    versions, selections, the selected funds' days and the usable funds are computed here, each once,
    and stored in the shared folder; the frames returned read those tables.
    """
    calendar = written(calendar.select("trade_date").distinct(), "calendar")
    versions = written(version_dates(scoreboard), "versions")
    versioned = written(with_versions(windows(spark, calendar, rules), versions, rules.scoreboard_version), "windows")
    if versioned.isEmpty():
        raise ValueError("the calendar holds no backtest window")
    nav_version = rules.nav_version or latest_version(nav_daily).first().data_version
    if nav_version is None:
        raise ValueError("no NAV version is stored")
    open_windows = versioned.where("skip_reason is null")
    in_use = open_windows.select("data_version").distinct()
    selections = written(selection(scoreboard.join(in_use, "data_version", "left_semi"), rules), "selections")
    nav = _between_windows(nav_daily.where(F.col("data_version") == nav_version), open_windows, selections)
    days = written(stretches(nav, calendar), "selected-days")
    usable = written(usable_funds(open_windows, selections, days), "usable")
    bought = positions(usable)
    results = window_results(portfolio_path(usable_paths(usable, days)))
    held = bought.groupBy("window_id").agg(
        F.count("*").alias("funds"), F.sum("weight").alias("weights")
    )
    selected_versions = selections.select("data_version").distinct().withColumn("selected", F.lit(True))
    joined = (
        versioned.join(selected_versions, "data_version", "left")
        .join(results, "window_id", "left")
        .join(held, "window_id", "left")
    )
    reason = F.coalesce(
        F.col("skip_reason"),
        F.when(F.col("selected").isNull(), F.lit(NOTHING_SELECTED)),
        F.when(F.col("funds").isNull(), F.lit(NO_USABLE_FUND)),
    )
    detail = joined.withColumn("skip_reason", F.coalesce(reason, F.lit(""))).select(
        "window_id",
        "d1",
        "d2",
        "d3",
        "d4",
        "calendar_holding_days",
        "trading_holding_days",
        F.col("data_version").alias("selection_data_version"),
        F.coalesce("funds", F.lit(0)).alias("selected_fund_count"),
        F.coalesce("weights", F.lit(0.0)).alias("weight_sum"),
        (F.col("portfolio_nav_end") - F.lit(1.0)).alias("portfolio_return"),
        "portfolio_nav_start",
        "portfolio_nav_end",
        "max_drawdown_in_window",
        "volatility_in_window",
        F.when(F.col("skip_reason") == "", F.lit("ok")).otherwise(F.lit("skipped")).alias("status"),
        "skip_reason",
    )
    run = spark.range(1).select(
        F.date_format(F.current_timestamp(), "yyyyMMddHHmmss").alias("run_id"),
        F.current_timestamp().alias("run_time"),
        F.lit(rules.start).alias("start_date"),
        F.lit(rules.end).alias("end_date"),
        F.lit(rules.rebalance_days).alias("rebalance_interval_days"),
        F.lit(rules.holding_days).alias("holding_period_days"),
        F.lit(rules.trade_calendar).alias("trade_calendar"),
        F.lit(FEE_MODE).alias("fee_mode"),
        F.lit(OVERLAP_MODE).alias("overlap_mode"),
        F.lit(rules.rule_id).alias("selection_rule_id"),
        F.lit(rules.scoreboard_version or "auto_by_d2").alias("selection_data_version_mode"),
        F.lit(nav_version).alias("nav_data_version"),
        F.lit(rules.limit).alias("selection_limit"),
        F.lit(rules.where).alias("selection_where"),
        F.lit(order_terms(rules.order_by)).alias("selection_order_by"),
    )
    return Backtest(run, detail, bought, aggregate(detail))
