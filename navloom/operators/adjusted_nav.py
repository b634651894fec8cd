"""Dividend- and split-adjusted NAV, with rejected funds.

One pass over long tables: NAV days and event days meet in one full outer join on
(fund, day), and everything per fund then runs on one shuffle by fund. A fund's
rows there are bounded by calendar days, whatever share of the raw rows it holds.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from navloom.functions import text
from navloom.sources.files import LINE_ORDER

DIVIDEND, SPLIT = "dividend", "split"
MISSING_FLAGS = ("no_nav_dividend", "no_nav_split")


class AdjustedNav(NamedTuple):
    adjusted: DataFrame  # fund_code, nav_date, unit_nav, adjusted_nav, cumulative_factor
    rejects: DataFrame  # fund_code, stage, error
    summary: DataFrame  # fund_code, rows, start_date, end_date


def one_row_per_day(nav: DataFrame) -> DataFrame:
    """One NAV per fund and day; of a repeated day the last line where there is a line_order, else the highest value.

    The maximum of a struct is aggregated over sorted rows, which spill and which a join by fund and day
    takes as they lie; a hash table of all days would be held twice in one task.
    """
    value = F.max_by("unit_nav", LINE_ORDER) if LINE_ORDER in nav.columns else F.max(F.struct("unit_nav"))["unit_nav"]
    return nav.groupBy("fund_code", "nav_date").agg(value.alias("unit_nav"))


def repeated_days(table: DataFrame, day: str = "nav_date") -> DataFrame:
    """Per fund with repeated days: how many days repeat, and the rows that one row per day leaves out."""
    per_day = table.groupBy("fund_code", day).agg(F.count("*").alias("rows")).where("rows > 1")
    return per_day.groupBy("fund_code").agg(
        F.count("*").alias("repeated_days"), (F.sum("rows") - F.count("*")).alias("dropped_rows")
    )


def events(bonus: DataFrame, split: DataFrame) -> DataFrame:
    """Parsed events (fund, day, kind, amount, how often), equal ones counted before the shuffle."""
    dividends = bonus.select(
        "fund_code",
        F.col("ex_date").alias("event_date"),
        F.lit(DIVIDEND).alias("kind"),
        text.dividend_amount(F.col("per_share_text")).alias("amount"),
    )
    splits = split.select(
        "fund_code",
        F.col("split_date").alias("event_date"),
        F.lit(SPLIT).alias("kind"),
        text.split_ratio(F.col("ratio_text")).alias("amount"),
    )
    return (
        dividends.unionByName(splits)
        .dropna(subset=["event_date", "amount"])
        .groupBy("fund_code", "event_date", "kind", "amount")
        .agg(F.count("*").alias("times"))
    )


def event_factor(event: Column) -> Column:
    """Factor of one event on its day; a non-positive NAV or ratio leaves the NAV unchanged."""
    nav, amount = F.col("unit_nav"), event["amount"]
    single = (
        F.when((event["kind"] == DIVIDEND) & (nav > 0), (nav + amount) / nav)
        .when((event["kind"] == SPLIT) & (amount > 0), amount)
        .otherwise(F.lit(1.0))
    )
    return F.pow(single, event["times"].cast("double"))


def days_with_events(nav: DataFrame, bonus: DataFrame, split: DataFrame) -> DataFrame:
    """One row per fund and day: unit NAV (null: event without NAV), day factor, missing kinds.

    The few events of a day come together before the join, so each day is met once and the many NAV days
    are not grouped again behind it.
    """
    per_day = (
        events(bonus, split)
        .groupBy("fund_code", F.col("event_date").alias("nav_date"))
        .agg(F.sort_array(F.collect_list(F.struct("kind", "amount", "times"))).alias("events"))
    )
    # Sort-merge hint: both sides grow with the data.
    joined = nav.withColumn("has_nav", F.lit(True)).hint("merge").join(per_day, ["fund_code", "nav_date"], "full_outer")

    def without_nav(kind: str) -> Column:
        return F.coalesce(F.col("has_nav").isNull() & F.exists("events", lambda e: e["kind"] == kind), F.lit(False))

    factor = F.aggregate("events", F.lit(1.0), lambda product, e: product * event_factor(e))
    return joined.select(
        "fund_code",
        "nav_date",
        "unit_nav",
        "has_nav",
        F.coalesce(factor, F.lit(1.0)).alias("day_factor"),
        without_nav(DIVIDEND).alias("no_nav_dividend"),
        without_nav(SPLIT).alias("no_nav_split"),
    )


def missing_event_days(nav: DataFrame, bonus: DataFrame, split: DataFrame) -> DataFrame:
    """Event days on which the fund has no NAV (fund, day, kind)."""
    days = nav.select("fund_code", F.col("nav_date").alias("event_date")).distinct()
    return (
        events(bonus, split)
        .join(days, ["fund_code", "event_date"], "left_anti")
        .select("fund_code", "event_date", "kind")
        .distinct()
    )


def _accumulated(days: DataFrame) -> DataFrame:
    running = (
        W.partitionBy("fund_code").orderBy("nav_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return days.withColumn("cumulative_factor", F.product("day_factor").over(running))


def _projected(days: DataFrame) -> DataFrame:
    return days.select(
        "fund_code",
        "nav_date",
        "unit_nav",
        (F.col("unit_nav") * F.col("cumulative_factor")).alias("adjusted_nav"),
        "cumulative_factor",
    )


def adjust(nav: DataFrame, bonus: DataFrame, split: DataFrame) -> DataFrame:
    """Adjusted NAV of funds whose events all fall on NAV days (others: see adjust_all)."""
    days = days_with_events(one_row_per_day(nav), bonus, split)
    return _projected(_accumulated(days.where("has_nav")))


def _not_tolerated(last_missing_day: Column, allow_missing_until: str | None) -> Column:
    """Whether a fund fails by its last event day without NAV: all-or-nothing per kind."""
    if allow_missing_until is None:
        return last_missing_day.isNotNull()
    return F.coalesce(last_missing_day > F.lit(allow_missing_until).cast("date"), F.lit(False))


def _of_good_funds(days: DataFrame, allow_missing_until: str | None) -> DataFrame:
    """NAV days of the funds that are not rejected.

    Judged in the window that accumulates the factors anyway: no join back, one sort.
    """
    whole = (
        W.partitionBy("fund_code")
        .orderBy("nav_date")
        .rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    judged = days.withColumns(
        {
            f"{flag}_last": F.max(F.when(F.col(flag), F.col("nav_date"))).over(whole)
            for flag in MISSING_FLAGS
        }
    )
    for flag in MISSING_FLAGS:
        judged = judged.where(~_not_tolerated(F.col(f"{flag}_last"), allow_missing_until))
    return judged.where("has_nav")


def rejection_reasons(days: DataFrame, allow_missing_until: str | None) -> DataFrame:
    """Funds with an event day without NAV that is not tolerated, and the error text.

    Tolerance is all-or-nothing per kind: only if every missing day is on or before
    the cutoff. Dividends are judged first, so they name the error when both fail.
    """
    def verdict(flag: str) -> tuple[Column, Column]:
        day = F.when(F.col(flag), F.col("nav_date"))
        return F.max(day).alias(f"{flag}_last"), F.array_join(
            F.array_sort(F.collect_set(F.date_format(day, "yyyy-MM-dd"))), ","
        ).alias(f"{flag}_days")

    # Events of funds without any NAV in this run do not count.
    per_fund = (
        days.groupBy("fund_code")
        .agg(F.count_if("has_nav").alias("nav_days"), *verdict("no_nav_dividend"), *verdict("no_nav_split"))
        .where("nav_days > 0")
    )

    def failed(flag: str) -> Column:
        return _not_tolerated(F.col(f"{flag}_last"), allow_missing_until)

    def message(kind: str, flag: str) -> Column:
        return F.concat(F.lit(f"missing nav data on {kind} dates: "), F.col(f"{flag}_days"))

    error = F.when(failed("no_nav_dividend"), message("dividend", "no_nav_dividend")).when(
        failed("no_nav_split"), message("split", "no_nav_split")
    )
    return per_fund.select("fund_code", error.alias("error")).where("error is not null")


def tolerated_events(
    nav: DataFrame, bonus: DataFrame, split: DataFrame, allow_missing_until: str | None
) -> DataFrame:
    """Per fund with missing event days: whether all of them are tolerated."""
    days = days_with_events(one_row_per_day(nav), bonus, split)
    rejected = rejection_reasons(days, allow_missing_until).withColumn("rejected", F.lit(True))
    flagged = (
        days.groupBy("fund_code")
        .agg(
            F.count_if("has_nav").alias("nav_days"),
            F.count_if("no_nav_dividend").alias("missing_dividend_days"),
            F.count_if("no_nav_split").alias("missing_split_days"),
        )
        .where("nav_days > 0 and missing_dividend_days + missing_split_days > 0")
    )
    return flagged.join(rejected, "fund_code", "left").select(
        "fund_code",
        "missing_dividend_days",
        "missing_split_days",
        F.col("rejected").isNull().alias("tolerated"),
    )


def adjust_all(
    nav: DataFrame,
    bonus: DataFrame,
    split: DataFrame,
    codes: DataFrame | None = None,
    done: DataFrame | None = None,
    bonus_codes: DataFrame | None = None,
    split_codes: DataFrame | None = None,
    allow_missing_until: str | None = None,
) -> AdjustedNav:
    """Adjusted NAV of every fund, the rejected funds with their error, and a summary.

    `codes` limits the run, `done` lists funds with an existing result (skipped), and
    `bonus_codes`/`split_codes` list funds whose bonus/split data was landed (possibly
    without rows); a fund outside them is rejected. Left out, all count as landed.
    """
    if codes is not None:
        nav = nav.join(codes.select("fund_code").distinct(), "fund_code", "left_semi")
    if done is not None:
        nav = nav.join(done.select("fund_code").distinct(), "fund_code", "left_anti")
    def absent(wanted: DataFrame, present: DataFrame, error: str) -> DataFrame:
        return wanted.join(present, "fund_code", "left_anti").select(
            "fund_code", F.lit(error).alias("error")
        )

    rejected = []
    usable = nav
    wanted = nav.select("fund_code").distinct()
    if codes is not None:
        wanted = codes.select("fund_code").distinct()
        if done is not None:
            wanted = wanted.join(done.select("fund_code").distinct(), "fund_code", "left_anti")
    # Files are missed before rows: a fund without either is rejected for its file.
    for landed, error in ((bonus_codes, "missing bonus files"), (split_codes, "missing split files")):
        if landed is not None:
            landed = landed.select("fund_code").distinct()
            rejected.append(absent(wanted, landed, error))
            wanted = wanted.join(landed, "fund_code", "left_semi")
            usable = usable.join(landed, "fund_code", "left_semi")
    if codes is not None:
        rejected.append(absent(wanted, nav.select("fund_code").distinct(), "empty nav data"))

    days = days_with_events(one_row_per_day(usable), bonus, split)
    event_rejects = rejection_reasons(days, allow_missing_until)
    adjusted = _projected(_accumulated(_of_good_funds(days, allow_missing_until)))
    for part in rejected:
        event_rejects = event_rejects.unionByName(part)
    rejects = event_rejects.select("fund_code", F.lit("adjusted_nav").alias("stage"), "error")
    return AdjustedNav(adjusted, rejects, load_summary(adjusted))


def load_summary(adjusted: DataFrame) -> DataFrame:
    """Row count and first and last day per fund."""
    return adjusted.groupBy("fund_code").agg(
        F.count("*").alias("rows"),
        F.min("nav_date").alias("start_date"),
        F.max("nav_date").alias("end_date"),
    )
