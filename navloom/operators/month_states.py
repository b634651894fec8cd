"""Month summaries of a fund's days, merged in order to the 33 metrics.

A summary holds what a later reader needs of a month: its ends, its highest and lowest value, its
drawdown and worst day, its week ends, and the days that reached every earlier value of the month with
the lowest value before the next such day. Summaries of consecutive stretches merge from left to right
into one small state, so a snapshot reads summaries and the days of at most three months of a fund: the
one the as-of day cuts and the ones in which the trailing spans begin. A new day changes the summary of
its own month alone.

Summaries are made by fund and month, so a fund with a long history is never one task; merging has
one element per month of a fund. Days must be one per fund with positive NAV (adjusted_nav.one_row_per_day).
Results equal metrics.metric_snapshot up to the last bits of sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from navloom.functions.returns import (
    PERIOD_LABELS,
    annualised,
    finite_or_null,
    pct_change,
    ratio,
    week_end,
)
from navloom.operators.metrics import METRICS, RISK_FREE, SPANS, WEEKS_PER_YEAR, calmar, up_to

#: Beyond so many calendar months in which spans begin, days are found by the join alone.
PRUNED_MONTHS = 60

_BUCKET = "struct<label: date, nav: double, base: double, n: bigint, up: bigint, mean: double, m2: double>"
_LOW = "struct<nav: double, day: date>"
_MERGED = (
    "struct<first_day: date, first_nav: double, last_day: date, last_nav: double, drawdown: double, drop: double,"
    f" climb: struct<high: double, low: {_LOW}, recovery: int>, W: {_BUCKET}, M: {_BUCKET}, Q: {_BUCKET}>"
)
_NAMES = {"W": "week", "M": "month", "Q": "quarter"}


def month_of(day: Column | str) -> Column:
    return F.trunc(day, "month")


def month_states(adjusted: DataFrame, *keys: str) -> DataFrame:
    """One row per fund (further keys) and month of its days; one shuffle, by fund and month."""
    by = ["fund_code", *keys, "month"]
    in_order = W.partitionBy(*by).orderBy("nav_date")
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    nav, day = F.col("adjusted_nav"), F.col("nav_date")
    days = adjusted.dropna(subset=["nav_date", "adjusted_nav"]).select(
        "fund_code", *keys, month_of("nav_date").alias("month"), "nav_date", "adjusted_nav"
    )
    days = days.withColumns(
        {
            "peak": F.max(nav).over(before),
            "step": pct_change(nav, F.lag("adjusted_nav").over(in_order)),
            "next_week": F.lead(week_end(day)).over(in_order),
        }
    )
    days = days.withColumn("at_peak", F.col("peak").isNull() | (nav >= F.col("peak")))
    days = days.withColumn("record", F.count_if("at_peak").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    closes_week = F.col("next_week").isNull() | (F.col("next_week") != week_end(day))
    records = days.groupBy(*by, "record").agg(
        F.count("*").alias("days"),
        F.min(F.struct(day.alias("day"), nav.alias("nav"))).alias("first"),
        F.max(F.struct(day.alias("day"), nav.alias("nav"))).alias("last"),
        F.min(F.struct(nav.alias("nav"), day.alias("day"))).alias("low"),
        F.max(F.lit(1.0) - ratio(nav, F.greatest("adjusted_nav", "peak"))).alias("drawdown"),
        F.min("step").alias("drop"),
        F.collect_list(F.when(closes_week, F.struct(week_end(day).alias("label"), nav.alias("nav")))).alias("weeks"),
    )
    return (
        records.groupBy(*by)
        .agg(
            F.sum("days").cast("int").alias("days"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.min("low.nav").alias("lowest"),
            F.max("drawdown").alias("drawdown"),
            F.min("drop").alias("drop"),
            F.sort_array(F.flatten(F.collect_list("weeks"))).alias("weeks"),
            F.sort_array(F.collect_list(F.struct("first.day", "first.nav", "low"))).alias("records"),
        )
        .select(
            *by, "days",
            F.col("first.day").alias("first_day"), F.col("first.nav").alias("first_nav"),
            F.col("last.day").alias("last_day"), F.col("last.nav").alias("last_nav"),
            "lowest", "drawdown", "drop", "weeks", "records",
        )
    )


def refreshed(states: DataFrame, adjusted: DataFrame, since: str) -> DataFrame:
    """Stored summaries with those from `since`'s month on made anew; only these days are read."""
    first = month_of(F.lit(since).cast("date"))
    return states.where(F.col("month") < first).unionByName(month_states(adjusted.where(F.col("nav_date") >= first)))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` over a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _bucket(label: Column, nav: Column, base: Column, n: Column, up: Column, mean: Column, m2: Column) -> Column:
    named = {"label": label, "nav": nav, "base": base, "n": n, "up": up, "mean": mean, "m2": m2}
    return F.struct(*[column.alias(name) for name, column in named.items()]).cast(_BUCKET)


def _closed(state: Column, label: Column, nav: Column) -> Column:
    """The state after its last bucket is closed: that bucket's return is counted, another begins."""

    def count(change: Column) -> Column:
        n, up, mean, m2 = (F.coalesce(state[f], F.lit(0)) for f in ("n", "up", "mean", "m2"))
        away = change - mean
        counted = _bucket(label, nav, state["nav"], n + 1, up + (change > 0).cast("long"), mean + away / (n + 1), m2 + away * (away - away / (n + 1)))
        return F.when(change.isNull(), _bucket(label, nav, state["nav"], n, up, mean, m2)).otherwise(counted)

    return _let(pct_change(state["nav"], state["base"]), count)


def _with_bucket(state: Column, label: Column, nav: Column) -> Column:
    goes_on = _bucket(label, nav, *[state[f] for f in ("base", "n", "up", "mean", "m2")])
    return F.when(state["label"] == label, goes_on).otherwise(_closed(state, label, nav))


def _with_record(climb: Column, record: Column) -> Column:
    reached = climb["high"].isNull() | (record["nav"] >= climb["high"])
    gap = F.datediff(record["day"], climb["low"]["day"])
    return F.struct(
        F.when(reached, record["nav"]).otherwise(climb["high"]).alias("high"),
        F.when(reached, record["low"]).otherwise(F.least(climb["low"], record["low"])).alias("low"),
        F.when(reached, F.greatest(climb["recovery"], gap)).otherwise(climb["recovery"]).alias("recovery"),
    )


def _with_month(state: Column, month: Column) -> Column:
    high = state["climb"]["high"]
    across = F.lit(1.0) - ratio(month["lowest"], F.greatest(month["lowest"], high))
    merged = {
        "first_day": F.coalesce(state["first_day"], month["first_day"]),
        "first_nav": F.coalesce(state["first_nav"], month["first_nav"]),
        "last_day": month["last_day"],
        "last_nav": month["last_nav"],
        "drawdown": F.greatest(state["drawdown"], month["drawdown"], across),
        "drop": F.least(state["drop"], month["drop"], pct_change(month["first_nav"], state["last_nav"])),
        "climb": F.aggregate(month["records"], state["climb"], _with_record),
        "W": F.aggregate(month["weeks"], state["W"], lambda weeks, week: _with_bucket(weeks, week["label"], week["nav"])),
        "M": _with_bucket(state["M"], PERIOD_LABELS["M"](month["last_day"]), month["last_nav"]),
        "Q": _with_bucket(state["Q"], PERIOD_LABELS["Q"](month["last_day"]), month["last_nav"]),
    }
    return F.struct(*[column.alias(name) for name, column in merged.items()]).cast(_MERGED)


def merged(months: Column) -> Column:
    """The state over an array of summaries in the order of their days, its last buckets closed."""
    none = F.lit(None)

    def close(state: Column) -> Column:
        ends = {p: _closed(state[p], none.cast("date"), none.cast("double")) for p in _NAMES}
        return reduce(lambda s, p: s.withField(p, ends[p]), ends, state)

    return F.aggregate(months, none.cast(_MERGED), _with_month, close)


def _span_metrics(state: Column, suffix: str) -> dict[str, Column]:
    out = {
        f"annual_return{suffix}": annualised(state["first_nav"], state["last_nav"], F.datediff(state["last_day"], state["first_day"])),
        f"max_drawdown{suffix}": state["drawdown"],
        f"max_drawdown_recovery_days{suffix}": state["climb"]["recovery"].cast("double"),
        f"max_single_day_drop{suffix}": state["drop"],
    }
    for ptype, name in _NAMES.items():
        n, mean = state[ptype]["n"], state[ptype]["mean"]
        deviation = F.when(n > 1, F.sqrt(state[ptype]["m2"] / (n - 1)))
        out[f"up_{name}_ratio{suffix}"] = F.when(n > 0, state[ptype]["up"] / n)
        out[f"{name}_return_std{suffix}"] = F.when(n == 1, F.lit(0.0)).otherwise(finite_or_null(deviation))
        if ptype == "W" and suffix:
            yearly = mean * F.lit(WEEKS_PER_YEAR) - F.lit(RISK_FREE)
            out[f"sharpe_ratio{suffix}"] = F.when(deviation > 0, yearly / (deviation * F.sqrt(F.lit(WEEKS_PER_YEAR))))
    out[f"calmar_ratio{suffix}"] = calmar(out[f"annual_return{suffix}"], state["drawdown"])
    return out


def _since(start: Column) -> Column:
    return F.filter("months", lambda month: month["first_day"] >= start)


def _days_of(adjusted: DataFrame, months: Iterable[dt.date]) -> DataFrame:
    """The days of these calendar months, as ranges that a scan can push down."""
    day = F.col("nav_date")
    ranges = [(day >= F.lit(m)) & (day < F.lit((m + dt.timedelta(days=31)).replace(day=1))) for m in sorted(months)]
    return adjusted.where(reduce(lambda a, b: a | b, ranges)) if ranges else adjusted.limit(0)


def snapshot(
    states: DataFrame, adjusted: DataFrame, as_of: str | Column, stale_max_days: int = 2, latest: str | None = None
) -> DataFrame:
    """metrics.metric_snapshot from stored summaries; `adjusted` is read for the months cut by `latest` or a span.

    The months in which spans begin are looked up while the plan is built: one job over the summaries.
    """
    if latest is not None:
        cut = month_of(F.lit(latest).cast("date"))
        in_cut = up_to(adjusted.where(F.col("nav_date") >= cut), latest)
        states = states.where(F.col("month") < cut).unionByName(month_states(in_cut))
    states = states.withColumn("end_date", F.max("last_day").over(W.partitionBy("fund_code")))
    starts = {s: F.add_months("end_date", -12 * years) for s, years in SPANS.items() if years is not None}
    spans = F.inline(F.array(*[F.struct(F.lit(s).alias("span"), d.alias("start")) for s, d in starts.items()]))
    begun = states.select("fund_code", "month", "first_day", "last_day", spans)
    begun = begun.where((F.col("first_day") < F.col("start")) & (F.col("start") <= F.col("last_day")))
    cut_months = [r["month"] for r in begun.select("month").distinct().limit(PRUNED_MONTHS + 1).collect()]
    days = adjusted if len(cut_months) > PRUNED_MONTHS else _days_of(adjusted, cut_months)
    inside = up_to(days, latest).withColumn("month", month_of("nav_date")).join(
        begun.select("fund_code", "month", "span", "start"), ["fund_code", "month"]
    )
    heads = month_states(inside.where(F.col("nav_date") >= F.col("start")), "span")
    fields = [c for c in heads.columns if c not in ("fund_code", "span")]
    heads = heads.groupBy("fund_code").agg(
        *[F.max_by(F.struct(*fields), F.when(F.col("span") == s, F.lit(1))).alias(f"head{s}") for s in starts]
    )
    funds = states.groupBy("fund_code").agg(
        F.max("end_date").alias("end_date"), F.sort_array(F.collect_list(F.struct(*fields))).alias("months")
    )
    whole = funds.join(heads, "fund_code", "left").withColumn("state", merged(F.col("months")))
    for s, start in starts.items():
        later = _since(start)
        head = F.col(f"head{s}")
        whole = whole.withColumn(f"state{s}", merged(F.when(head.isNull(), later).otherwise(F.concat(F.array(head), later))))
    before = F.add_months("end_date", -1)
    recent = F.get(F.filter("months", lambda m: m["month"] == month_of(before)), F.lit(0))
    computed = {"recent_month_return": F.when(recent["days"] >= 2, pct_change(recent["last_nav"], recent["first_nav"]))}
    for s in SPANS:
        computed.update(_span_metrics(F.col(f"state{s}"), s))
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    stale = F.datediff(day, "end_date") > stale_max_days
    return whole.select(
        "fund_code",
        F.col("state.first_day").alias("nav_start_date"),
        F.col("end_date").alias("nav_end_date"),
        stale.alias("stale"),
        *[F.when(~stale, finite_or_null(computed[name])).alias(name) for name in METRICS],
    )
