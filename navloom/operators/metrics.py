"""Daily NAV facts, period returns and the 33 risk/return metrics per fund.

The whole metric set costs one shuffle and one sort by (fund, day). Trailing
windows are not exploded into copies of the rows: each running state (peak,
drawdown episode, trough) is kept three times in the same window frame, fed only
with the days inside the full history, the last three years or the last year.

Input is one adjusted NAV per fund and day (see adjusted_nav.one_row_per_day), so
a window partition is bounded by calendar days and cannot be a hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from navloom.functions.returns import (
    PERIOD_LABELS,
    annualised,
    finite_or_null,
    pct_change,
    ratio,
)

# Annual risk-free rate, weeks per year.
RISK_FREE = 0.015
WEEKS_PER_YEAR = 52.0

# Suffix of the metric names -> years of the trailing window (None: full history).
SPANS = {"": None, "_3y": 3, "_1y": 1}

# The metric names in export order.
METRICS = (
    "annual_return",
    "up_quarter_ratio",
    "up_month_ratio",
    "up_week_ratio",
    "quarter_return_std",
    "month_return_std",
    "week_return_std",
    "max_drawdown",
    "annual_return_3y",
    "up_quarter_ratio_3y",
    "up_month_ratio_3y",
    "up_week_ratio_3y",
    "quarter_return_std_3y",
    "month_return_std_3y",
    "week_return_std_3y",
    "max_drawdown_3y",
    "annual_return_1y",
    "up_month_ratio_1y",
    "up_week_ratio_1y",
    "month_return_std_1y",
    "week_return_std_1y",
    "max_drawdown_1y",
    "recent_month_return",
    "sharpe_ratio_1y",
    "sharpe_ratio_3y",
    "calmar_ratio_1y",
    "calmar_ratio_3y",
    "max_drawdown_recovery_days",
    "max_drawdown_recovery_days_1y",
    "max_drawdown_recovery_days_3y",
    "max_single_day_drop",
    "max_single_day_drop_1y",
    "max_single_day_drop_3y",
)

_PERIOD_NAMES = {"W": "week", "M": "month", "Q": "quarter"}


def _by_day() -> WindowSpec:
    return W.partitionBy("fund_code").orderBy("nav_date")


def _whole() -> WindowSpec:
    # Ordered although the frame is the whole history: every window shares one sort.
    return _by_day().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def _before() -> WindowSpec:
    return _by_day().rowsBetween(W.unboundedPreceding, -1)


def _so_far() -> WindowSpec:
    return _by_day().rowsBetween(W.unboundedPreceding, W.currentRow)


def _day() -> Column:
    return F.col("nav_date")


def _nav() -> Column:
    return F.col("adjusted_nav")


def up_to(table: DataFrame, latest: str | None, column: str = "nav_date") -> DataFrame:
    """History truncated at a date (inclusive); None keeps everything."""
    return table if latest is None else table.where(F.col(column) <= F.lit(latest).cast("date"))


def latest_day(nav: DataFrame) -> DataFrame:
    """The dataset's as-of date: the last NAV day over all funds."""
    return nav.agg(F.max("nav_date").alias("as_of_date"))


def with_freshness(series: DataFrame, as_of: str | Column, stale_max_days: int = 2) -> DataFrame:
    """Add the fund's last day and whether that is too old on the as-of date."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return series.withColumn("end_date", F.max("nav_date").over(_whole())).withColumn(
        "stale", F.datediff(day, "end_date") > stale_max_days
    )


def _live_series(
    adjusted: DataFrame, as_of: str | Column, stale_max_days: int, latest: str | None
) -> DataFrame:
    columns = [c for c in ("unit_nav",) if c in adjusted.columns]
    series = up_to(adjusted, latest).dropna(subset=["nav_date", "adjusted_nav"])
    return with_freshness(
        series.select("fund_code", "nav_date", "adjusted_nav", *columns), as_of, stale_max_days
    )


def with_period_ends(series: DataFrame) -> DataFrame:
    """Mark each day that closes its week, month or quarter, with the bucket's return.

    A day closes a bucket when the fund's next day falls into another one, so empty
    buckets vanish and no regrouping is needed. prev_X is the last day of the
    fund's previous non-empty bucket.
    """
    following = F.lead("nav_date").over(_by_day())
    series = series.withColumn("next_date", following)
    for ptype, label in PERIOD_LABELS.items():
        closes = F.col("next_date").isNull() | (label(F.col("next_date")) != label(_day()))
        series = series.withColumn(f"closes_{ptype}", closes)
    closed = {
        f"prev_{ptype}": F.last(
            F.when(F.col(f"closes_{ptype}"), F.struct(_nav().alias("nav"), _day().alias("day"))),
            ignorenulls=True,
        ).over(_before())
        for ptype in PERIOD_LABELS
    }
    series = series.withColumns(closed)
    returns = {
        f"return_{ptype}": F.when(
            F.col(f"closes_{ptype}"), pct_change(_nav(), F.col(f"prev_{ptype}.nav"))
        )
        for ptype in PERIOD_LABELS
    }
    return series.withColumns(returns)


def daily_facts(
    adjusted: DataFrame, as_of: str, stale_max_days: int = 2, latest: str | None = None
) -> DataFrame:
    """Unit and adjusted NAV with the daily return, for funds that are not stale."""
    series = _live_series(adjusted, as_of, stale_max_days, latest).where(~F.col("stale"))
    unit_nav = F.col("unit_nav") if "unit_nav" in series.columns else F.lit(None).cast("double")
    return series.select(
        "fund_code",
        "nav_date",
        unit_nav.alias("unit_nav"),
        "adjusted_nav",
        pct_change(_nav(), F.lag("adjusted_nav").over(_by_day())).alias("daily_return"),
        F.col("end_date").alias("latest_nav_date"),
    )


def period_facts(
    adjusted: DataFrame, as_of: str, stale_max_days: int = 2, latest: str | None = None
) -> DataFrame:
    """Week, month and quarter returns, for funds that are not stale."""
    series = with_period_ends(
        _live_series(adjusted, as_of, stale_max_days, latest).where(~F.col("stale"))
    )
    rows = [
        F.struct(
            F.lit(ptype).alias("period_type"),
            F.date_format(label(_day()), "yyyy-MM-dd").alias("period_key"),
            label(F.col(f"prev_{ptype}.day")).alias("period_start"),
            label(_day()).alias("period_end"),
            F.col(f"return_{ptype}").alias("period_return"),
        )
        for ptype, label in PERIOD_LABELS.items()
    ]
    return series.select("fund_code", F.inline(F.array(*rows))).where("period_return is not null")


def with_span_starts(series: DataFrame) -> DataFrame:
    """Add the first day of each trailing span and of the last full month (needs end_date).

    As columns they are computed once per row, below the windows, and not once per use.
    """
    month_before = F.add_months("end_date", -1)
    starts = {
        f"start{suffix}": F.add_months("end_date", -12 * years)
        for suffix, years in SPANS.items()
        if years is not None
    }
    in_month = _day().between(F.trunc(month_before, "month"), F.last_day(month_before))
    return series.withColumns({**starts, "in_last_month": in_month})


def _inside(suffix: str, day: Column | None = None) -> Column:
    day = _day() if day is None else day
    return day >= F.col(f"start{suffix}") if SPANS[suffix] else F.lit(True)


def _with_spans(adjusted: DataFrame) -> DataFrame:
    return with_span_starts(adjusted.withColumn("end_date", F.max("nav_date").over(_whole())))


def trailing_window(adjusted: DataFrame, years: int) -> DataFrame:
    """The fund's rows of the last N calendar years before its last day (inclusive)."""
    return _with_spans(adjusted).where(_day() >= F.add_months("end_date", -12 * years))


def last_full_month(adjusted: DataFrame) -> DataFrame:
    """The fund's rows of the last complete calendar month before its last day's month."""
    return _with_spans(adjusted).where("in_last_month")


def with_daily_return(adjusted: DataFrame) -> DataFrame:
    """Add the change against the fund's previous day."""
    return adjusted.withColumn(
        "daily_return", pct_change(_nav(), F.lag("adjusted_nav").over(_by_day()))
    )


def with_drawdown_state(series: DataFrame, suffixes=tuple(SPANS)) -> DataFrame:
    """Running peak, and on each day that reaches it the days since the trough before it.

    A day at or above every earlier value starts an episode. The trough of an
    episode is its first lowest value; ordering running minima by descending
    episode number first keeps exactly the current episode's trough in the frame.
    """
    series = series.withColumns(
        {f"peak{s}": F.max(F.when(_inside(s), _nav())).over(_before()) for s in suffixes}
    )
    series = series.withColumns(
        {
            f"at_peak{s}": _inside(s) & (F.col(f"peak{s}").isNull() | (_nav() >= F.col(f"peak{s}")))
            for s in suffixes
        }
    )
    series = series.withColumns(
        {f"episode{s}": F.count_if(f"at_peak{s}").over(_so_far()) for s in suffixes}
    )
    lowest = {
        f"trough{s}": F.min(
            F.when(
                _inside(s),
                F.struct(
                    (-F.col(f"episode{s}")).alias("latest_first"),
                    _nav().alias("nav"),
                    _day().alias("day"),
                ),
            )
        ).over(_before())
        for s in suffixes
    }
    series = series.withColumns(lowest)
    return series.withColumns(
        {
            f"recovery_days{s}": F.when(
                F.col(f"at_peak{s}"), F.datediff(_day(), F.col(f"trough{s}.day"))
            )
            for s in suffixes
        }
    )


def up_ratio(returns: Column) -> Column:
    """Share of positive returns; null without any."""
    return F.avg((returns > 0).cast("double"))


def return_std(returns: Column) -> Column:
    """Sample standard deviation; 0 for exactly one return, null without any."""
    return F.when(F.count(returns) == 1, F.lit(0.0)).otherwise(
        finite_or_null(F.stddev_samp(returns))
    )


def sharpe(weekly: Column) -> Column:
    deviation = F.stddev_samp(weekly)
    return F.when(
        (F.count(weekly) > 1) & (deviation > 0),
        (F.avg(weekly) * F.lit(WEEKS_PER_YEAR) - F.lit(RISK_FREE))
        / (deviation * F.sqrt(F.lit(WEEKS_PER_YEAR))),
    )


def calmar(annual: Column, drawdown: Column) -> Column:
    return F.when(drawdown > 0, annual / drawdown)


def annual_return(inside: Column) -> Column:
    """Annualised return between the first and last day for which `inside` holds."""
    day = F.when(inside, _day())
    return annualised(
        F.min_by("adjusted_nav", day), F.max_by("adjusted_nav", day), F.datediff(F.max(day), F.min(day))
    )


def recent_month_return() -> Column:
    """Last over first value in the last complete calendar month before the end date."""
    day = F.when(F.col("in_last_month"), _day())
    return F.when(
        F.count(day) >= 2, pct_change(F.max_by("adjusted_nav", day), F.min_by("adjusted_nav", day))
    )


def _aggregates(suffix: str) -> dict[str, Column]:
    inside = _inside(suffix)
    drawdown = F.when(
        inside, F.lit(1.0) - ratio(_nav(), F.greatest("adjusted_nav", f"peak{suffix}"))
    )
    daily = F.when(
        _inside(suffix, F.col("prev_date")), pct_change(_nav(), F.col("prev_nav"))
    )
    out = {
        f"annual_return{suffix}": annual_return(inside),
        f"max_drawdown{suffix}": F.max(drawdown),
        f"max_drawdown_recovery_days{suffix}": F.max(f"recovery_days{suffix}").cast("double"),
        f"max_single_day_drop{suffix}": F.min(daily),
    }
    for ptype, name in _PERIOD_NAMES.items():
        # A bucket return counts for a span only if the bucket before it also has a day inside.
        returns = F.when(_inside(suffix, F.col(f"prev_{ptype}.day")), F.col(f"return_{ptype}"))
        out[f"up_{name}_ratio{suffix}"] = up_ratio(returns)
        out[f"{name}_return_std{suffix}"] = return_std(returns)
        if ptype == "W" and suffix:
            out[f"sharpe_ratio{suffix}"] = sharpe(returns)
    return out


def metric_snapshot(
    adjusted: DataFrame,
    as_of: str | Column,
    stale_max_days: int = 2,
    latest: str | None = None,
) -> DataFrame:
    """One row per fund: NAV range, stale flag and the 33 metrics (null for stale funds)."""
    series = _live_series(adjusted, as_of, stale_max_days, latest).drop("unit_nav")
    series = with_span_starts(series)
    series = series.withColumns(
        {"prev_nav": F.lag("adjusted_nav").over(_by_day()), "prev_date": F.lag("nav_date").over(_by_day())}
    )
    series = with_drawdown_state(with_period_ends(series))
    computed = {"recent_month_return": recent_month_return()}
    for suffix in SPANS:
        computed.update(_aggregates(suffix))
    grouped = series.groupBy("fund_code").agg(
        F.min("nav_date").alias("nav_start_date"),
        F.max("nav_date").alias("nav_end_date"),
        F.any_value("stale").alias("stale"),
        *[expr.alias(name) for name, expr in computed.items() if name in METRICS],
    )
    for suffix in ("_3y", "_1y"):
        grouped = grouped.withColumn(
            f"calmar_ratio{suffix}",
            calmar(F.col(f"annual_return{suffix}"), F.col(f"max_drawdown{suffix}")),
        )
    return grouped.select(
        "fund_code",
        "nav_start_date",
        "nav_end_date",
        "stale",
        *[F.when(~F.col("stale"), finite_or_null(F.col(name))).alias(name) for name in METRICS],
    )


