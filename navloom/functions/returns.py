"""Return arithmetic and calendar buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")


def finite_or_null(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """IEEE division (x/0 is an infinity) with 0/0 and NaN as null instead of an ANSI error."""
    return finite_or_null(
        F.when(denominator != 0, numerator / denominator)
        .when((denominator == 0) & (numerator > 0), F.lit(_INF))
        .when((denominator == 0) & (numerator < 0), F.lit(-_INF))
    )


def pct_change(current: Column, previous: Column) -> Column:
    return ratio(current, previous) - F.lit(1.0)


def annualised(first: Column, last: Column, days: Column) -> Column:
    """(last/first)^(365/days) - 1, null unless both values and the day count are positive."""
    return F.when(
        (first > 0) & (last > 0) & (days > 0),
        F.pow(last / first, F.lit(365.0) / days) - F.lit(1.0),
    )


def week_end(day: Column) -> Column:
    """The Friday on or after the day."""
    return F.next_day(F.date_sub(day, 1), "FRI")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


# Period type -> bucket label of a day (the label is the last calendar day of the bucket).
PERIOD_LABELS = {"W": week_end, "M": month_end, "Q": quarter_end}
