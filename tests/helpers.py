"""Small-table helpers shared by the tests."""

from __future__ import annotations

import datetime as dt


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def days_from(start: str, count: int, step: int = 1) -> list[dt.date]:
    first = day(start)
    return [first + dt.timedelta(days=i * step) for i in range(count)]


def series(spark, values: dict[str, list[tuple[dt.date, float]]]):
    rows = [(code, d, float(v), float(v)) for code, points in values.items() for d, v in points]
    return spark.createDataFrame(rows, "fund_code string, nav_date date, unit_nav double, adjusted_nav double")


def by_key(df, *keys):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
