"""Registry of queries: a Spark callable and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
# Named SQL table definitions an oracle may refer to.
TABLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return function

    return register


def with_tables(sql: str) -> str:
    """Put the definitions of the named tables a statement uses in front of it."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(TABLES[name])
                if name not in used:
                    used.append(name)

    visit(sql)
    definitions = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in used)
    return f"WITH {definitions}\n{sql.strip()}" if used else sql.strip()


def r6(value: Column | str) -> Column:
    """Six decimals, without negative zero: sums differ in their last bits between engines."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column, 6) + F.lit(0.0)


def sql_r6(expression: str) -> str:
    return f"(round({expression}, 6) + 0e0)"


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: r6(name) for name in names})
