"""Composite score and rank of the scoreboard funds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from navloom.session import written

# Group -> (weight, ((input, weight in group, larger is better), ...)).
GROUPS = {
    "risk_control": (
        0.35,
        (
            ("max_drawdown_1y", 0.4, False),
            ("max_drawdown_recovery_days_3y", 0.4, False),
            ("max_drawdown_3y", 0.2, False),
        ),
    ),
    "short_term": (
        0.30,
        (
            ("calmar_ratio_1y", 0.5, True),
            ("annual_return_1y", 0.3, True),
            ("recent_month_return", 0.2, True),
        ),
    ),
    "holding_experience": (
        0.20,
        (
            ("up_week_ratio_1y", 0.3, True),
            ("up_month_ratio_3y", 0.3, True),
            ("week_return_std_1y", 0.4, False),
        ),
    ),
    "long_term": (
        0.15,
        (
            ("calmar_ratio_3y", 0.5, True),
            ("annual_return_3y", 0.3, True),
            ("sharpe_ratio_3y", 0.2, True),
        ),
    ),
}
# Exported headers of the result columns.
SCORE_HEADERS = {
    "score_risk_control": "得分_风险控制",
    "score_short_term": "得分_短期业绩",
    "score_holding_experience": "得分_持有体验",
    "score_long_term": "得分_长期业绩",
    "score": "综合得分",
    "rank": "综合排名",
}
NEUTRAL = 0.5
INPUTS = tuple(name for _, inputs in GROUPS.values() for name, _, _ in inputs)


def _number(name: str) -> Column:
    return F.nanvl(F.col(name).try_cast("double"), F.lit(None).cast("double"))


def input_ranges(table: DataFrame) -> DataFrame:
    """Smallest and largest value of every score input, in one row."""
    present = [name for name in INPUTS if name in table.columns]
    return table.agg(
        *[F.min(_number(n)).alias(f"{n}_min") for n in present],
        *[F.max(_number(n)).alias(f"{n}_max") for n in present],
    )


def min_max(value: Column, low: Column, high: Column, larger_is_better: bool) -> Column:
    """Position in [low, high]; null when the value is missing or all values are equal."""
    position = F.when(low != high, F.nanvl((value - low) / (high - low), F.lit(None).cast("double")))
    return position if larger_is_better else F.lit(1.0) - position


def composite_score(table: DataFrame, ranked: bool = True) -> DataFrame:
    """The input with four group scores, the composite score and its rank.

    A missing value counts as neutral; absent input columns drop out and the rest of
    their group is re-weighted. The ranges come from a scalar subquery: no join, and
    nothing of the table passes through one task.
    """
    present = [name for name in INPUTS if name in table.columns]
    scored = table
    total = F.lit(0.0)
    if present:
        # One column, so that the plan holds the subquery once and not per use.
        packed = input_ranges(table).select(F.struct("*").alias("ranges"))
        scored = table.withColumn("ranges", packed.scalar())
    for group, (weight, inputs) in GROUPS.items():
        value, weights = F.lit(0.0), 0.0
        for name, share, larger_is_better in inputs:
            if name not in table.columns:
                continue
            position = min_max(
                _number(name),
                F.col(f"ranges.{name}_min"),
                F.col(f"ranges.{name}_max"),
                larger_is_better,
            )
            value = value + F.lit(share) * F.coalesce(position, F.lit(NEUTRAL))
            weights += share
        scored = scored.withColumn(f"score_{group}", value / F.lit(weights) if weights else value)
        total = total + F.lit(weight) * F.col(f"score_{group}")
    scored = scored.withColumn("score", total).drop("ranges")
    # Ranking reads the scores several times; stored, they are computed once.
    return global_rank(written(scored, "scores"), "score") if ranked else scored


def global_rank(table: DataFrame, column: str, name: str = "rank", range_rows: int = 1 << 16) -> DataFrame:
    """Competition rank (1, 2, 2, 4) by a numeric column, largest first, without one global sort.

    Equal values are counted first, so ties never pile up in a task. The distinct values are dealt
    into ranges of about `range_rows`, however many there are, and stored with the number of their
    range; a value's rank is one plus the rows in the ranges above plus the rows above it in its own
    range. Rows without a number (null or NaN) have no rank and pass by the join.
    """
    numbered = F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    counts = written(table.where(numbered).groupBy(column).agg(F.count("*").alias("ties")), "ties")
    ranges = max(1, -(-counts.count() // range_rows))
    dealt = counts.repartitionByRange(ranges, F.desc(column)).withColumn("range", F.spark_partition_id())
    ranged = written(dealt, "ranges")
    totals = ranged.groupBy("range").agg(F.sum("ties").alias("total"))
    higher = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("range", F.coalesce(F.sum("total").over(higher), F.lit(0)).alias("above"))
    within = W.partitionBy("range").orderBy(F.desc(column)).rowsBetween(W.unboundedPreceding, -1)
    ranks = ranged.join(offsets, "range").select(
        column,
        (F.lit(1) + F.col("above") + F.coalesce(F.sum("ties").over(within), F.lit(0)))
        .cast("int")
        .alias(name),
    )
    ranked = table.where(numbered).join(ranks, column, "left").select(*table.columns, name)
    return ranked.union(table.where(~numbered | F.col(column).isNull()).select(*table.columns, F.lit(None).cast("int").alias(name)))
