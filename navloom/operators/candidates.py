"""Which funds go on: blacklist, five quality rules, work lists and samples."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.functions import display, text
from navloom.operators.dedupe import keep_first


class Effective(NamedTuple):
    purchase: DataFrame
    counts: DataFrame  # original_count, blacklist_removed, effective_count


def without_blacklisted(purchase: DataFrame, blacklist: DataFrame) -> DataFrame:
    codes = blacklist.select("fund_code").distinct()
    padded = purchase.withColumn("fund_code", text.fund_code(F.col("fund_code")))
    return padded.join(codes, "fund_code", "left_anti")


def blacklist_counts(purchase: DataFrame, blacklist: DataFrame) -> DataFrame:
    codes = blacklist.select("fund_code").distinct().withColumn("listed", F.lit(True))
    padded = purchase.select(text.fund_code(F.col("fund_code")).alias("fund_code"))
    listed = F.coalesce("listed", F.lit(False))
    return padded.join(codes, "fund_code", "left").agg(
        F.count("*").alias("original_count"),
        F.count_if(listed).alias("blacklist_removed"),
        F.count_if(~listed).alias("effective_count"),
    )


def effective_purchase(purchase: DataFrame, blacklist: DataFrame) -> Effective:
    """Purchase list without blacklisted funds; nothing left is an error."""
    kept = without_blacklisted(purchase, blacklist)
    if kept.isEmpty():
        raise ValueError("no fund is left after removing the blacklisted ones")
    return Effective(kept, blacklist_counts(purchase, blacklist))


def unfiltered(purchase: DataFrame, filtered: DataFrame) -> DataFrame:
    """Purchase rows of the funds that passed the filter."""
    kept = filtered.where(~F.col("is_filtered")).select(
        text.fund_code(F.col("fund_code")).alias("fund_code")
    )
    padded = purchase.withColumn("fund_code", text.fund_code(F.col("fund_code")))
    return padded.join(kept.distinct(), "fund_code", "left_semi")


def filtered_purchase(purchase: DataFrame, filtered: DataFrame) -> DataFrame:
    kept = unfiltered(purchase, filtered)
    if kept.isEmpty():
        raise ValueError("all funds are filtered out")
    return kept


#: What is known of a fund, each from one table.
FLAGS = (
    "listed", "has_overview", "has_nav", "has_adjusted", "compared", "compared_later", "deviates", "checked", "incomplete",
)


def _flagged(table: DataFrame, **flags: Column) -> DataFrame:
    """A row of flags for each row of a table; the flags it does not tell are null."""
    none = F.lit(None).cast("boolean")
    padded = text.fund_code(F.col("fund_code")).alias("fund_code")
    return table.select(padded, *[flags.get(name, none).alias(name) for name in FLAGS])


def compare_flags(details: DataFrame, start: str, max_abs_deviation: float) -> dict[str, Column]:
    """Is a compared day on or after the start, and does it deviate too much?

    The deviation is judged as exported, that is rounded to ten decimals.
    """
    later = F.col("start_date") >= F.lit(start).cast("date")
    shown = display.round_exact(F.abs("deviation"), 10)
    return {"compared_later": later, "deviates": later & (shown >= max_abs_deviation)}


def filter_candidates(
    purchase: DataFrame,
    overview: DataFrame,
    nav: DataFrame,
    adjusted: DataFrame,
    compare_details: DataFrame,
    integrity_details: DataFrame,
    start: str = "2023-01-01",
    max_abs_deviation: float = 0.02,
    compare_summary: DataFrame | None = None,
    integrity_summary: DataFrame | None = None,
) -> DataFrame:
    """Each purchase fund with the rules it breaks (fund_code, is_filtered, reasons).

    The summaries, if given, tell a fund that was checked but has no detail rows
    (a single common day, an empty calendar) from one that was not checked.
    """
    yes = F.lit(True)
    compared = {} if compare_summary is not None else {"compared": yes}
    checked = {} if integrity_summary is not None else {"checked": yes}
    incomplete = (F.col("trade_date") >= F.lit(start).cast("date")) & ~F.col("exists")
    tables = [
        _flagged(purchase, listed=yes),
        _flagged(overview, has_overview=yes),
        _flagged(nav, has_nav=yes),
        _flagged(adjusted, has_adjusted=yes),
        _flagged(compare_details, **compared, **compare_flags(compare_details, start, max_abs_deviation)),
        _flagged(integrity_details, **checked, incomplete=incomplete),
    ]
    if compare_summary is not None:
        tables.append(_flagged(compare_summary.where("not missing"), compared=yes))
    if integrity_summary is not None:
        tables.append(_flagged(integrity_summary, checked=yes))
    # Every table is read once; rows become one per fund before the only shuffle.
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    known = rows.where("fund_code is not null").groupBy("fund_code").agg(*[F.bool_or(name).alias(name) for name in FLAGS])
    funds = known.where("listed")

    def absent(flag: str) -> Column:
        return F.col(flag).isNull()

    # Reason texts.
    rules = (
        (absent("has_overview"), "规则1: fund_overview.csv 中不存在该基金"),
        (absent("has_nav"), "规则2: fund_nav_by_code 中不存在该基金"),
        (absent("has_adjusted"), "规则3: fund_adjusted_nav_by_code 中不存在该基金"),
        (absent("compared"), "规则4: compare details 缺失或无比对记录"),
        (
            ~absent("compared") & ~F.coalesce("compared_later", F.lit(False)),
            "规则4: 指定日期后无任何比对记录",
        ),
        (F.col("deviates"), f"规则4: 指定日期后存在偏差>={max_abs_deviation:.2%}"),
        (absent("checked"), "规则5: trade day integrity details 缺失"),
        (F.col("incomplete"), "规则5: 指定日期后存在交易日数据不完整"),
    )
    reasons = display.joined_reasons((holds, F.lit(reason)) for holds, reason in rules)
    return funds.select("fund_code", reasons.alias("reasons")).select(
        "fund_code", (F.col("reasons") != "").alias("is_filtered"), "reasons"
    )


# Exported headers.
FILTER_HEADERS = {"fund_code": "基金编码", "is_filtered": "是否过滤", "reasons": "过滤原因"}


def filter_text(filtered: DataFrame) -> DataFrame:
    return filtered.select(
        F.col("fund_code").alias(FILTER_HEADERS["fund_code"]),
        display.yes_no(F.col("is_filtered")).alias(FILTER_HEADERS["is_filtered"]),
        F.col("reasons").alias(FILTER_HEADERS["reasons"]),
    )


def work_list(targets: DataFrame, done: DataFrame) -> DataFrame:
    """Target codes that are not done yet."""
    wanted = targets.select(text.fund_code(F.col("fund_code")).alias("fund_code")).dropna().distinct()
    finished = done.select(text.fund_code(F.col("fund_code")).alias("fund_code")).distinct()
    return wanted.join(finished, "fund_code", "left_anti")


def retry_list(targets: DataFrame, log: DataFrame, stage: str) -> DataFrame:
    """Target codes with a failure of the stage in the log."""
    failed = log.where((F.col("stage") == stage) & (F.col("code") != "")).select(
        text.fund_code(F.col("code")).alias("fund_code")
    )
    wanted = targets.select(text.fund_code(F.col("fund_code")).alias("fund_code")).dropna().distinct()
    return wanted.join(failed.distinct(), "fund_code", "left_semi")


def load_report(
    targets: DataFrame, done: DataFrame, loaded: DataFrame, failed: DataFrame
) -> DataFrame:
    """Totals of one load: target codes, already done, loaded, failed, rows written."""
    wanted = targets.select("fund_code").dropna().distinct()
    finished = done.select("fund_code").distinct().withColumn("done", F.lit(True))
    rows = loaded.groupBy("fund_code").agg(F.count("*").alias("rows"))
    failures = failed.select("fund_code").distinct().withColumn("failed", F.lit(True))
    joined = wanted
    for side in (finished, rows, failures):
        joined = joined.join(side, "fund_code", "left")
    to_load = F.col("done").isNull()
    return joined.agg(
        F.count("*").alias("total_codes"),
        F.count_if(~to_load).alias("already_done"),
        F.count_if(to_load & F.col("rows").isNotNull()).alias("loaded"),
        F.count_if(to_load & F.col("failed").isNotNull() & F.col("rows").isNull()).alias("failed"),
        F.coalesce(F.sum(F.when(to_load, F.col("rows"))), F.lit(0)).alias("rows_written"),
    )


def run_report(
    purchase: DataFrame, blacklist: DataFrame, filtered: DataFrame, filtered_list: DataFrame
) -> DataFrame:
    """Fund counts along the run: one row per measure."""
    removal = blacklist_counts(purchase, blacklist)
    counts = removal.select(
        F.explode(
            F.create_map(
                F.lit("original"), "original_count",
                F.lit("blacklist_removed"), "blacklist_removed",
                F.lit("effective"), "effective_count",
            )
        ).alias("measure", "funds")
    )
    after = filtered_list.agg(F.count("*").alias("funds")).select(
        F.lit("after_filter").alias("measure"), "funds"
    )
    dropped = filtered.agg(F.count_if("is_filtered").alias("funds")).select(
        F.lit("filtered").alias("measure"), "funds"
    )
    return counts.unionByName(after).unionByName(dropped)


def failures_by_stage(log: DataFrame) -> DataFrame:
    """Failure count per stage; a blank or absent stage counts as "unknown"."""
    stage = F.trim(F.coalesce("stage", F.lit("unknown")))
    return (
        log.withColumn("stage", F.when(stage == "", F.lit("unknown")).otherwise(stage))
        .groupBy("stage")
        .agg(F.count("*").alias("failures"))
    )


def pinned_sample(
    purchase: DataFrame,
    order: list[Column],
    pinned: str = "163402",
    size: int = 20,
    require_full: bool = False,
) -> DataFrame:
    """The first `size` distinct codes in order plus the pinned one (blank row if it is absent)."""
    padded = purchase.withColumn("fund_code", text.fund_code(F.col("fund_code")))
    columns = padded.columns
    ranked = keep_first(
        padded.select("*", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("position")),
        ["fund_code"],
        [F.col("position")],
    )
    is_pinned = F.col("fund_code") == pinned
    head = ranked.where(~is_pinned).orderBy("position").limit(size).select(*columns)
    if require_full and head.count() < size:
        raise ValueError(f"fewer than {size} funds to sample from")
    found = ranked.where(is_pinned).select(*columns)
    blank = padded.agg(F.lit(pinned).alias("fund_code")).select(
        *[F.col(c) if c == "fund_code" else F.lit("").alias(c) for c in columns]
    )
    pinned_row = blank.join(found.select("fund_code"), "fund_code", "left_anti").select(*columns)
    return head.unionByName(found).unionByName(pinned_row)
