"""End-to-end runs: landed files to scoreboard, and scoreboard of a version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.operators import (
    adjusted_nav,
    candidates,
    consistency,
    contracts,
    integrity,
    metrics,
    normalise,
    scoreboard,
)
from navloom.sinks import tables as sinks
from navloom.sources import files, schemas


@dataclass(frozen=True)
class Settings:
    data_version: str
    start: str = "2023-01-01"
    end: str | None = None  # the last NAV day
    as_of: str | None = None
    stale_max_days: int = 2
    max_abs_deviation: float = 0.02
    allow_missing_event_until: str | None = None
    latest_nav_date: str | None = None
    metrics_only: bool = True
    write_scope: str = "full"
    resume: bool = False


@dataclass(frozen=True)
class Landing:
    """Paths of the landed files."""

    purchase: str
    overview: str
    nav: str
    bonus: str
    split: str
    personnel: str
    cum_return: str
    calendar: str
    blacklist: str | None = None


def scoreboard_run(
    purchase: DataFrame,
    overview: DataFrame,
    personnel: DataFrame,
    adjusted: DataFrame,
    root: str,
    settings: Settings,
    order=(),
) -> dict[str, DataFrame]:
    """The stage tables of a version by name; see `scoreboard_stages`."""
    done = scoreboard_stages(purchase, overview, personnel, adjusted, root, settings, order)
    return {name: table for name, table in done.tables.items() if name != "assessed"}


def scoreboard_stages(
    purchase: DataFrame,
    overview: DataFrame,
    personnel: DataFrame,
    adjusted: DataFrame,
    root: str,
    settings: Settings,
    order=(),
) -> sinks.Stages:
    """Dimension, metrics, facts and scoreboard of one version, stored stage by stage under `root`.

    Stage tables are Parquet: they cut the lineage (each is computed once, though several
    results read it). A repeated run with `resume` reads back those whose inputs and settings are
    unchanged, by content, and computes the others.
    """
    spark = purchase.sparkSession
    version, latest = settings.data_version, settings.latest_nav_date
    codes = purchase.select("fund_code").distinct()
    series = files.only_codes(adjusted, codes)
    as_of = settings.as_of
    if as_of is None:
        as_of = str(metrics.latest_day(metrics.up_to(series, latest)).first().as_of_date)
    history = (series, as_of, settings.stale_max_days, latest)

    def dim(_) -> DataFrame:
        last_change = normalise.latest_personnel_date(personnel, latest)
        return normalise.dim_base(purchase, overview, last_change, version, as_of, order)

    def tagged(facts):
        return lambda _: normalise.tagged(facts(*history), version, as_of)

    days = (sinks.fingerprint(series), as_of, str(settings.stale_max_days), str(latest))
    listed = (*map(sinks.fingerprint, (purchase, overview, personnel)), version, as_of, str(latest))
    assessed = ("assessed",)
    stages = {
        "dim_base": sinks.Stage(dim, listed),
        "metrics": sinks.Stage(lambda _: metrics.metric_snapshot(*history), days),
        "assessed": sinks.Stage(
            lambda t: scoreboard.assess(t["metrics"], t["dim_base"], version, as_of), (version, as_of), ("metrics", "dim_base")
        ),
        "scoreboard": sinks.Stage(lambda t: scoreboard.kept_funds(t["assessed"]), after=assessed),
        "exclusion_detail": sinks.Stage(
            lambda t: sinks.unique_exclusions(scoreboard.exclusion_detail(t["assessed"])), after=assessed
        ),
        "exclusion_summary": sinks.Stage(
            lambda t: scoreboard.exclusion_summary(scoreboard.exclusion_detail(t["assessed"])), after=assessed
        ),
    }
    if not settings.metrics_only:
        stages["nav_daily"] = sinks.Stage(tagged(metrics.daily_facts), (*days, version))
        stages["return_period"] = sinks.Stage(tagged(metrics.period_facts), (*days, version))
    return sinks.resume_or_compute(spark, f"{root}/stage", version, stages, settings.resume and latest is None)


def store_version(result: dict[str, DataFrame], root: str, settings: Settings) -> None:
    """Write the dimensions and, unless only metrics were computed, the facts of a version."""
    version = settings.data_version
    for name in ("dim_base", "exclusion_detail", "exclusion_summary"):
        sinks.write_version(result[name], f"{root}/{name}", version)
    if settings.metrics_only:
        return
    last = result["dim_base"].agg(F.max("as_of_date")).first()[0]
    snapshot = normalise.tagged(
        result["metrics"].where(~F.col("stale")).drop("stale"),
        version,
        str(last) if last else settings.as_of,
    )
    facts = {
        "nav_daily": result["nav_daily"],
        "return_period": result["return_period"],
        "metrics_snapshot": sinks.with_columns_of(snapshot, scoreboard.METRICS_COLUMNS),
        "scoreboard_snapshot": result["scoreboard"],
    }
    sinks.write_facts(facts, root, version, settings.write_scope)


def full_run(spark: SparkSession, landing: Landing, root: str, settings: Settings) -> dict[str, DataFrame]:
    """All steps from landed files to the scoreboard; every intermediate is stored under `root`.

    Tables become current by a commit, after their contract's rules, measured while they were written,
    hold; a run that fails leaves those before it. Rejected funds go to the run's own failure log, counts
    to its report, the scoreboard and its exclusions to CSV exports.
    """
    version = settings.data_version

    def stored(table: DataFrame, name: str, contract: str | None = None) -> DataFrame:
        key = f"{name}@{version}"
        if contract is None:
            return sinks.store(spark, f"{root}/run", key, table)
        watched = contracts.observed(contract, table, contracts.CONTRACTS[contract])
        return sinks.store(
            spark, f"{root}/run", key, watched.table, check=lambda t: contracts.required(watched.violations(t))
        )

    raw_purchase = files.read_table(spark, landing.purchase, schemas.PURCHASE, line_order=True)
    order = [F.col(files.LINE_ORDER)]
    raw_purchase = stored(raw_purchase, "purchase_landed", "purchase")
    blacklist = stored(files.read_blacklist(spark, landing.blacklist), "blacklist", "blacklist")
    purchase = stored(candidates.effective_purchase(raw_purchase, blacklist).purchase, "purchase", "purchase_effective")

    overview = files.read_table(spark, landing.overview, schemas.OVERVIEW_LANDED, line_order=True)
    overview = stored(overview, "overview_landed", "overview")
    per_fund = files.read_per_fund_files
    nav = normalise.nav(per_fund(spark, landing.nav, schemas.NAV, required=("nav_date", "unit_nav"), line_order=True))
    bonus = stored(normalise.bonus(per_fund(spark, landing.bonus, schemas.BONUS)), "bonus")
    split = stored(normalise.split(per_fund(spark, landing.split, schemas.SPLIT)), "split")
    cum_return = normalise.cum_return(per_fund(spark, landing.cum_return, schemas.CUM_RETURN, line_order=True))
    # All are read several times below: parsed once.
    nav, cum_return = stored(nav, "nav"), stored(cum_return, "cum_return")
    repeated = stored(adjusted_nav.repeated_days(nav), "nav_repeated_days")
    calendar = stored(files.read_calendar(spark, landing.calendar), "calendar", "calendar")

    # A fund counts as landed when its file exists, also one without rows.
    landed = {
        name: files.codes_with_file(spark, path)
        for name, path in (("nav", landing.nav), ("bonus", landing.bonus), ("split", landing.split))
    }
    contracts.require_stage(spark, "adjusted_nav_input", landed)
    result = adjusted_nav.adjust_all(
        nav,
        bonus,
        split,
        codes=landed["nav"],
        bonus_codes=landed["bonus"],
        split_codes=landed["split"],
        allow_missing_until=settings.allow_missing_event_until,
    )
    adjusted = stored(result.adjusted, "adjusted_nav")
    rejects = stored(result.rejects, "adjusted_nav_rejects")

    # Overview and calendar were checked when they were stored; so are other tables from here on.
    contracts.require_funds({"adjusted_nav": adjusted, "cum_return": cum_return})
    end = settings.end or str(metrics.latest_day(adjusted).first().as_of_date)
    window = (adjusted, overview, calendar, settings.start, end)
    whole = stored(integrity.detail(*window), "integrity_details")
    shares = stored(integrity.summary(*window), "integrity_summary")

    compared = consistency.compare(adjusted, cum_return)
    details = stored(compared.detail, "compare_details")
    summary = stored(compared.summary, "compare_summary")
    errors = stored(compared.errors, "compare_errors")

    contracts.require_funds({"compare_details": details, "integrity_details": whole})
    filtered = stored(
        candidates.filter_candidates(
            purchase,
            overview,
            landed["nav"],
            adjusted,
            details,
            whole,
            settings.start,
            settings.max_abs_deviation,
            compare_summary=summary,
            integrity_summary=shares,
        ),
        "candidates",
        "candidates",
    )
    remaining = stored(candidates.filtered_purchase(purchase, filtered), "purchase_filtered", "purchase_filtered")
    # Only the remaining funds' notices are opened.
    personnel = per_fund(spark, landing.personnel, schemas.PERSONNEL, codes=remaining)
    personnel = stored(normalise.personnel(personnel), "personnel")
    contracts.require_funds({"personnel": personnel})

    board = scoreboard_run(remaining, overview, personnel, adjusted, root, settings, order)
    contracts.require_stage(spark, "scoreboard_output", {"scoreboard": board["scoreboard"]})
    store_version(board, root, settings)
    exports = {
        "scoreboard": scoreboard.export(board["scoreboard"]),
        "exclusion_detail": board["exclusion_detail"],
        "exclusion_summary": board["exclusion_summary"],
    }
    for name, table in exports.items():
        sinks.write_csv(table, f"{root}/export/data_version={version}/{name}")

    sinks.write_failures(rejects.unionByName(errors), f"{root}/failures", version)
    failures = sinks.read_failures(spark, f"{root}/failures", [version])
    counts = candidates.run_report(raw_purchase, blacklist, filtered, remaining).select("measure", F.col("funds").alias("n"))
    by_stage = candidates.failures_by_stage(failures).select(
        F.concat(F.lit("failures in "), "stage").alias("measure"), F.col("failures").alias("n")
    )
    loads = candidates.load_report(purchase, purchase.where("false"), nav, failures.withColumnRenamed("code", "fund_code"))
    return {
        "failures": failures,
        "run_report": stored(counts.unionByName(by_stage), "run_report"),
        "load_report": stored(loads, "load_report"),
        "purchase": purchase,
        "adjusted_nav": adjusted,
        "adjusted_nav_rejects": rejects,
        "nav_repeated_days": repeated,
        "integrity_details": whole,
        "integrity_summary": shares,
        "compare_details": details,
        "compare_summary": summary,
        "compare_errors": errors,
        "candidates": filtered,
        "purchase_filtered": remaining,
        **board,
    }
