"""Sources and sinks: every query writes to the shared folder and reads the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.catalog import query, r6, rounded, sql_r6
from navloom.operators import normalise
from navloom.session import new_folder
from navloom.sinks import tables as sinks
from navloom.sources import files, schemas


def landed(table, columns, folder):
    """Write a text table the way sources land it: CSV under the source's headers."""
    headers = {name: header for header, name in columns.items()}
    table.select(*[F.col(n).alias(headers[n]) for n in columns.values()]).write.option("header", True).csv(folder)
    return folder


@query(
    "s1_csv_table_scan",
    """SELECT fund_code, short_name, subscribe_status, redeem_status, next_open_day,
              purchase_min_amount, daily_limit_amount, purchase_fee FROM purchase""",
)
def s1(spark, sf):
    folder = landed(b.purchase(spark, sf), schemas.PURCHASE, new_folder(spark, "purchase"))
    return normalise.purchase(files.read_table(spark, folder, schemas.PURCHASE))


@query("s2_per_fund_directory_scan", f"SELECT fund_code, nav_date, {sql_r6('unit_nav')} AS unit_nav FROM nav")
def s2(spark, sf):
    typed = normalise.nav(files.read_per_fund_files(spark, landed_nav(spark, sf), NAV_COLUMNS))
    return rounded(typed.drop("daily_growth"), "unit_nav")


NAV_COLUMNS = {"净值日期": "nav_date", "单位净值": "unit_nav"}


def landed_nav(spark, sf, write=sinks.write_per_fund):
    """NAV as text in one folder per fund, or as `write` lays it out."""
    folder = new_folder(spark, "nav-by-fund")
    names = {name: header for header, name in NAV_COLUMNS.items()}
    write(b.nav(spark, sf).select("fund_code", *[F.col(n).cast("string").alias(names[n]) for n in names]), folder)
    return folder


@query("s2_bucketed_directory_scan", f"SELECT fund_code, nav_date, {sql_r6('unit_nav')} AS unit_nav FROM nav WHERE fund_code LIKE '%7'")
def s2_bucketed(spark, sf):
    """Funds that share files, found by the index."""
    folder = landed_nav(spark, sf, sinks.write_bucketed)
    codes = b.nav(spark, sf).select("fund_code").where("fund_code like '%7'")
    typed = normalise.nav(files.read_per_fund_files(spark, folder, NAV_COLUMNS, codes=codes))
    return rounded(typed.drop("daily_growth"), "unit_nav")


@query(
    "s3_target_code_scan",
    f"""SELECT fund_code, nav_date, {sql_r6('unit_nav')} AS unit_nav FROM nav WHERE fund_code IN (
          SELECT fund_code FROM purchase WHERE fund_code NOT IN (SELECT fund_code FROM blacklist)
          ORDER BY fund_code LIMIT 25)""",
)
def s3(spark, sf):
    """Landed per-fund files, of which only the targets' are opened."""
    folder = landed_nav(spark, sf)
    targets = normalise.purchase(b.purchase(spark, sf)).join(b.blacklist(spark, sf), "fund_code", "left_anti")
    found = files.read_per_fund_files(spark, folder, NAV_COLUMNS, codes=targets, code_limit=25)
    return rounded(normalise.nav(found).drop("daily_growth"), "unit_nav")


@query("s4_trade_calendar_scan", "SELECT DISTINCT trade_date FROM raw_calendar WHERE trade_date IS NOT NULL")
def s4(spark, sf):
    folder = landed(b.raw_calendar(spark, sf), schemas.CALENDAR, new_folder(spark, "calendar"))
    return files.read_calendar(spark, folder)


@query(
    "s5_trade_calendar_range_scan",
    """SELECT trade_date FROM raw_calendar
       WHERE trade_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
)
def s5(spark, sf):
    return files.trade_days_between(b.raw_calendar(spark, sf), "1996-01-01", "1997-12-31")


def _log_file(spark, sf, with_bad_lines):
    """A JSON-lines file with the failures and, if asked for, blank and malformed lines."""
    errors = b.failure_log(spark, sf)
    lines = errors.select(F.to_json(F.struct("ts", "stage", "code", "error")).alias("value"))
    if with_bad_lines:
        other = b.read(spark, sf, "events").where("event_type <> 'error'")
        lines = lines.unionByName(
            other.select(F.when(F.col("event_type") == "view", "").otherwise("{not json").alias("value"))
        )
    folder = new_folder(spark, "failures")
    lines.write.text(folder)
    return folder


@query("s6_tolerant_log_scan", "SELECT ts, stage, code, error FROM failure_log")
def s6(spark, sf):
    return files.read_log_tolerant(spark, _log_file(spark, sf, with_bad_lines=True))


@query("s7_strict_log_scan", "SELECT ts, code, stage, error, count(*) AS n FROM failure_log GROUP BY ALL")
def s7(spark, sf):
    records = files.read_log_strict(spark, _log_file(spark, sf, with_bad_lines=False))
    names = ("ts", "code", "stage", "error")
    keyed = records.select(*[F.col(f"record.{name}").alias(name) for name in names])
    return keyed.groupBy(*names).agg(F.count("*").alias("n"))


@query("s8_blacklist_scan", "SELECT fund_code FROM blacklist")
def s8(spark, sf):
    """The code column has another name here and some blank cells, so the first column counts."""
    rows = b.read(spark, sf, "supplier").select(
        F.when(F.col("s_suppkey") % 10 == 3, F.col("s_suppkey").cast("string")).otherwise(" ").alias("code"),
        F.col("s_name").alias("remark"),
    )
    folder = new_folder(spark, "blacklist")
    rows.write.option("header", True).csv(folder)
    return files.read_blacklist(spark, folder)


@query(
    "k1_csv_sink",
    """SELECT fund_code, CAST(count(*) AS VARCHAR) AS days, CAST(max(nav_date) AS VARCHAR) AS last_day
       FROM nav GROUP BY 1""",
)
def k1(spark, sf):
    per_fund = b.nav(spark, sf).groupBy("fund_code").agg(
        F.count("*").alias("days"), F.max("nav_date").alias("last_day")
    )
    folder = new_folder(spark, "table")
    sinks.write_csv(per_fund, folder)
    return spark.read.schema("fund_code string, days string, last_day string").option("header", True).csv(folder)


@query(
    "k2_per_fund_sink",
    f"""SELECT layout, fund_code, CAST(nav_date AS VARCHAR) AS nav_date, {sql_r6('unit_nav')} AS unit_nav,
               'say "' || fund_code || '", twice' AS note
        FROM nav, (VALUES ('folders'), ('buckets')) AS l(layout)""",
)
def k2(spark, sf):
    """All columns, through both layouts; the note needs quotes."""
    note = F.concat(F.lit('say "'), "fund_code", F.lit('", twice')).alias("note")
    table = b.nav(spark, sf).select("fund_code", F.col("nav_date").cast("string").alias("nav_date"), "unit_nav", note)
    back = None
    for layout, write in (("folders", sinks.write_per_fund), ("buckets", sinks.write_bucketed)):
        folder = new_folder(spark, layout)
        write(table, folder)
        rows = files.read_per_fund_files(spark, folder, {n: n for n in ("nav_date", "unit_nav", "note")})
        rows = rows.withColumns({"layout": F.lit(layout), "unit_nav": r6(F.col("unit_nav").cast("double"))})
        back = rows if back is None else back.unionByName(rows)
    return back


@query(
    "k3_append_rejects",
    """SELECT stage, fund_code AS code, error, 2::BIGINT AS times FROM (
         SELECT 'adjusted_nav' AS stage, fund_code, 'empty nav data' AS error FROM blacklist)""",
)
def k3(spark, sf):
    rejects = b.blacklist(spark, sf).select(
        "fund_code", F.lit("adjusted_nav").alias("stage"), F.lit("empty nav data").alias("error")
    )
    folder = new_folder(spark, "rejects")
    sinks.append_failures(rejects, folder)
    sinks.append_failures(rejects, folder)
    back = files.read_log_tolerant(spark, folder)
    return back.groupBy("stage", "code", "error").agg(F.count("ts").alias("times"))


@query(
    "k3_run_keyed_rejects",
    """SELECT run, 'adjusted_nav' AS stage, fund_code AS code, 'empty nav data' AS error
       FROM blacklist, (VALUES ('r1'), ('r2')) AS r(run)""",
)
def k3_runs(spark, sf):
    """Two runs log their rejects, one of them twice: the repeated run replaces its own."""
    rejects = b.blacklist(spark, sf).select(
        "fund_code", F.lit("adjusted_nav").alias("stage"), F.lit("empty nav data").alias("error")
    )
    folder = new_folder(spark, "rejects")
    for run in ("r1", "r2", "r2"):
        sinks.write_failures(rejects, folder, run)
    return sinks.read_failures(spark, folder).select("run", "stage", "code", "error")


@query(
    "k4_log_to_table",
    """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, event_type AS stage,
              CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE '' END AS code,
              CASE WHEN user_id % 5 = 0 THEN props ELSE '' END AS extra
       FROM events""",
)
def k4(spark, sf):
    """Rows carry different keys: the code only sometimes, an extra key at times, never an error."""
    rows = b.read(spark, sf, "events").select(
        F.to_json(
            F.struct(
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
                F.col("event_type").alias("stage"),
                F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string")).alias("code"),
                F.when(F.col("user_id") % 5 == 0, F.col("props")).alias("extra"),
            )
        ).alias("value")
    )
    folder = new_folder(spark, "log")
    rows.write.text(folder)
    return sinks.flat_log(files.read_log_strict(spark, folder))


@query(
    "k5_versioned_overwrite",
    f"""SELECT data_version, as_of_date, fund_code, {sql_r6('annual_return')} AS annual_return
        FROM board_versions WHERE data_version <> 'v2' OR fund_code NOT IN (SELECT fund_code FROM blacklist)""",
)
def k5(spark, sf):
    """All versions are written twice, then one of them again with fewer rows."""
    board = b.board_versions(spark, sf).select("data_version", "as_of_date", "fund_code", "annual_return")
    folder = new_folder(spark, "board")
    sinks.write_versions(board, folder)
    sinks.write_versions(board, folder)
    smaller = board.where("data_version = 'v2'").join(b.blacklist(spark, sf), "fund_code", "left_anti")
    sinks.write_versions(smaller, folder)
    return rounded(sinks.read_versions(spark, folder), "annual_return")


def _facts(spark, sf):
    nav = b.month_nav(spark, sf).withColumn("as_of_date", F.lit("2001-12-31").cast("date"))
    board = b.board_versions(spark, sf).where("data_version = 'v3'").drop("data_version")
    period = nav.select(
        "fund_code", F.lit("M").alias("period_type"), F.col("nav_date").alias("period_end"), "as_of_date"
    )
    return {
        "nav_daily": nav,
        "return_period": period,
        "metrics_snapshot": board.select("fund_code", "annual_return", "as_of_date"),
        "scoreboard_snapshot": board,
    }


@query(
    "k6_write_scope",
    """SELECT 'full' AS scope, 'nav_daily' AS name, count(*) AS n FROM month_nav
       UNION ALL SELECT 'full', 'return_period', count(*) FROM month_nav
       UNION ALL SELECT 'full', 'metrics_snapshot', count(*) FROM board_versions WHERE data_version = 'v3'
       UNION ALL SELECT 'full', 'scoreboard_snapshot', count(*) FROM board_versions WHERE data_version = 'v3'
       UNION ALL SELECT 'verify_minimal', 'nav_daily', count(*) FROM month_nav
       UNION ALL SELECT 'verify_minimal', 'scoreboard_snapshot', count(*) FROM board_versions WHERE data_version = 'v3'""",
)
def k6(spark, sf):
    counts = None
    for scope in ("full", "verify_minimal"):
        root = new_folder(spark, f"facts-{scope}")
        for name in sinks.write_facts(_facts(spark, sf), root, "v3", scope):
            part = sinks.read_versions(spark, f"{root}/{name}").agg(F.count("*").alias("n")).select(
                F.lit(scope).alias("scope"), F.lit(name).alias("name"), "n"
            )
            counts = part if counts is None else counts.unionByName(part)
    return counts


@query(
    "k7_month_partitions",
    """SELECT 'v3' AS data_version, strftime(nav_date, '%Y-%m') AS nav_month, count(*) AS n
       FROM month_nav GROUP BY 2""",
)
def k7(spark, sf):
    root = new_folder(spark, "facts-months")
    sinks.write_facts(_facts(spark, sf), root, "v3", "verify_minimal")
    back = sinks.read_versions(spark, f"{root}/nav_daily")
    month = F.date_format(F.col("nav_month").cast("date"), "yyyy-MM")
    return back.groupBy("data_version", month.alias("nav_month")).agg(F.count("*").alias("n"))


@query(
    "k8_padded_unique_exclusions",
    """SELECT 'v1' AS data_version, DATE '2001-12-31' AS as_of_date, fund_code, title AS reason_code,
              min(report_id) AS reason_detail, CAST(NULL AS VARCHAR) AS note
       FROM personnel GROUP BY 3, 4""",
)
def k8(spark, sf):
    notices = normalise.personnel(b.raw_personnel(spark, sf))
    detail = normalise.tagged(
        notices.select("fund_code", F.col("title").alias("reason_code"), F.col("report_id").alias("reason_detail")),
        "v1",
        "2001-12-31",
    )
    unique = sinks.unique_exclusions(detail)
    return sinks.with_columns_of(
        unique, ["data_version", "as_of_date", "fund_code", "reason_code", "reason_detail", "note"]
    )
