import json
import os
import random

import pytest
from pyspark.sql import functions as F

from navloom.operators import normalise
from navloom.plans import runs
from navloom.session import new_folder, shared_folder, written
from navloom.sinks import commits
from navloom.sinks import tables as sinks
from navloom.sources import files, schemas
from tests.helpers import by_key, day, days_from


def write(path, text, bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)
    return str(path)


def csv(columns, rows):
    lines = [",".join(columns)] + [",".join("" if v is None else str(v) for v in row) for row in rows]
    return "\n".join(lines) + "\n"


def test_table_scan_keeps_zeros_tolerates_bom_and_rejects_other_headers(spark, tmp_path):
    rows = [("000001", "a", "开放申购", "开放赎回", "", "10", "100", "0.15%")]
    path = write(tmp_path / "p" / "purchase.csv", csv(schemas.PURCHASE, rows), bom=True)
    assert normalise.purchase(files.read_table(spark, path, schemas.PURCHASE)).collect()[0].fund_code == "000001"
    swapped = write(tmp_path / "q" / "calendar.csv", "day\n2024-01-01\n")
    with pytest.raises(Exception):
        files.read_table(spark, swapped, schemas.CALENDAR).collect()


def test_quotes_order_and_absent_columns(spark, tmp_path):
    path = write(
        tmp_path / "o.csv",
        '净资产规模,extra,基金简称,基金代码\n1亿,"x, ""y""\nz","said ""a"", b",7\n',
    )
    row = normalise.overview(files.read_table(spark, path, schemas.OVERVIEW_LANDED, multi_line=True)).collect()[0]
    assert (row.fund_code, row.short_name, row.asset_scale, row.full_name) == ("000007", 'said "a", b', "1亿", "")
    ragged = write(tmp_path / "r.csv", "trade_date,note\n2024-01-01,a,b\n")
    with pytest.raises(Exception):
        files.read_table(spark, ragged, schemas.CALENDAR).collect()
    short = write(tmp_path / "s.csv", "note,trade_date\n2024-01-01\n")
    with pytest.raises(Exception):
        files.read_table(spark, short, schemas.CALENDAR).collect()


def test_per_fund_files_differ_in_columns(spark, tmp_path):
    folder = tmp_path / "personnel"
    write(folder / "1.csv", '公告日期,公告标题,报告ID\n2024-01-02,"t ""q"", x\nsecond line",R1\n,"",\n', bom=True)
    write(folder / "2.csv", "报告ID,more,基金名称\r\nR2,z,n\r\n")
    write(folder / "3.csv", "")
    rows = files.read_per_fund_files(spark, str(folder), schemas.PERSONNEL, line_order=True)
    got = [tuple(r)[:5] for r in rows.orderBy("fund_code", files.LINE_ORDER).collect()]
    assert got == [
        ("000001", 't "q", x\nsecond line', None, "2024-01-02", "R1"),
        ("000001", "", None, None, None),
        ("000002", None, "n", None, "R2"),
    ]
    with pytest.raises(Exception, match="no column"):
        files.read_per_fund_files(spark, str(folder), schemas.PERSONNEL, required=["notice_date"]).collect()
    write(tmp_path / "bad" / "1.csv", "公告日期,公告标题\n2024-01-02,a,b\n")
    with pytest.raises(Exception, match="header's fields"):
        files.read_per_fund_files(spark, str(tmp_path / "bad"), schemas.PERSONNEL).collect()


def test_written_text_reads_back_and_codes_of_own_layout(spark, tmp_path):
    table = spark.createDataFrame([("000001", 'a "b", c'), ("000002", "plain")], "fund_code string, title string")
    sinks.write_csv(table, str(tmp_path / "t"))
    names = {"fund_code": "fund_code", "title": "title"}
    assert sorted(files.read_table(spark, str(tmp_path / "t"), names).collect()) == sorted(table.collect())
    sinks.write_per_fund(table, str(tmp_path / "p"))
    assert sorted(files.read_per_fund_files(spark, str(tmp_path / "p"), names).collect()) == sorted(table.collect())
    assert {r.fund_code for r in files.codes_with_file(spark, str(tmp_path / "p")).collect()} == {"000001", "000002"}


def test_logs_with_many_keys(spark):
    wide = spark.createDataFrame([({f"k{i}": "v" for i in range(3000)},), ({"code": "1"},)], "record map<string,string>")
    assert len(sinks.log_columns(wide)) == 3001
    assert sinks.flat_log(wide, ["code", "k7"]).collect() == [("", "v"), ("1", "")]
    assert sinks.long_log(wide).count() == 3001


def test_keep_first_follows_file_order(spark, tmp_path):
    rows = [("1", name) + (None,) * 16 for name in ("zeta", "alpha", "beta")]
    path = write(tmp_path / "overview.csv", csv(schemas.OVERVIEW, rows))
    raw = files.read_table(spark, path, schemas.OVERVIEW, line_order=True)
    row = normalise.overview(raw, [F.col(files.LINE_ORDER)]).collect()[0]
    assert (row.short_name, row.full_name) == ("zeta", "")


def test_per_fund_files(spark, tmp_path):
    for code in ("000001", "000012"):
        write(tmp_path / "nav" / f"{code}.csv", csv(schemas.NAV, [(code, "2024-01-02", "1.5", "x"), (code, "bad", "1", "")]))
    write(tmp_path / "nav" / "000013.csv", csv(schemas.NAV, []))
    table = normalise.nav(files.read_per_fund_files(spark, str(tmp_path / "nav"), schemas.NAV))
    assert {(r.fund_code, r.nav_date, r.unit_nav, r.daily_growth) for r in table.collect()} == {
        ("000001", day("2024-01-02"), 1.5, None), ("000012", day("2024-01-02"), 1.5, None),
    }
    codes = files.codes_with_file(spark, str(tmp_path / "nav"))
    assert {r.fund_code for r in codes.collect()} == {"000001", "000012", "000013"}


def test_logs(spark, tmp_path):
    lines = [{"ts": "t", "stage": "nav", "code": "1", "error": "e"}, {"stage": "nav", "code": "2", "extra": 5}]
    good = write(tmp_path / "good.jsonl", "\n".join(json.dumps(x) for x in lines) + "\n\n")
    flat = sinks.flat_log(files.read_log_strict(spark, good))
    assert flat.columns == ["ts", "stage", "code", "error", "extra"]
    rows = by_key(flat, "code")
    assert rows["1"]["extra"] == "" and rows["2"]["extra"] == "5" and rows["2"]["ts"] == ""
    bad = write(tmp_path / "bad.jsonl", '{"code": "1", "stage": "s"}\n[1]\nnope\n')
    with pytest.raises(Exception, match="invalid JSON object"):
        files.read_log_strict(spark, bad).collect()
    assert [r.code for r in files.read_log_tolerant(spark, bad).collect() if r.code] == ["1"]


def test_blacklist_variants(spark, tmp_path):
    named = write(tmp_path / "a.csv", "备注,基金代码\nx,1\ny, \n")
    first = write(tmp_path / "b.csv", "code,remark\n2,x\n2,y\n")
    assert [r.fund_code for r in files.read_blacklist(spark, named).collect()] == ["000001"]
    assert [r.fund_code for r in files.read_blacklist(spark, first).collect()] == ["000002"]
    assert files.read_blacklist(spark, None).count() == 0


def test_versioned_write_replaces_only_its_version(spark):
    folder = new_folder(spark, "versions")
    rows = [("v1", day("2024-01-05"), 1), ("v1", day("2024-02-05"), 2), ("v2", day("2024-01-05"), 3)]
    table = sinks.by_month(spark.createDataFrame(rows, "data_version string, d date, x int"), "d", "m")
    for version in ("v1", "v2"):
        sinks.write_version(table.where(F.col("data_version") == version), folder, version, ("m",))
    sinks.write_version(table.where("x = 1"), folder, "v1", ("m",))
    sinks.write_version(table.where("x = 1"), folder, "v1", ("m",))
    assert {(r.data_version, r.x) for r in sinks.read_versions(spark, folder).collect()} == {("v1", 1), ("v2", 3)}


def test_readers_see_whole_versions_during_and_after_a_failed_rewrite(spark):
    folder = new_folder(spark, "versions")
    rows = spark.createDataFrame([("007", day("2024-01-05"), i) for i in range(9)], "data_version string, d date, x int")
    rows = sinks.by_month(rows, "d", "m")
    sinks.write_version(rows, folder, "007", ("m",))
    reader = sinks.read_versions(spark, folder)
    broken = rows.withColumn("x", F.when(F.col("x") == 8, F.raise_error(F.lit("disk full")).cast("int")).otherwise(F.col("x")))
    for write in (lambda: sinks.write_version(broken, folder, "007", ("m",)), lambda: sinks.write_versions(broken, folder)):
        with pytest.raises(Exception, match="disk full"):
            write()
        assert sinks.read_versions(spark, folder).count() == 9
    sinks.write_version(rows.where("x < 2"), folder, "007", ("m",))
    # Who read before the rewrite still can; a new reader sees the new rows, the name is still text.
    assert reader.count() == 9
    assert {(r.data_version, r.m, r.x) for r in sinks.read_versions(spark, folder).collect()} == {("007", "2024-01", 0), ("007", "2024-01", 1)}
    for x in (3, 4):
        sinks.write_version(rows.where(f"x = {x}"), folder, "007", ("m",))
    assert len(commits.history(spark, folder, "007")) == commits.KEPT
    sinks.write_version(rows.where("false"), folder, "007", ("m",))
    assert sinks.read_versions(spark, folder).collect() == []
    with pytest.raises(ValueError, match="no version"):
        sinks.read_versions(spark, new_folder(spark, "nothing"))


def test_stages_are_taken_up_by_their_inputs(spark):
    root = new_folder(spark, "stage")

    def run(a, b, fail=(), resume=True):
        def stage(name, compute):
            def checked(tables):
                if name in fail:
                    raise RuntimeError(name)
                return compute(tables)

            return checked

        stages = {
            "a": sinks.Stage(stage("a", lambda _: a), (sinks.fingerprint(a),)),
            "b": sinks.Stage(stage("b", lambda _: b), (sinks.fingerprint(b),)),
            "c": sinks.Stage(stage("c", lambda t: t["a"].join(t["b"], "id")), ("x",), ("a", "b")),
            "d": sinks.Stage(stage("d", lambda t: t["b"].agg(F.count("*").alias("n"))), after=("b",)),
        }
        done = sinks.resume_or_compute(spark, root, "v1", stages, resume)
        return done.computed, done.tables["c"].count(), done.tables["d"].first().n

    three, five = spark.range(3), spark.range(5)
    assert run(three, five) == (["a", "b", "c", "d"], 3, 5)
    assert run(three, spark.range(0, 5, 1, 7)) == ([], 3, 5)
    assert run(spark.range(4), five) == (["a", "c"], 4, 5)
    with pytest.raises(RuntimeError):
        run(three, spark.range(2), fail=("c",))
    assert run(three, spark.range(2)) == (["c", "d"], 2, 2)
    assert run(three, spark.range(2), resume=False) == (["a", "b", "c", "d"], 2, 2)


def test_fingerprints_tell_content_not_order(spark):
    rows = [("a", 1.0), ("a", 1.0), ("b", None)]
    table = spark.createDataFrame(rows, "x string, y double")
    same = spark.createDataFrame(rows[::-1], "x string, y double").repartition(3)
    assert sinks.fingerprint(table) == sinks.fingerprint(same.select("y", "x"))
    others = [table.distinct(), table.where("y > 0"), table.withColumnRenamed("x", "z"), table.withColumn("y", F.col("y") + 1)]
    assert len({sinks.fingerprint(t) for t in (table, *others)}) == 5


def test_working_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert written(spark.range(5), "t").count() == 5


@pytest.fixture
def landing(tmp_path):
    """Four funds: 1 good, 2 blacklisted, 3 with a dividend off its NAV days, 4 without overview."""
    start, count = "2018-01-05", 330
    dates = [str(d) for d in days_from(start, count, 7)]
    base = tmp_path / "land"
    codes = ["000001", "000002", "000003", "000004"]
    write(base / "purchase.csv", csv(schemas.PURCHASE, [(c, f"n{c}", "开放申购", "开放赎回", None, 10, 1000, 0.15) for c in codes]))
    overview = [(c, f"o{c}", "full", "type", None, "2010年1月2日", "3.5亿元") + (None,) * 5 + ("1%", "0.2%", None, "1.2%", None, None) for c in codes[:3]]
    write(base / "overview.csv", csv(schemas.OVERVIEW, overview))
    for i, c in enumerate(codes):
        navs = [round(1 + 0.002 * k * (i + 1) - (0.05 if k % 9 == 4 else 0), 4) for k in range(count)]
        write(base / "nav" / f"{c}.csv", csv(schemas.NAV, [(c, d, v, "") for d, v in zip(dates, navs)]))
        off = "2023-01-01" if c == "000003" else dates[10]
        write(base / "bonus" / f"{c}.csv", csv(schemas.BONUS, [(c, "2018", off, off, "每份派现金0.1元", off)]))
        write(base / "split" / f"{c}.csv", csv(schemas.SPLIT, []))
        write(base / "personnel" / f"{c}.csv", csv(schemas.PERSONNEL, [(c, "t", "n", "2020-01-01", "r")]))
        factors = [1.0 if k < 10 else (navs[10] + 0.1) / navs[10] for k in range(count)]
        percent = [(v * f / navs[0] - 1) * 100 for v, f in zip(navs, factors)]
        write(base / "cum" / f"{c}.csv", csv(schemas.CUM_RETURN, [(c, d, repr(p)) for d, p in zip(dates, percent)]))
    write(base / "calendar.csv", csv(schemas.CALENDAR, [(d,) for d in dates]))
    write(base / "blacklist.csv", "基金代码\n2\n")
    return runs.Landing(
        **{n: str(base / f"{n}.csv") for n in ("purchase", "overview", "calendar", "blacklist")},
        **{n: str(base / n) for n in ("nav", "bonus", "split", "personnel")},
        cum_return=str(base / "cum"),
    ), dates[-1]


def test_full_run_from_landed_files(spark, landing, tmp_path):
    paths, last = landing
    settings = runs.Settings("v1", start="2018-01-01", end=last, metrics_only=False)
    result = runs.full_run(spark, paths, str(tmp_path / "root"), settings)
    rejects = by_key(result["adjusted_nav_rejects"], "fund_code")
    assert rejects["000003"]["error"] == "missing nav data on dividend dates: 2023-01-01"
    reasons = by_key(result["candidates"], "fund_code")
    assert not reasons["000001"]["is_filtered"] and set(reasons) == {"000001", "000003", "000004"}
    assert "规则3" in reasons["000003"]["reasons"] and "规则1" in reasons["000004"]["reasons"]
    assert [r.fund_code for r in result["scoreboard"].collect()] == ["000001"]
    root = str(tmp_path / "root")
    counts = {n: sinks.read_versions(spark, f"{root}/{n}").count() for n in sinks.FACTS}
    assert counts["scoreboard_snapshot"] == 1 and counts["nav_daily"] == 330 and counts["return_period"] > 300
    report = {r.measure: r.n for r in result["run_report"].collect()}
    assert (report["original"], report["blacklist_removed"], report["after_filter"]) == (4, 1, 1)
    assert report["failures in adjusted_nav"] == 1 and result["load_report"].collect()[0].total_codes == 3
    shown = spark.read.option("header", True).csv(f"{root}/export/data_version=v1/exclusion_detail")
    assert shown.count() == result["exclusion_detail"].count()
    logged = sorted((r.stage, r.code, r.error) for r in result["failures"].collect())
    again = runs.full_run(spark, paths, root, settings)
    # A repeated run leaves one set of failures, not two.
    assert sorted((r.stage, r.code, r.error) for r in sinks.read_failures(spark, f"{root}/failures").collect()) == logged
    assert {r["run"] for r in again["failures"].collect()} == {"v1"}
    assert {n: sinks.read_versions(spark, f"{root}/{n}").count() for n in sinks.FACTS} == counts
    quick = runs.scoreboard_run(
        again["purchase_filtered"],
        files.read_table(spark, paths.overview, schemas.OVERVIEW),
        normalise.personnel(files.read_per_fund_files(spark, paths.personnel, schemas.PERSONNEL)),
        again["adjusted_nav"],
        str(tmp_path / "quick"),
        runs.Settings("v1", metrics_only=True),
    )
    assert quick["scoreboard"].collect() == again["scoreboard"].collect() and "nav_daily" not in quick


def test_scan_of_target_funds_opens_their_files_only(spark, tmp_path):
    for i in range(40):
        write(tmp_path / "nav" / f"{i}.csv", csv(schemas.NAV, [(i, "2024-01-02", i + 0.5, "")]))
    write(tmp_path / "nav" / "000041.csv", "not,a table\nbroken\n")
    codes = spark.createDataFrame([("000007",), ("000012",), ("999999",)], "fund_code string")
    rows = files.read_per_fund_files(spark, str(tmp_path / "nav"), schemas.NAV, codes=codes)
    assert sorted(f.rsplit("/", 1)[1] for f in rows.inputFiles()) == ["12.csv", "7.csv"]
    assert {(r.fund_code, r.unit_nav) for r in rows.collect()} == {("000007", "7.5"), ("000012", "12.5")}
    limited = files.read_per_fund_files(spark, str(tmp_path / "nav"), schemas.NAV, codes=codes, code_limit=1)
    assert [r.fund_code for r in limited.collect()] == ["000007"]
    nobody = files.read_per_fund_files(spark, str(tmp_path / "nav"), schemas.NAV, line_order=True, codes=codes.where("fund_code > '9'"))
    assert nobody.collect() == [] and nobody.columns[-1] == files.LINE_ORDER
    assert files.files_of(files.named_files(spark, str(tmp_path / "nav")), codes, most=1) is None


def test_more_targets_than_named_files_are_joined(spark, tmp_path, monkeypatch):
    for i in range(4):
        write(tmp_path / "nav" / f"{i}.csv", csv(schemas.NAV, [(i, "2024-01-02", i, "")]))
    monkeypatch.setattr(files.files_of, "__defaults__", (1,))
    codes = spark.createDataFrame([("000001",), ("000003",)], "fund_code string")
    rows = files.read_per_fund_files(spark, str(tmp_path / "nav"), schemas.NAV, codes=codes)
    assert len(rows.inputFiles()) == 4 and {r.fund_code for r in rows.collect()} == {"000001", "000003"}


def test_bucketed_layout_has_few_folders_and_an_index(spark, tmp_path):
    rows = [(f"{i:06d}", f"day {d}", 'a "q", \n b' if d else None) for i in range(300) for d in range(2)]
    table = spark.createDataFrame(rows, "fund_code string, nav_date string, note string")
    folder = str(tmp_path / "b")
    sinks.write_bucketed(table, folder, buckets=8)
    assert len([n for n in os.listdir(folder) if n.startswith("bucket=")]) == 8
    columns = {"nav_date": "nav_date", "note": "note", "absent": "absent"}
    back = files.read_per_fund_files(spark, folder, columns, line_order=True)
    assert sorted(tuple(r)[:3] for r in back.collect()) == sorted(rows) and back.columns[3:] == ["absent", files.LINE_ORDER]
    codes = spark.createDataFrame([("000005",), ("555555",)], "fund_code string")
    some = files.read_per_fund_files(spark, folder, columns, codes=codes)
    assert sum(f.endswith(".csv") for f in some.inputFiles()) == 1 and {r.fund_code for r in some.collect()} == {"000005"}
    assert files.codes_with_file(spark, folder).count() == 300
    with pytest.raises(ValueError, match="no column"):
        files.read_per_fund_files(spark, folder, columns, required=["absent"])
    sinks.write_bucketed(table.where("false"), folder)
    assert files.read_per_fund_files(spark, folder, columns).collect() == []


def test_rows_that_are_not_fields_alone_are_errors(spark, tmp_path):
    columns = {"a": "a", "b": "b"}
    for i, text in enumerate(['a,b\n1.0,"0\n2,x\n3,y"5\n', 'a,b\n1.0,"0\n', 'a,b\n1,x"y"\n', 'a,b\n"1"2,3\n']):
        write(tmp_path / str(i) / "1.csv", text)
        with pytest.raises(Exception, match="header's fields"):
            files.read_per_fund_files(spark, str(tmp_path / str(i)), columns).collect()


def test_broken_blacklists_are_errors(spark, tmp_path):
    for i, text in enumerate(["备注,基金代码\nx,y,000002\n", "备注,基金代码\nx,1\n000003\n", '备注,基金代码\nx,"00000"2\n']):
        path = write(tmp_path / f"{i}.csv", text)
        with pytest.raises(Exception):
            files.read_blacklist(spark, path).collect()


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "1000")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def test_tables_with_line_breaks_are_read_in_blocks(spark, tmp_path, small_blocks):
    rng = random.Random(4)
    pieces = ["plain", "", "two\nlines", 'say ""x""', "a,b", "\n\n", '""', "tail\n"]
    def cell():
        text = rng.choice(pieces)
        return f'"{text}"' if any(c in text for c in '",\n') or rng.random() < 0.2 else text
    for name, count, end in (("a.csv", 800, "\n"), ("b.csv", 300, "\r\n")):
        rows = [f"{i},{cell()},{cell()}{end}" for i in range(count)]
        write(tmp_path / "t" / name, f"n,x,y{end}" + "".join(rows), bom=name == "a.csv")
    columns = {"y": "y", "x": "x", "n": "n"}
    path = str(tmp_path / "t")
    got = files.read_table(spark, path, columns, line_order=True, multi_line=True)
    one_task = files.strict_csv(spark).option("multiLine", True).csv(path).select("y", "x", "n")
    assert files._lines(spark, path).rdd.getNumPartitions() > 10
    key = lambda r: tuple(str(v) for v in r[:3])
    assert sorted((tuple(r)[:3] for r in got.collect()), key=key) == sorted(map(tuple, one_task.collect()), key=key)
    first = [int(r.n) for r in got.where("line_order.file like '%a.csv'").orderBy(files.LINE_ORDER).collect()]
    assert first == list(range(800))


def test_broken_tables_with_line_breaks_are_errors(spark, tmp_path):
    for i, text in enumerate(['n,x\n1,"a\n', 'n,x\n1\n', 'n,x\n1,"a"b\n', 'n,x\n1,"a\nb",c\n']):
        path = write(tmp_path / f"{i}.csv", text)
        with pytest.raises(Exception):
            files.read_table(spark, path, {"n": "n", "x": "x"}, multi_line=True).collect()
    write(tmp_path / "two" / "1.csv", "n,x\n1,2\n")
    write(tmp_path / "two" / "2.csv", "x,n\n1,2\n")
    with pytest.raises(ValueError, match="headers differ"):
        files.read_table(spark, str(tmp_path / "two"), {"n": "n"}, multi_line=True)
    empty = write(tmp_path / "empty.csv", "n,x\n")
    assert files.read_table(spark, empty, {"n": "n", "x": "x"}, multi_line=True).collect() == []


def test_bad_log_line_is_named_by_file_and_line(spark, tmp_path, small_blocks):
    good = [json.dumps({"code": str(i), "error": "e" * 60}) if i % 7 else "" for i in range(500)]
    write(tmp_path / "logs" / "a.jsonl", "\n".join(good) + "\n")
    write(tmp_path / "logs" / "b.jsonl", "\r\n".join([*good[:333], "[1]", *good[:50], "nope"]) + "\r\n")
    assert files._lines(spark, str(tmp_path / "logs")).rdd.getNumPartitions() > 10
    with pytest.raises(ValueError, match=r"b\.jsonl, line 334: \[1\]"):
        files.read_log_strict(spark, str(tmp_path / "logs"))
    assert files.read_log_strict(spark, str(tmp_path / "logs" / "a.jsonl")).count() == sum(map(bool, good))


def test_failed_contract_leaves_the_table_before(spark, landing, tmp_path):
    paths, last = landing
    root, settings = str(tmp_path / "root"), runs.Settings("v1", start="2018-01-01", end=last)
    runs.full_run(spark, paths, root, settings)
    with open(paths.purchase, "a", encoding="utf-8") as f:
        f.write("000001,again,开放申购,开放赎回,,10,1000,0.15\n,x,开放申购,开放赎回,,ten,1000,0.15\n")
    with pytest.raises(ValueError) as error:
        runs.full_run(spark, paths, root, settings)
    assert "numeric violated: purchase [purchase_min_amount] rows=1" in str(error.value)
    assert "unique_key violated: purchase [fund_code] rows=2" in str(error.value)
    assert len(commits.history(spark, f"{root}/run", "purchase_landed@v1")) == 1


def test_failure_logs_are_kept_by_run(spark):
    path = new_folder(spark, "failures")
    assert sinks.read_failures(spark, path).collect() == []
    table = spark.createDataFrame([("000001", "nav", "x"), ("000002", "nav", "y")], "fund_code string, stage string, error string")
    for run, rows in (("a b/1", table), ("r2", table), ("r2", table.limit(1)), ("r3", table.where("false"))):
        sinks.write_failures(rows, path, run)
    got = sorted((r.run, r.code) for r in sinks.read_failures(spark, path).collect())
    assert got == [("a b/1", "000001"), ("a b/1", "000002"), ("r2", "000001")]
    assert {r.run for r in sinks.read_failures(spark, path, ["r2", "none"]).collect()} == {"r2"}


def test_plain_and_quoted_records_have_the_same_fields(spark):
    records = ["a,b,c", ",,", "", "a,,", 'a,"b, ""c""",d', '"",x,y', " a , b,c ", "a,b\rc,d"]
    found = spark.createDataFrame([(r,) for r in records], "record string").select(files._fields(F.col("record")).alias("f"))
    expected = [["a", "b", "c"], [None] * 3, [None], ["a", None, None], ["a", 'b, "c"', "d"], ["", "x", "y"], [" a ", " b", "c "], ["a", "b\rc", "d"]]
    assert [r.f for r in found.collect()] == expected


def test_rows_of_a_shared_file_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,z\n1,2,3\n")
    table = files.read_table(spark, str(tmp_path), {c: c for c in "xyz"}, multi_line=True).where("x is not null")
    assert [tuple(r) for r in table.collect()] == [("1", "2", "3")]
    assert "from_csv" not in table._jdf.queryExecution().optimizedPlan().toString()
