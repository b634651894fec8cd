"""Scans of landed CSV and JSON-lines files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.functions import text
from navloom.session import written
from navloom.sources.schemas import CALENDAR, FAILURE_LOG

LINE_ORDER = "line_order"
CODE_FROM_PATH = r"([^/]+)\.csv$"
CODE_FROM_FOLDER = r"/fund_code=([^/]+)/"
# A CSV record (line breaks only inside quotes; an unclosed quote takes the rest) and a field behind its comma.
RECORD = r'(?:[^"\r\n]++|"(?:[^"]++|"")*+(?:"|$))++'
FIELD = r',("(?:[^"]++|"")*+"(?=,|$)|[^,"]*+(?=,|$))'
#: Files of a targeted scan that are named one by one; for more targets the folder is read and joined.
NAMED_FILES_MOST = 100_000
#: Layout of funds that share files: folders by hash, and an index from fund to file.
INDEX_FOLDER = "_funds"
BUCKET = "bucket"


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def strict_csv(spark: SparkSession) -> DataFrameReader:
    """A reader by header that fails on a row with other fields than the header's; no column is skipped unread."""
    options = {"header": True, "enforceSchema": False, "escape": '"', "mode": "FAILFAST", "columnPruning": False,
               "unescapedQuoteHandling": "RAISE_ERROR", "encoding": "UTF-8"}
    return spark.read.options(**options)


def read_table(
    spark: SparkSession,
    path: str | list[str],
    columns: dict[str, str],
    line_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """One landed CSV table as text columns under our names, taken by header.

    Order and further columns of the file do not matter, absent ones are left to the normalisers.
    Quotes inside quoted text are doubled. A row with another number of fields than the header is an
    error, never shifted or filled; so is a part whose header differs from the others'. Text with
    line breaks needs `multi_line`; a file is read in blocks all the same, see `csv_records`. With
    `line_order`, a sortable position in the file is added, so that keep-first means first in the file.
    """
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    raw, place = (_multi_line(spark, path), F.col(_PLACE)) if multi_line else (strict_csv(spark).csv(path), position)
    renamed = [F.col(f"`{header}`").alias(name) for header, name in columns.items() if header in raw.columns]
    if not renamed:
        raise ValueError(f"none of the headers {list(columns)} in {path}")
    return raw.select(*renamed, place.alias(LINE_ORDER)) if line_order else raw.select(*renamed)


_PLACE = "\ufffdplace"


def _multi_line(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Columns by header of a CSV table whose quoted text may hold line breaks, and each row's position."""
    records = csv_records(spark, path)
    heads = records.where("line = 1").select(F.regexp_replace("record", "^\ufeff", "").alias("head"), "file")
    head = heads.groupBy("head").agg(F.min("file").alias("file")).limit(2).collect()
    if not head:
        return spark.createDataFrame([], f"`{_PLACE}` struct<file: string, block: long, row: long>")
    if len(head) > 1:
        raise ValueError(f"headers differ: {head[0]['file']} and {head[1]['file']}")
    names = spark.range(1).select(F.transform(_fields(F.lit(head[0]["head"])), F.trim).alias("names")).first()["names"]
    wrong = F.concat(F.lit("line "), F.col("line"), F.lit(" has not the header's fields: "), F.col("file"))
    body = records.where("line > 1 and record <> ''").withColumn("fields", _fields(F.col("record")))
    sound = (F.size("fields") == len(names)) & _all_fields(F.col("record"))
    place = F.struct("file", F.lit(0).cast("long").alias("block"), F.col("line").alias("row"))
    checked = F.when(sound, F.col("fields")).otherwise(F.raise_error(wrong))
    # A quoted empty text is null as well, as Spark's own CSV scan reads it.
    columns = [F.nullif(F.col("fields")[i], F.lit("")).alias(name or f"_c{i}") for i, name in enumerate(names)]
    return body.select(checked.alias("fields"), place.alias(_PLACE)).select(*columns, _PLACE)


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of text files (value without line feed) with file, block and a number that grows in a block."""
    text_lines = spark.read.option("lineSep", "\n").text(paths)
    return text_lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )


def _blocks(lines: DataFrame, *more: Column) -> DataFrame:
    """Per block of a file its first id and the lines before it, with further aggregates of its lines.

    A stored table of one row per block: the files are read once for it, its size is known, and Spark
    broadcasts it only if that is small.
    """
    counted = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("id").alias("first"), *more)
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return written(counted.withColumn("before", F.coalesce(F.sum("lines").over(above), F.lit(0))), "blocks")


def _numbered(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """The lines with their numbers in the file, from 1; a block that was cut otherwise is an error."""
    at = lines.join(blocks.select("file", "block", "first", "before"), ["file", "block"], "left")
    number = F.col("before") + F.col("id") - F.col("first") + 1
    other = F.raise_error(F.lit("files changed while they were read")).cast("long")
    return at.withColumn("line", F.when(number.isNotNull(), number).otherwise(other))


def csv_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records of CSV files (file, line, record): lines, those joined that a quoted line break divides.

    Files are read in blocks. Only lines with an odd number of quotes open or close a text that goes on
    in another line; the parity of a block's odd lines, summed over the blocks before, tells which are
    which. From the pairs follow the line numbers of the divided records, and only these lines meet.
    """
    lines = _lines(spark, paths)
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1
    blocks = _blocks(lines, F.count_if(odd).alias("odd"))
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = blocks.select("file", "block", F.coalesce(F.sum("odd").over(above), F.lit(0)).alias("odd_before"))
    numbered = _numbered(lines, blocks).withColumn("value", F.regexp_replace("value", "\r$", ""))
    ends = numbered.where(odd).select("file", "block", "line").join(parity, ["file", "block"])
    place = F.row_number().over(Window.partitionBy("file", "block").orderBy("line")) + F.col("odd_before") - 1
    pairs = ends.select("file", "line", F.floor(place / 2).alias("pair")).groupBy("file", "pair").agg(
        F.min("line").alias("start"), F.max("line").alias("end"), F.count(F.lit(1)).alias("ends")
    )
    unclosed = F.raise_error(F.concat(F.lit("a quote is not closed, line "), F.col("start"), F.lit(": "), F.col("file")))
    last = F.when(F.col("ends") == 2, F.col("end")).otherwise(unclosed.cast("long"))
    inside = written(pairs.select("file", "start", F.explode(F.sequence("start", last)).alias("line")), "divided")
    # An outer join whose result names both sides: checks of a record must not be moved below it, onto parts.
    alone = F.col("start").isNull()
    whole = numbered.join(inside, ["file", "line"], "left").where(alone).select(
        "file", "line", F.when(alone, F.col("value")).alias("record")
    )
    raw = _numbered(lines, blocks).select("file", "line", "value").join(inside, ["file", "line"])
    joined = raw.groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("parts"))
    record = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["value"]), "\n"), "\r$", "")
    return whole.unionByName(joined.select("file", F.col("start").alias("line"), record.alias("record")))


def code_in(file: Column) -> Column:
    """The stem of {code}.csv, or the folder name where our own per-fund sink wrote fund_code={code}/."""
    folder = F.regexp_extract(file, CODE_FROM_FOLDER, 1)
    stem = F.regexp_extract(file, CODE_FROM_PATH, 1)
    return text.fund_code(F.when(folder != "", folder).otherwise(stem))


def _fields(record: Column) -> Column:
    """Fields of a CSV record: an empty one is null, a quoted one loses its quotes and doubled quotes.

    Only a record with a quote is matched by a pattern; any other is split at its commas.
    """
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(FIELD), F.lit(1))
    quoted = F.transform(
        found,
        lambda f: F.when(f == "", F.lit(None).cast("string"))
        .when(f.startswith('"'), F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')))
        .otherwise(f),
    )
    plain = F.transform(F.split(record, ","), lambda f: F.nullif(f, F.lit("")))
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(plain)


def read_per_fund_files(
    spark: SparkSession,
    path: str,
    columns: dict[str, str],
    required: Sequence[str] = (),
    line_order: bool = False,
    codes: DataFrame | None = None,
    code_limit: int | None = None,
) -> DataFrame:
    """A directory of per-fund files as one long table, columns taken by each file's own header.

    The code comes from the path, never inferred as a number. Such a file holds at most a row per
    day of one fund, so it is read whole: quoted line breaks are safe and files may differ in order
    and columns. An absent column is null, except for `required` names, which are an error. So is a
    row whose fields are not the header's, or that is not made of fields alone (text behind a closing
    quote, a quote that is never closed).

    With `codes` (fund_code), only those funds' files are opened; see `files_of`. A folder written by
    `write_bucketed` is read by its index, and its rows carry their codes themselves.
    """
    if exists(spark, f"{path}/{INDEX_FOLDER}"):
        return _read_bucketed(spark, path, columns, required, line_order, codes, code_limit)
    if codes is None:
        reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
        return _funds_in(reader.text(path, wholetext=True), columns, required, line_order)
    wanted = target_codes(codes, code_limit)
    found = files_of(named_files(spark, path), wanted)
    if found is None:
        return read_per_fund_files(spark, path, columns, required, line_order).join(wanted, "fund_code", "left_semi")
    return _funds_in(_texts(spark, found), columns, required, line_order)


def _texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Whole texts of the named files, which may be none."""
    if paths:
        return spark.read.text([_literal(p) for p in paths], wholetext=True)
    return spark.createDataFrame([], "value string, _metadata struct<file_path: string>")


def _literal(path: str) -> str:
    """A path in which no character is a pattern."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", path)


def _funds_in(whole: DataFrame, columns: dict[str, str], required: Sequence[str], line_order: bool) -> DataFrame:
    """Rows of whole per-fund files (value, _metadata)."""
    file = F.col("_metadata.file_path")
    content = F.regexp_replace("value", "^\ufeff", "")
    records = whole.select(
        file.alias("file"), F.regexp_extract_all(content, F.lit(RECORD), F.lit(0)).alias("records")
    ).where(F.size("records") > 0)
    header = F.transform(_fields(F.col("records")[0]), F.trim)
    rows = records.select(
        "file", header.alias("header"), F.posexplode(F.slice("records", F.lit(2), F.size("records") - 1)).alias("row", "record")
    ).withColumn("fields", _fields(F.col("record")))
    wrong = F.concat(F.lit("row "), F.col("row") + 1, F.lit(" has not the header's fields: "), F.col("file"))
    sound = (F.size("fields") == F.size("header")) & _all_fields(F.col("record"))
    checked = F.when(sound, F.col("fields")).otherwise(F.raise_error(wrong))

    def named(source: str, name: str) -> Column:
        place = F.array_position("header", source)
        absent = F.raise_error(F.concat(F.lit(f"no column {source} in "), F.col("file"))) if name in required else F.lit(None)
        return F.when(place > 0, F.get("fields", (place - 1).cast("int"))).otherwise(absent).cast("string").alias(name)

    order = [F.struct("file", "row").alias(LINE_ORDER)] if line_order else []
    return rows.withColumn("fields", checked).select(
        code_in(F.col("file")).alias("fund_code"),
        *[named(source, name) for source, name in columns.items() if name != "fund_code"],
        *order,
    )


def _all_fields(record: Column) -> Column:
    """Whether the matched fields, joined, give the record back in full."""
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(FIELD), F.lit(0))
    return ~F.contains(record, F.lit('"')) | (F.array_join(found, "") == F.concat(F.lit(","), record))


def _read_bucketed(
    spark: SparkSession,
    path: str,
    columns: dict[str, str],
    required: Sequence[str],
    line_order: bool,
    codes: DataFrame | None,
    code_limit: int | None,
) -> DataFrame:
    """Rows of a folder in which funds share files; only files that hold a target fund are opened."""
    stored = spark.read.parquet(f"{path}/{INDEX_FOLDER}")
    paths = [] if stored.isEmpty() else [f"{path}/{BUCKET}=*"]
    wanted = None if codes is None else target_codes(codes, code_limit)
    if wanted is not None:
        found = files_of(stored, wanted)
        paths = paths if found is None else [f"{path}/{file}" for file in found]
    if not paths:
        table = spark.createDataFrame([], ", ".join(f"{name} string" for name in ("fund_code", *columns.values())))
        return table.select("fund_code", *[n for n in columns.values() if n != "fund_code"])
    names = {"fund_code": "fund_code", **{source: name for source, name in columns.items() if name != "fund_code"}}
    table = read_table(spark, paths, names, line_order, multi_line=True)
    absent = [name for name in names.values() if name not in table.columns]
    if set(absent) & set(required):
        raise ValueError(f"no column {sorted(set(absent) & set(required))} in {path}")
    order = [LINE_ORDER] if line_order else []
    rows = table.select(
        *[F.lit(None).cast("string").alias(n) if n in absent else F.col(n) for n in names.values()], *order
    )
    return rows if wanted is None else rows.join(wanted, "fund_code", "left_semi")


def named_files(spark: SparkSession, path: str) -> DataFrame:
    """fund_code and file of every per-fund file (names only, no content is read)."""
    names = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("path").alias("file"))
    )
    return names.select(code_in(F.col("file")).alias("fund_code"), "file")


def files_of(named: DataFrame, codes: DataFrame, most: int = NAMED_FILES_MOST) -> list[str] | None:
    """Files of the target codes, or None if there are more than `most`.

    Only names of files to open come to the driver, which needs them to plan the scan. A code without a
    file is not an error. Beyond the bound a caller reads the folder and joins.
    """
    found = named.join(codes.select("fund_code").distinct(), "fund_code", "left_semi").select("file").distinct()
    rows = found.limit(most + 1).collect()
    return None if len(rows) > most else sorted(row["file"] for row in rows)


def target_codes(codes: DataFrame, code_limit: int | None = None) -> DataFrame:
    """Distinct codes, with a limit the first ones by name."""
    wanted = codes.select("fund_code").distinct()
    return wanted if code_limit is None else wanted.orderBy("fund_code").limit(code_limit)


def codes_with_file(spark: SparkSession, path: str) -> DataFrame:
    """Codes that have a file, also an empty one (names only, no content is read)."""
    if exists(spark, f"{path}/{INDEX_FOLDER}"):
        return spark.read.parquet(f"{path}/{INDEX_FOLDER}").select("fund_code").distinct()
    return named_files(spark, path).select("fund_code").distinct()


def only_codes(table: DataFrame, codes: DataFrame, code_limit: int | None = None) -> DataFrame:
    """Rows of the target codes; a target without rows is not an error.

    For a table in memory or Parquet; a scan of landed files takes `codes` itself and opens theirs only.
    """
    return table.join(target_codes(codes, code_limit), "fund_code", "left_semi")


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return trade_days(read_table(spark, path, CALENDAR))


def trade_days(raw: DataFrame) -> DataFrame:
    """Parsed, non-null, distinct trade days. At most one row per calendar day."""
    return (
        raw.select(text.to_date(F.col("trade_date")).alias("trade_date"))
        .dropna()
        .distinct()
    )


def trade_days_between(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Parsed trade days in [start, end]; repeated days are kept."""
    if start > end:
        raise ValueError(f"start must not be after end: {start} > {end}")
    days = raw.select(text.to_date(F.col("trade_date")).alias("trade_date"))
    return days.where(F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def read_log_tolerant(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Failure log rows; blank and malformed lines are skipped."""
    return spark.read.schema(FAILURE_LOG).option("mode", "DROPMALFORMED").json(paths)


def read_log_strict(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Failure log rows as a map of text values; a malformed or non-object line is an error with file and line.

    A map keeps keys that no schema foresees and tells an absent key from a null one. Lines are checked
    here, in blocks: each tells its first bad line, and only then are the lines before it counted.
    """
    lines = _lines(spark, paths)
    record = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    bad = F.when((F.trim(F.regexp_replace("value", "\r$", "")) != "") & record.isNull(), F.struct("id", "value"))
    blocks = _blocks(lines, F.min(bad).alias("bad"))
    number = F.col("before") + F.col("bad.id") - F.col("first") + 1
    found = blocks.where("bad is not null").select("file", number.alias("line"), "bad.value").orderBy("file", "line").first()
    if found:
        raise ValueError(f"invalid JSON object in {found['file']}, line {found['line']}: {found['value']}")
    return lines.where(F.trim(F.regexp_replace("value", "\r$", "")) != "").select(record.alias("record"))


def read_blacklist(spark: SparkSession, path: str | None) -> DataFrame:
    """Codes of a blacklist file: its code column, else its first column; blanks are ignored.

    A row with another number of fields than the header, or text behind a closing quote, is an error:
    a listed fund must not slip through because of it. A folder of parts may hold empty ones.
    """
    if path is None:
        return spark.createDataFrame([], "fund_code string")
    raw = strict_csv(spark).csv(path)
    return blacklist_codes(raw)


def blacklist_codes(raw: DataFrame) -> DataFrame:
    if not raw.columns:
        return raw.sparkSession.createDataFrame([], "fund_code string")
    named = [c for c in raw.columns if c in ("基金代码", "fund_code")]
    column = F.col(f"`{named[0] if named else raw.columns[0]}`")
    return (
        raw.where(text.stripped(column) != "").select(text.fund_code(column).alias("fund_code")).distinct()
    )
