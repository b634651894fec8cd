"""Writers: single tables, per-fund layout, rejects and versioned facts."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.sinks import commits
from navloom.sources import files

LOG_COLUMNS = ("ts", "stage", "code", "error")

# Fact tables of a version, and the ones the reduced scope writes.
FACTS = ("nav_daily", "return_period", "metrics_snapshot", "scoreboard_snapshot")
SCOPES = {"full": FACTS, "verify_minimal": ("nav_daily", "scoreboard_snapshot")}


def write_csv(table: DataFrame, path: str) -> None:
    """One result table as a CSV directory with header."""
    table.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_per_fund(table: DataFrame, path: str) -> None:
    """Detail rows in one folder per fund.

    Rebalancing by fund gives each fund few files and lets AQE split a fund with many rows.
    """
    spread = table.hint("rebalance", "fund_code")
    spread.write.mode("overwrite").partitionBy("fund_code").option("header", True).option("escape", '"').csv(path)


def write_bucketed(table: DataFrame, path: str, buckets: int = 256) -> None:
    """Detail rows in a fixed number of folders by hash of the fund, and an index from fund to file.

    For many funds: 100,000 of them are not 100,000 folders. AQE splits a bucket with many rows over
    files; the index, written last, names the files each fund lies in, so a scan of some funds opens
    those only. `read_per_fund_files` reads this layout too.
    """
    bucket = F.pmod(F.xxhash64("fund_code"), F.lit(buckets)).alias(files.BUCKET)
    spread = table.select("*", bucket).hint("rebalance", files.BUCKET).sortWithinPartitions(files.BUCKET, "fund_code")
    spread.write.mode("overwrite").partitionBy(files.BUCKET).option("header", True).option("escape", '"').csv(path)
    place = F.regexp_extract("_metadata.file_path", rf"({files.BUCKET}=[^/]+/[^/]+)$", 1)
    spark = table.sparkSession
    if spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").isEmpty():
        index = spark.createDataFrame([], "fund_code string, file string")
    else:
        rows = files.strict_csv(spark).option("multiLine", True).csv(f"{path}/{files.BUCKET}=*")
        index = rows.select("fund_code", place.alias("file")).distinct()
    index.write.mode("overwrite").parquet(f"{path}/{files.INDEX_FOLDER}")


def append_failures(rejects: DataFrame, path: str) -> None:
    """Rejected funds (fund_code, stage, error) appended to a JSON-lines log."""
    rejects.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        "stage",
        F.col("fund_code").alias("code"),
        "error",
    ).write.mode("append").json(path)


def log_columns(records: DataFrame) -> list[str]:
    """Keys of a log: the usual ones that occur, then the others sorted.

    Column names have to be known to build a table; `long_log` needs no list of keys.
    """
    present = {row.key for row in records.select(F.explode(F.map_keys("record")).alias("key")).distinct().collect()}
    return [c for c in LOG_COLUMNS if c in present] + sorted(present.difference(LOG_COLUMNS))


def flat_log(records: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Log records (a map per row) as a table of the wanted keys, else of all; an absent key is blank."""
    wanted = log_columns(records) if keys is None else keys
    return records.select(*[F.coalesce(F.col("record").getItem(key), F.lit("")).alias(key) for key in wanted])


def long_log(records: DataFrame) -> DataFrame:
    """Log records as (record, key, value) rows, whatever keys there are."""
    numbered = records.select(F.monotonically_increasing_id().alias("id"), "record")
    return numbered.select("id", F.explode("record").alias("key", "value"))


def with_columns_of(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns in order; absent ones as null."""
    return table.select(
        *[F.col(c) if c in table.columns else F.lit(None).cast("string").alias(c) for c in columns]
    )


def unique_exclusions(detail: DataFrame) -> DataFrame:
    """One row per (version, fund, reason)."""
    return detail.groupBy("data_version", "fund_code", "reason_code").agg(
        F.min_by(F.struct("as_of_date", "reason_detail"), F.struct("as_of_date", "reason_detail")).alias("row")
    ).select("data_version", "row.as_of_date", "fund_code", "reason_code", "row.reason_detail")


BATCH = "batch"
SCHEMA_FILE = "_schema.json"
PARTITION_TYPES = "spark.sql.sources.partitionColumnTypeInference.enabled"


def write_version(
    table: DataFrame, path: str, version: str, extra_partitions: Sequence[str] = ()
) -> None:
    """Replace one version of a stored table, keep the others; safe to repeat.

    The rows go to a folder of their own, and a commit makes them the version's (see `commits`): readers
    and failed jobs never leave or see a half version. Month partitions that have no rows any more are
    gone with the batch before. Rebalancing lets AQE split large partitions and join small ones.
    """
    rows = table.drop("data_version").withColumn("data_version", F.lit(version))
    batch = _write_batch(rows.hint("rebalance", *extra_partitions), path, extra_partitions)
    _commit_version(table.sparkSession, path, version, batch)


def write_versions(table: DataFrame, path: str) -> None:
    """Replace every version that occurs in `table`, keep all others; safe to repeat.

    One job writes all of them; each then becomes current by a commit of its own.
    """
    spark = table.sparkSession
    batch = _write_batch(table.hint("rebalance", "data_version"), path, ())
    for name in commits.names_in(spark, f"{path}/{BATCH}={batch}"):
        if name.startswith("data_version="):
            unescaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
            _commit_version(spark, path, unescaped(name.removeprefix("data_version=")), batch)


def _write_batch(rows: DataFrame, path: str, extra_partitions: Sequence[str]) -> str:
    batch = commits.new_batch()
    folder = f"{path}/{BATCH}={batch}"
    rows.write.partitionBy("data_version", *extra_partitions).parquet(folder)
    commits.write_text(rows.sparkSession, f"{folder}/{SCHEMA_FILE}", rows.schema.json())
    return batch


def _commit_version(spark: SparkSession, path: str, version: str, batch: str) -> None:
    for old in commits.commit(spark, path, version, batch):
        folder = f"{path}/{BATCH}={old}"
        commits.remove(spark, f"{folder}/data_version={commits.escaped(spark, version)}")
        if not any(n.startswith("data_version=") for n in commits.names_in(spark, folder)):
            commits.remove(spark, folder)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All current versions; version names and months stay text whatever they look like.

    The pointers are resolved here, once: what is committed later shows in the next read.
    """
    keys = commits.keys(spark, path)
    if not keys:
        raise ValueError(f"no version is stored in {path}")
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    now = {key: commits.current(spark, path, unescape(key)) for key in keys}
    folders = [f"{path}/{BATCH}={entry.batch}/data_version={key}" for key, entry in now.items() if entry]
    folders = [folder for folder in folders if files.exists(spark, folder)]
    if not folders:
        newest = max(entry.batch for entry in now.values() if entry)
        schema = T.StructType.fromJson(json.loads(commits.read_text(spark, f"{path}/{BATCH}={newest}/{SCHEMA_FILE}")))
        return spark.createDataFrame([], schema)
    before = spark.conf.get(PARTITION_TYPES)
    spark.conf.set(PARTITION_TYPES, "false")
    try:
        return spark.read.option("basePath", path).parquet(*folders).drop(BATCH)
    finally:
        spark.conf.set(PARTITION_TYPES, before)


def by_month(table: DataFrame, date_column: str, name: str) -> DataFrame:
    """Add the month a fact is stored under."""
    return table.withColumn(name, F.date_format(date_column, "yyyy-MM"))


def write_facts(
    facts: Mapping[str, DataFrame], root: str, version: str, scope: str = "full"
) -> list[str]:
    """Write the facts of the scope, each under its own partitioning; returns the names written."""
    layouts: dict[str, Callable[[DataFrame], tuple[DataFrame, tuple[str, ...]]]] = {
        "nav_daily": lambda t: (by_month(t, "nav_date", "nav_month"), ("nav_month",)),
        "return_period": lambda t: (
            by_month(t, "period_end", "period_month"),
            ("period_type", "period_month"),
        ),
    }
    for name in SCOPES[scope]:
        table, extra = layouts.get(name, lambda t: (t, ()))(facts[name])
        write_version(table, f"{root}/{name}", version, extra)
    return list(SCOPES[scope])


def store(
    spark: SparkSession,
    root: str,
    key: str,
    table: DataFrame,
    tag: str = "",
    check: Callable[[DataFrame], None] | None = None,
    kind: str = "parquet",
) -> DataFrame:
    """Write a table under its key and make it current by a commit; returns what was stored.

    `check` sees the stored table first: if it raises, what was current stays.
    """
    folder, batch = f"{root}/tables/{commits.escaped(spark, key)}", commits.new_batch()
    table.write.format(kind).save(f"{folder}/{batch}")
    stored = spark.read.schema(table.schema).format(kind).load(f"{folder}/{batch}")
    if check is not None:
        check(stored)
    for old in commits.commit(spark, root, key, batch, tag):
        commits.remove(spark, f"{folder}/{old}")
    return stored


def current_table(spark: SparkSession, root: str, key: str, batch: str) -> DataFrame:
    return spark.read.parquet(f"{root}/tables/{commits.escaped(spark, key)}/{batch}")


def write_failures(rejects: DataFrame, path: str, run: str) -> None:
    """Rejected funds (fund_code, stage, error) of a run as its JSON-lines log; a repeated run replaces its own."""
    log = rejects.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), "stage", F.col("fund_code").alias("code"), "error"
    )
    store(rejects.sparkSession, path, run, log, kind="json")


def read_failures(spark: SparkSession, path: str, runs: Sequence[str] | None = None) -> DataFrame:
    """The logs of the runs named, else of all (run, ts, stage, code, error)."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    known = {unescape(key): key for key in commits.keys(spark, path)}
    wanted = [run for run in known if runs is None or run in runs]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in LOG_COLUMNS])
    log = spark.createDataFrame([], T.StructType([T.StructField("run", T.StringType()), *schema]))
    folders = {run: f"{path}/tables/{known[run]}/{commits.current(spark, path, run).batch}" for run in wanted}
    if not folders:
        return log
    rows = spark.read.schema(schema).json(list(folders.values()))
    key = F.regexp_extract("_metadata.file_path", r"/tables/([^/]+)/[^/]+/[^/]+$", 1)
    names = F.create_map(*[F.lit(x) for run in wanted for x in (known[run], run)])
    return rows.select(names[F.url_decode(key)].alias("run"), *LOG_COLUMNS)


@dataclass(frozen=True)
class Stage:
    """A stored result: how to compute it from the stage tables before it, and what it depends on.

    `inputs` are fingerprints of tables and settings, `after` the stages it reads.
    """

    compute: Callable[[Mapping[str, DataFrame]], DataFrame]
    inputs: Sequence[str] = ()
    after: Sequence[str] = ()


class Stages(NamedTuple):
    tables: dict[str, DataFrame]
    computed: list[str]


def fingerprint(table: DataFrame) -> str:
    """Columns and content of a table, whatever the order of its rows: one pass, one row per task shuffled.

    Count, sum and exclusive or of two independent hashes: equal rows count as often as they occur.
    """
    columns = [F.col(f"`{name}`") for name in sorted(table.columns)]
    added = F.sum(F.xxhash64(F.lit(1), *columns).cast("decimal(38,0)"))
    row = table.agg(F.count(F.lit(1)), added, F.bit_xor(F.xxhash64(F.lit(2), *columns))).first()
    types = sorted((f.name, f.dataType.simpleString()) for f in table.schema)
    return hashlib.sha256(repr((types, *map(str, row))).encode()).hexdigest()


def resume_or_compute(
    spark: SparkSession, root: str, version: str, stages: Mapping[str, Stage], resume: bool = True
) -> Stages:
    """Stage tables of a version: read back where their inputs are those they were computed from.

    A manifest (the commit of each stage) holds a fingerprint of the stage's inputs and of the stages
    before it, so a changed input means computing exactly what depends on it anew, under whatever
    version name. A stage that is computed is written to a fresh folder and then committed; a failed run
    leaves the stages that ended, to be taken up. Stages are given in the order of their dependence.
    Pass resume=False to compute all (when the history is truncated at a date).
    """
    tables: dict[str, DataFrame] = {}
    marks: dict[str, str] = {}
    computed = []
    for name, stage in stages.items():
        marks[name] = hashlib.sha256(repr((name, tuple(stage.inputs), [marks[n] for n in stage.after])).encode()).hexdigest()
        key = f"{name}@{version}"
        stored = commits.current(spark, root, key)
        if resume and stored and stored.tag == marks[name]:
            tables[name] = current_table(spark, root, key, stored.batch)
        else:
            tables[name] = store(spark, root, key, stage.compute(tables), marks[name])
            computed.append(name)
    return Stages(tables, computed)
