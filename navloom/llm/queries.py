"""Registered queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import navloom
import numpy as np
import public_tokenizers
from navloom.llm import (
    centroids,
    collision_search,
    embedding_dedup,
    html_templates,
    jaccard_join,
    license_match,
    mixing,
    oracles,
    packing,
    periodic_runs,
    quality,
    sharding,
    toxicity,
    warc,
)
from navloom.llm.shared import new_folder, read
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    root = Path(navloom.__file__).parent
    application = spark.sparkContext.applicationId
    if application in _shipped or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="navloom-")) / "navloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, Path("navloom") / file.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    path = new_folder(spark, "shards")
    sharding.write_shards(docs, path, shards=8)
    stored = sharding.read_shards(spark, path, docs.schema)
    key, text = F.col("record.doc_id"), F.col("record.text")
    return stored.select(
        key.alias("doc_id"),
        sharding.size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        sharding.shard_of(key, 9, 17).alias("grown_shard"),
    )


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return pieces_digest(packing.pieces(packing.tokenized(docs, tokenizer_path())))


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def pieces_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        F.col("key").alias("doc_id"),
        "start",
        F.col("size").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.judge(docs, model)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.judge(docs, model)


@query("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read(spark, sf_dir, "documents", "doc_id", "text"))


#: The mixture of query and pipeline: no source more than 1.25 times, as many tokens as there are.
TARGET = mixing.Target(repetition=1.25)

MIXING_SQL = r"""
WITH RECURSIVE named AS (
  SELECT doc_id, coalesce('=' || source, 'null') AS grp,
         greatest(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0), 1) AS tokens,
         md5(coalesce(doc_id::VARCHAR, 'null') || '/' || coalesce(md5(text), 'null')) AS name
  FROM documents),
sources AS (SELECT grp, count(*) AS docs, sum(tokens)::BIGINT AS supply FROM named GROUP BY grp),
shares AS (SELECT *, supply / (SELECT sum(supply) FROM sources)::DOUBLE AS share FROM sources),
bisected(step, low, high) AS (
  SELECT 0, 0e0, 1e0
  UNION ALL
  SELECT step + 1, CASE WHEN larger THEN (low + high) / 2 ELSE low END, CASE WHEN larger THEN high ELSE (low + high) / 2 END
  FROM (SELECT step, low, high,
               (SELECT max(pow(share, (b.low + b.high) / 2) / share) / sum(pow(share, (b.low + b.high) / 2)) FROM shares) > 1.25 AS larger
        FROM bisected b WHERE step < 40)),
ends AS (SELECT (SELECT max(1 / share) / count(*) FROM shares) > 1.25 AS above),
chosen AS (SELECT CASE WHEN NOT (SELECT above FROM ends) THEN 0e0 ELSE high END AS exponent FROM bisected WHERE step = 40),
raised AS (SELECT *, round(pow(share, (SELECT exponent FROM chosen)), 12) AS power FROM shares),
weighted AS (SELECT grp, supply, round(power / (SELECT sum(power) FROM raised), 9) AS weight FROM raised),
plan AS (SELECT *, floor(weight * (SELECT sum(supply) FROM sources)::DOUBLE)::BIGINT AS quota FROM weighted),
copies AS (SELECT n.*, p.supply, p.weight, p.quota, unnest(range(0, p.quota // p.supply + 1)) AS pass FROM named n JOIN plan p USING (grp)),
drawn AS (SELECT *, ('0x' || md5('11/' || pass || '/' || name)[1:15])::BIGINT AS draw FROM copies),
placed AS (
  SELECT *, pass * supply + coalesce(sum(tokens) OVER (PARTITION BY grp, pass ORDER BY draw, name
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spot FROM drawn),
taken AS (
  SELECT *, floor(spot * (SELECT greatest(1, round(sum(supply) / 1048576.0)) FROM sources)::DOUBLE / quota)::BIGINT AS block,
         ('0x' || md5('12/' || pass || '/' || name)[1:15])::BIGINT AS again
  FROM placed WHERE spot + tokens <= quota)
SELECT doc_id, CASE WHEN grp = 'null' THEN NULL ELSE grp[2:] END AS source, weight, pass, tokens, block,
       (row_number() OVER (PARTITION BY block ORDER BY again, name, pass) - 1)::INTEGER AS slot
FROM taken
"""


@query("op5_mixing", MIXING_SQL)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    mixed = mixing.mixture(docs, TARGET)
    return mixing.ordered(mixed.withColumn("doc_id", F.col("record.doc_id")).drop("record")).select(
        "doc_id", "source", "weight", "pass", "tokens", "block", "slot"
    )


@query("op7_html_templates")
def op7_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_templates.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op8_embedding_dedup")
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query("op9_collision_search")
def op9_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return collision_search.search(vectors.where("vec_id % 100 = 0"), vectors)


@query("op4_warc")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archives")
    index = warc.write_archives(read(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return warc.read_archives(index, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the id of a tenth of the documents says from which word on a stretch of it repeats."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(F.lit(""))

    # Bound as the one element of an array, the words are split once however often they are named.
    words = F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    planted = F.when((h % 10 == 0) & F.col("text").isNotNull(), F.get(F.transform(words, repeated), F.lit(0))).otherwise(F.col("text"))
    return docs.select("doc_id", planted.alias("text"))


@query("op11_periodic_runs", oracles.RUNS_SQL)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_digest(periodic_runs.find(with_planted_runs(read(spark, sf_dir, "documents", "doc_id", "text"))))


def runs_digest(found: DataFrame) -> DataFrame:
    """The run of greatest length / period of each document, compared without division, and digests."""
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    greater = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    best = F.aggregate("runs", none, lambda best, run: F.when(greater(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_license_match", oracles.LICENSE_SQL)
def op12_license_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_match.labelled(license_match.scan(read(spark, sf_dir, "documents", "doc_id", "text")))


@query("op13_centroids", oracles.centroid_sql(centroids.CLUSTERS, centroids.ROUNDS))
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters_digest(*centroids.cluster(read(spark, sf_dir, "embeddings", "vec_id", "embedding")))


def clusters_digest(table: DataFrame, final: np.ndarray) -> DataFrame:
    """Each vector with the inertia of its cluster and of all; the side joined has one row per centroid."""
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(final.tolist())]
    named = table.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    inertia = table.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0)))
    sums = inertia.withColumn("inertia", total).join(F.broadcast(named), "cluster")
    return table.select("vec_id", "cluster", "distance").join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
