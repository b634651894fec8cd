import math
from collections import defaultdict

import corpus_pipeline
import pytest
from navloom.llm import mixing
from navloom.llm.queries import MIXING_SQL, TARGET
from pyspark.sql import functions as F

from .data import documents, odd_texts, words


def corpus(spark, seed=0):
    texts = [words(20 + (i * 7) % 60, seed + i) for i in range(240)]
    docs = documents(spark, texts)
    hot = F.when(F.col("doc_id") < 150, "hot").when(F.col("doc_id") < 220, "warm").otherwise("cold")
    return docs.withColumn("source", hot)


@pytest.mark.parametrize("limit", [1.0, 1.3, 2.0, 50.0])
def test_repetition_limit_and_quotas(spark, limit):
    target = mixing.Target(repetition=limit, block_tokens=2000)
    rows = mixing.mixture(corpus(spark), target).collect()
    supply, given, weight = defaultdict(int), defaultdict(int), {}
    for r in corpus(spark).select("source", mixing.token_count(F.col("text")).alias("t")).collect():
        supply[r.source] += r.t
    for r in rows:
        given[r.source] += r.tokens
        weight[r.source] = r.weight
    total = sum(supply.values())
    assert abs(sum(weight.values()) - 1) < 1e-6
    for s in supply:
        assert weight[s] * total / supply[s] <= limit * 1.00001
        assert 0 <= weight[s] * total - given[s] <= 100
    if limit == 50.0:
        assert max(weight.values()) - min(weight.values()) < 1e-6
    if limit == 1.0:
        assert all(abs(weight[s] - supply[s] / total) < 1e-6 for s in supply)


def test_passes_are_whole_before_the_last(spark):
    rows = mixing.mixture(corpus(spark), mixing.Target(repetition=50.0, block_tokens=2000)).collect()
    cold = [r for r in rows if r.source == "cold"]
    passes = max(r["pass"] for r in cold)
    assert passes >= 2
    for p in range(passes):
        assert sorted(r.record.doc_id for r in cold if r["pass"] == p) == list(range(220, 240))


def test_entropy_target(spark):
    sources = spark.createDataFrame([(0.7,), (0.2,), (0.1,)], "share double")
    wanted = 0.95 * math.log(3)
    power = mixing.exponent(sources, mixing.Target(entropy=wanted))
    raised = [s**power for s in (0.7, 0.2, 0.1)]
    parts = [x / sum(raised) for x in raised]
    assert abs(-sum(p * math.log(p) for p in parts) - wanted) < 1e-6
    assert mixing.exponent(sources, mixing.Target(entropy=0.1)) == 1.0
    assert mixing.exponent(sources, mixing.Target(entropy=2.0)) == 0.0


def test_blocks_have_every_source_at_its_weight(spark):
    rows = mixing.mixture(corpus(spark), mixing.Target(repetition=2.0, block_tokens=3000)).collect()
    for block in {r.block for r in rows}:
        own = [r for r in rows if r.block == block]
        all_tokens = sum(r.tokens for r in own)
        for source in ("hot", "warm", "cold"):
            share = sum(r.tokens for r in own if r.source == source) / all_tokens
            assert abs(share - next(r.weight for r in rows if r.source == source)) < 0.06


def test_ranges_do_not_change_the_mixture(spark, monkeypatch):
    def result():
        mixed = mixing.ordered(mixing.mixture(corpus(spark), TARGET))
        return sorted(tuple(r) for r in mixed.select("record.doc_id", "pass", "block", "slot").collect())

    before = result()
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    assert result() == before


def test_odd_rows_against_sql(spark):
    import duckdb

    docs = documents(spark, [*odd_texts(), *odd_texts()], ", quota string, pass int, supply string", ("q", 1, "s"))
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 4 == 0, None).otherwise(F.col("source")))
    docs = docs.union(docs.where("doc_id = 9").withColumn("doc_id", F.lit(None).cast("long")))
    mixed = mixing.ordered(mixing.mixture(docs, TARGET)).withColumn("doc_id", F.col("record.doc_id"))
    columns = ["doc_id", "source", "weight", "pass", "tokens", "block", "slot"]
    connection = duckdb.connect()
    connection.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    expected = connection.execute(MIXING_SQL).fetchall()
    assert sorted(map(str, map(tuple, mixed.select(*columns).collect()))) == sorted(map(str, expected))


def test_stretches_of_the_pipeline_hold_every_source(spark, tmp_path):
    docs = corpus(spark)
    corpus_pipeline.mixed(spark, docs, "").write.parquet(f"{tmp_path}/mixed")
    rows = spark.read.parquet(f"{tmp_path}/mixed").collect()
    assert spark.read.parquet(f"{tmp_path}/mixed").columns == docs.columns
    order = [r.source for r in rows]
    whole = {s: order.count(s) / len(order) for s in ("hot", "warm", "cold")}
    for start in range(0, len(order) - 60, 60):
        stretch = order[start : start + 60]
        assert all(abs(stretch.count(s) / 60 - share) < 0.2 for s, share in whole.items())


def test_empty_table(spark):
    assert mixing.mixture(corpus(spark).where("false"), TARGET).count() == 0


def test_native(spark):
    plan = mixing.mixture(corpus(spark), TARGET)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
