import zlib

from navloom.llm import sharding
from pyspark.sql import functions as F

from .data import documents, odd_texts


def shards(spark, docs, folder, **options):
    sharding.write_shards(docs, folder, **options)
    return sharding.read_shards(spark, folder, docs.schema)


def test_every_record_once_with_gapless_slots(spark, folder):
    docs = documents(spark, odd_texts(), ", shard string, bucket long, place string, slot string", ("x", 7, None, "y"))
    docs = docs.union(docs.limit(2)).union(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    out = shards(spark, docs, folder, shards=4, bucket_bytes=2000)
    rows = out.collect()
    assert sorted(map(str, (r.record for r in rows))) == sorted(map(str, docs.collect()))
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({(r.shard, r.bucket) for r in rows}) > 4


def test_one_more_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(3000)
    both = ids.select(sharding.shard_of(F.col("id"), 8, 17).alias("a"), sharding.shard_of(F.col("id"), 9, 17).alias("b"))
    rows = both.collect()
    assert all(r.b in (r.a, 8) for r in rows)
    counts = [sum(r.a == k for r in rows) for k in range(8)]
    assert min(counts) > 300 and max(counts) < 460


def test_order_depends_on_the_seed_alone(spark, folder):
    docs = documents(spark, odd_texts())
    one = shards(spark, docs, folder + "1", shards=2)
    two = shards(spark, docs.repartition(5), folder + "2", shards=2)
    pick = ["record.doc_id", "shard", "slot"]
    assert sorted(map(tuple, one.select(*pick).collect())) == sorted(map(tuple, two.select(*pick).collect()))


def test_fisher_yates_is_a_uniform_permutation():
    seen = {}
    for seed in range(6000):
        key = tuple(sharding.fisher_yates(3, [seed]).tolist())
        seen[key] = seen.get(key, 0) + 1
    assert len(seen) == 6 and max(seen.values()) < 1150 and min(seen.values()) > 850


def test_empty_table(spark, folder):
    assert shards(spark, documents(spark, odd_texts()).where("false"), folder, shards=3).count() == 0


def test_crc_is_of_utf8(spark):
    row = documents(spark, ["é", None]).select(F.crc32(F.coalesce("text", F.lit(""))).alias("c"), sharding.size_of(F.col("text")).alias("s"))
    assert [tuple(r) for r in row.collect()] == [(zlib.crc32("é".encode()), 3), (0, 1)]
