"""Two-pass external shuffle into shards.

Pass one scatters records uniformly into memory-sized buckets by a seeded hash. Pass two loads one
bucket at a time, permutes it by Fisher-Yates and writes it. The shard of a record is decided by its
id and the shard count alone (law "key"): every shard draws a hash for the id, the highest wins, so
one more shard takes records only into itself.

Defined results: a null text has size 1 and CRC 0 and stays null in the files; rows with equal or
null ids share a shard but not a bucket unless they are equal throughout; an empty table gives an
empty, readable dataset; other columns, whatever their names, travel inside the record.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.shared import shuffles_dropped

LAW = "key"
#: Text bytes of a bucket; a bucket is the most a task holds.
BUCKET_BYTES = 16 << 20
#: Buckets whose first slots may be broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_BUCKETS = 1_000_000


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard whose hash of the key is highest; ties cannot matter for 64-bit hashes but go to the lower shard."""
    draws = F.array(
        *[F.struct(F.xxhash64(F.lit(seed), F.lit(i), key).alias("draw"), F.lit(-i).alias("shard")) for i in range(shards)]
    )
    return (-F.array_max(draws)["shard"]).cast("int")


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation: each place, from the last down, swaps with a place not above it."""
    order = list(range(n))
    drawn = np.random.default_rng(seed).random(n)
    for i in range(n - 1, 0, -1):
        j = int(drawn[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _permuted(seed: int, key: str, text: str):
    def permute(table: pa.Table) -> pa.Table:
        shard, bucket = table["shard"][0].as_py(), table["bucket"][0].as_py()
        record = table["record"].combine_chunks()
        crc = [zlib.crc32((t or "").encode()) for t in pc.struct_field(record, text).to_pylist()]
        # The order of arrival differs between attempts of a task: start from one that does not.
        keys = pa.table({"key": pc.struct_field(record, key), "crc": pa.array(crc, pa.int64())})
        start = pc.sort_indices(keys, [("key", "ascending"), ("crc", "ascending")]).to_numpy()
        order = start[fisher_yates(table.num_rows, [seed, shard, bucket])]
        place = pa.array(np.arange(table.num_rows, dtype=np.int64))
        shuffled = table.take(pa.array(order))
        return shuffled.set_column(table.column_names.index("place"), "place", place)

    return permute


def write_shards(
    records: DataFrame,
    path: str,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 17,
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write the records under `path`, one folder per shard, in shuffled order within each bucket."""
    total = records.agg(F.sum(size_of(F.col(text)))).first()[0] or 0
    buckets = max(1, math.ceil(total / shards / bucket_bytes))
    scattered = records.select(
        F.struct("*").alias("record"),
        shard_of(F.col(key), shards, seed).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), key, text), F.lit(buckets)).cast("int").alias("bucket"),
        F.lit(0).cast("long").alias("place"),
    )
    shuffled = scattered.groupBy("shard", "bucket").applyInArrow(_permuted(seed, key, text), scattered.schema)
    with shuffles_dropped(records.sparkSession):
        shuffled.write.option("compression", "zstd").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, records: T.StructType) -> DataFrame:
    """Per record: record, shard, bucket, place (in the bucket) and slot (in the shard, gapless from 0)."""
    schema = T.StructType().add("record", records).add("bucket", "integer").add("place", "long").add("shard", "integer")
    stored = spark.read.schema(schema).parquet(path)
    sizes = stored.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    above = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("shard", "bucket", F.coalesce(F.sum("rows").over(above), F.lit(0)).alias("first"))
    if sizes.count() <= BROADCAST_BUCKETS:
        first = F.broadcast(first)
    return stored.join(first, ["shard", "bucket"]).withColumn("slot", F.col("first") + F.col("place")).drop("first")
