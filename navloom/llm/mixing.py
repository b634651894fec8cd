"""Mixing sources to target weights by temperature, with DataFrame and SQL functions only.

Source token shares are raised to an exponent between 0 (equal weights) and 1 (as they are) and
normalised. The exponent is bisected: the smallest one that keeps every source's repetition (its part
of the budget over its tokens) within a limit, or the largest one whose weights still reach a target
entropy. Weights become whole token quotas, and quotas become passes: a source gives whole
permutations of its documents while they fit, then the head of one more. A document's place in its
source's passes, as a share of the quota, decides its block of the mixture, so every block has every
source at its weight; within a block the order is a seeded permutation.

Tokens are runs of other than white space, and a document has one at least, so that empty texts keep
their place. No step is larger than it need be: a source, however hot, is cut into hash ranges of
about `RANGE_ROWS` documents, prefix sums run inside ranges and over range totals.

Defined results: a null source is a source of its own; a null text has one token; rows with equal or
null ids are ordered by their text; rows equal in both are copies that share a place's order but not
a place; an empty table gives an empty mixture. Columns of the documents come back inside `record`,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.shared import keep

RANGE_ROWS = 4096
#: Blocks a task writes at most, where there are more than tasks otherwise.
BLOCKS_OF_TASK = 16
BISECTIONS = 40
#: Bisections decided by one job: it tries every exponent they could come to.
AT_ONCE = 5


@dataclass(frozen=True)
class Target:
    """Give one of the two; `budget` is a multiple of the tokens there are."""

    repetition: float | None = None
    entropy: float | None = None
    budget: float = 1.0
    block_tokens: int = 1 << 20
    seed: int = 11


def token_count(text: Column) -> Column:
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)), F.lit(1)).cast("long")


def _draw(*parts: Column | str) -> Column:
    """A seeded 60-bit draw, from the leading digits of an MD5 sum."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 15), 16, 10).cast("long")


def _measure(sources: DataFrame, exponents: list[float], target: Target) -> dict[float, bool]:
    """For each exponent, whether the weights it gives lie on the side of a larger exponent."""
    tried = sources.select("share", F.explode(F.array(*[F.lit(x) for x in exponents])).alias("exponent"))
    powers = tried.withColumn("power", F.pow("share", "exponent"))
    sums = powers.groupBy("exponent").agg(
        F.sum("power").alias("total"),
        F.max(F.col("power") / F.col("share")).alias("most"),
        F.sum(F.col("power") * F.ln("power")).alias("plogp"),
    )
    if target.repetition is not None:  # repetition falls as the exponent rises
        low = F.col("most") / F.col("total") * F.lit(target.budget) > F.lit(target.repetition)
    else:  # entropy falls as the exponent rises
        low = F.ln("total") - F.col("plogp") / F.col("total") >= F.lit(target.entropy)
    return {r.exponent: r.larger for r in sums.select("exponent", low.alias("larger")).collect()}


def exponent(sources: DataFrame, target: Target) -> float:
    """Bisect in [0, 1]; each job answers for all the middles of the next few halvings."""
    low, high = 0.0, 1.0
    ends = _measure(sources, [0.0, 1.0], target)
    if not ends or not ends[0.0]:
        return 0.0
    if ends[1.0]:
        return 1.0
    for _ in range(BISECTIONS // AT_ONCE):
        steps = 1 << AT_ONCE
        answers = _measure(sources, [low + (high - low) * k / steps for k in range(1, steps)], target)
        for _ in range(AT_ONCE):
            middle = (low + high) / 2
            if answers[middle]:
                low = middle
            else:
                high = middle
    return high if target.repetition is not None else low


def weights(sources: DataFrame, target: Target) -> DataFrame:
    """Per source (source, docs, tokens): share, exponent, weight and quota in tokens."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shares = sources.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    power = exponent(shares.select("share"), target)
    raised = shares.withColumn("power", F.round(F.pow("share", F.lit(power)), 12))
    norm = raised.agg(F.sum("power")).first()[0] or 1.0
    return raised.withColumns(
        {
            "exponent": F.lit(power),
            "weight": F.round(F.col("power") / F.lit(norm), 9),
        }
    ).withColumn("quota", F.floor(F.col("weight") * F.lit(total * target.budget)).cast("long")).drop("power")


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The documents as `record`, with the name that orders them and a digest of all their columns."""
    name = F.md5(F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.coalesce(F.md5(text), F.lit("null"))))
    every = [F.to_json(f"`{f.name}`") if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in docs.schema]
    return docs.select(F.struct("*").alias("record"), name.alias("name"), F.xxhash64(*every).alias("digest"))


def narrow(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """group, tokens, name and digest of every document: all that is sorted, summed and placed; texts are read once for it."""
    group = F.coalesce(F.concat(F.lit("="), F.col(f"record.{source}")), F.lit("null")).alias("group")
    return keep(_named(docs, key, text).select(group, token_count(F.col(f"record.{text}")).alias("tokens"), "name", "digest"), "narrow")


def placements(named: DataFrame, target: Target) -> DataFrame:
    """Where the `narrow` rows go: name, digest, source, weight, pass, tokens, block and draw."""
    sources = keep(named.groupBy("group").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens")), "sources")
    planned = weights(sources, target)
    plan = keep(planned.select("group", "docs", F.col("tokens").alias("supply"), "weight", "quota"), "weights")
    passes = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("quota div supply"))).alias("pass")
    copies = named.join(plan, "group").select("*", passes)
    ranges = F.greatest(F.lit(1), F.ceil(F.col("docs") / RANGE_ROWS)).cast("long")
    slim = copies.withColumn("draw", _draw(F.lit(str(target.seed)), F.col("pass").cast("string"), "name")).withColumn(
        "range", F.floor(F.shiftright(F.col("draw"), 30) * ranges / F.lit(float(1 << 30)))
    )
    totals = slim.groupBy("group", "pass", "range").agg(F.sum("tokens").alias("range_tokens"))
    above = Window.partitionBy("group", "pass").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = keep(
        totals.select("group", "pass", "range", F.coalesce(F.sum("range_tokens").over(above), F.lit(0)).alias("first")), "ranges"
    )
    inside = Window.partitionBy("group", "pass", "range").orderBy("draw", "name", "digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        slim.withColumn("before", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .join(starts, ["group", "pass", "range"])
        .withColumn("at", F.col("pass") * F.col("supply") + F.col("first") + F.col("before"))
        .where(F.col("at") + F.col("tokens") <= F.col("quota"))
    )
    blocks = max(1, round((sources.agg(F.sum("tokens")).first()[0] or 0) * target.budget / target.block_tokens))
    return placed.select(
        "name",
        "digest",
        F.when(F.col("group") != "null", F.expr("substring(group, 2)")).alias("source"),
        "weight",
        "pass",
        "tokens",
        F.floor(F.col("at") * F.lit(blocks) / F.col("quota")).cast("long").alias("block"),
        _draw(F.lit(str(target.seed + 1)), F.col("pass").cast("string"), "name").alias("draw"),
    )


def mixture(docs: DataFrame, target: Target, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixture: record (the document), source, weight, pass, tokens, block, draw and name (its order
    in the block).

    A document whose part of the last pass would exceed the quota is left out of that pass; so a
    source gives at most its quota, and less than it by under one document. Records meet their places
    in the end, by name and digest; rows equal in every column are one there, and come as often as
    they were placed.
    """
    named = narrow(docs, key, text, source)
    placed = keep(placements(named, target), "placed")
    records = _named(docs, key, text)
    if not named.groupBy("name", "digest").count().where("count > 1").isEmpty():
        records = records.groupBy("name", "digest").agg(F.first("record").alias("record"))
    return placed.join(records, ["name", "digest"]).select(
        "record", "source", "weight", "pass", "tokens", "block", "draw", "name"
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The mixture in tasks of whole blocks, each in order, one task's blocks after those of the task before."""
    blocks = (mixed.agg(F.max("block")).first()[0] or 0) + 1
    tasks = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(blocks, max(tasks, blocks // BLOCKS_OF_TASK))
    task = F.floor(F.col("block") * F.lit(parts) / F.lit(blocks)).cast("int")
    return mixed.repartitionById(parts, task).sortWithinPartitions("block", "draw", "name", "pass")


def ordered(mixed: DataFrame) -> DataFrame:
    """With slot, the place in the block from 0; a block's tokens bound the window."""
    place = Window.partitionBy("block").orderBy("draw", "name", "pass")
    return mixed.withColumn("slot", F.row_number().over(place) - 1)
