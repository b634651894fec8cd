"""What the classifiers share: held-out rows, a bounded training sample, whole-text scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.shared import sliced, text_of

#: Text scored at a time; smaller than elsewhere, as scoring holds arrays of many times the text.
SCORED_BYTES = 1 << 18


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; 0 for a null id."""
    return F.coalesce(F.crc32(key.cast("string")) % folds, F.lit(0))


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    target: str,
    learn_from: Column,
    rows: int,
    chars: int,
    seed: int,
    share: float | None = None,
) -> tuple[list[str], np.ndarray]:
    """Texts and 0/1 labels of at most `rows` labelled documents, of `chars` characters together.

    Documents come in the order of a hash of their id. With `share`, the rarer class may fill up to
    that share of the rows. Ids without text, labels that are null or that contradict each other are
    left out.
    """
    agreed = (
        labels.where(learn_from & F.col(target).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(target).alias("label"), F.max(target).alias("other"))
        .where(F.col("label") == F.col("other"))
    )
    order = F.xxhash64(F.lit(seed), "doc_id")
    picked = agreed.select("doc_id", "label", order.alias("order"))
    if share is None:
        wanted = [picked.orderBy("order", "doc_id").limit(rows)]
    else:
        each = [max(1, int(rows * share)), max(1, rows - int(rows * share))]
        wanted = [
            picked.where(F.col("label") == value).orderBy("order", "doc_id").limit(each[1 - value])
            for value in (0, 1)
        ]
    chosen = wanted[0] if len(wanted) == 1 else wanted[0].union(wanted[1])
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    # At most `rows` ids: the bound that allows the broadcast and the reading on the driver.
    sizes = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "order", F.length("text").alias("n"))
    held = sizes.limit(2 * rows).toArrow()
    ordered = sorted(zip(*(held.column(c).to_pylist() for c in ("order", "doc_id", "n")), range(held.num_rows), strict=True))
    taken, total = [], 0
    for _, _, n, row in ordered:
        if total + n <= chars:
            taken.append(row)
            total += n
    if not taken:
        return [], np.zeros(0, np.int64)
    # An Arrow table becomes a local relation; to copy Python rows, each executor would start more Python processes.
    wanted_ids = pa.table({"doc_id": held.column("doc_id").take(taken).unique()})
    ids = docs.sparkSession.createDataFrame(wanted_ids, docs.select("doc_id").schema)
    found = texts.join(F.broadcast(ids.join(chosen, "doc_id")), "doc_id")
    sample = sorted(found.limit(2 * rows).collect(), key=lambda r: (r.order, r.doc_id, r.text))
    return [r.text for r in sample], np.array([r.label for r in sample], np.int64)


def scored(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], text: str = "text") -> DataFrame:
    """Each document as `record` (all its columns) with `score`; one pass, no shuffle."""
    schema = T.StructType().add("record", docs.schema).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text, SCORED_BYTES):
            values = pa.array(np.asarray(score(text_of(batch, text)), np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("record"), values], names=["record", "score"])

    return docs.select(F.struct("*").alias("record")).mapInArrow(run, schema)


def verdicts(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], held_out: Column) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return scored(docs, score).select(
        F.col("record.doc_id").alias("doc_id"),
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
