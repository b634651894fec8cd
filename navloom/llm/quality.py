"""Quality classifier: supervised subword embeddings.

A document is the average of the vectors of its words and of the words' character n-grams, all hashed
into one table; a softmax layer turns the average into two class probabilities. Table and layer are
learned together by stochastic gradient descent in numpy, on a bounded sample of labelled documents.

Learning is small and happens once, on the driver: the sample is at most `Plan.sample` documents of
at most `Plan.sample_chars` characters together, chosen by a hash of the id. Scoring runs inside
Spark tasks over every whole text: the model is linear in the average, so each distinct word of a
slice is worth one number, and a document's margin is the mean over its words.

Defined results: a null, empty or white-space text has the average 0 and so the score of the bias
alone; equal texts have equal scores; labels that are null, repeated with different values or of one
class only are left out or give a constant model; ids may be null or repeated; an empty table gives
an empty result; columns besides id and text are neither inputs nor touched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.labelled import fold, scored, training_sample, verdicts
from navloom.llm.shared import give_back, mix64, utf8
from navloom.llm.words import Words, character_ngrams, kinds, split


#: The bucket of the mark that stands for the features of a repeated word.
REPEATED = 0
#: Training documents whose features share an array; large arrays go back to the system when done.
TOGETHER = 64


@dataclass(frozen=True)
class Plan:
    """Bounds and sizes; `sample` and `sample_chars` bound what the driver reads to learn from."""

    buckets: int = 1 << 17
    size: int = 12
    shortest: int = 3
    longest: int = 5
    epochs: int = 6
    rate: float = 1.0
    sample: int = 1600
    sample_chars: int = 6_000_000
    seed: int = 7


def features(words: list[str], hashes: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each distinct word and its character n-grams, and whose each is."""
    grams, owner = character_ngrams(words, plan.shortest, plan.longest)
    ids = np.concatenate([mix64(hashes + np.uint64(1)), grams]) % np.uint64(plan.buckets)
    return ids.astype(np.int64), np.concatenate([np.arange(len(words)), owner])


def repeats(words: Words) -> np.ndarray:
    """Words equal to the one before: all their features are read as the mark REPEATED."""
    again = np.zeros(len(words.hash), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    return again


@dataclass
class Model:
    """The classifier as a number per bucket (its vector times the layer's difference) and the bias."""

    worth: np.ndarray
    bias: float
    plan: Plan

    def score(self, texts: pa.Array) -> np.ndarray:
        data, offsets = utf8(texts)
        words = split(data, offsets)
        found = kinds(data, words)
        ids, owner = features(found.raw, found.hash, self.plan)
        n = len(found.raw)
        sums = np.bincount(owner, self.worth[ids], n)
        counts = np.bincount(owner, minlength=n)
        docs = len(texts)
        each = counts[found.which].astype(float)
        worth = np.where(repeats(words), each * self.worth[REPEATED], sums[found.which])
        margin = np.bincount(words.doc, worth, docs)
        total = np.bincount(words.doc, each, docs)
        return 1 / (1 + np.exp(-(margin / np.maximum(total, 1) + self.bias)))


def train(texts: list[str], labels: np.ndarray, plan: Plan = Plan()) -> Model:
    """Stochastic gradient descent, a document at a time, with a linearly falling rate."""
    if len(set(labels.tolist())) < 2:
        sure = 0.0 if not len(labels) else (5.0 if labels[0] == 1 else -5.0)
        return Model(np.zeros(plan.buckets), sure, plan)
    parts = examples(texts, plan)
    random = np.random.default_rng(plan.seed)
    table = random.uniform(-1, 1, (plan.buckets, plan.size)).astype(np.float32) / plan.size
    layer = np.zeros((2, plan.size), np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = plan.epochs * len(texts), 0
    for _ in range(plan.epochs):
        for i in random.permutation(len(texts)).tolist():
            rate = plan.rate * (1 - done / steps)
            done += 1
            all_ids, all_weights, bounds = parts[i // TOGETHER]
            part = slice(bounds[i % TOGETHER], bounds[i % TOGETHER + 1])
            ids, weight = all_ids[part], all_weights[part]
            average = weight @ table[ids]
            logits = layer @ average + bias
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[labels[i]] -= 1
            back = error @ layer
            layer -= rate * np.outer(error, average)
            bias -= 0.1 * rate * error
            table[ids] -= rate * np.outer(weight, back)
    worth = table.astype(np.float64) @ (layer[1] - layer[0]).astype(np.float64)
    return Model(worth, float(bias[1] - bias[0]), plan)


def examples(texts: list[str], plan: Plan) -> list[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Features, shares and bounds of the documents, TOGETHER of them in one pair of arrays."""
    parts = []
    for at in range(0, len(texts), TOGETHER):
        held = [document_features(text, plan) for text in texts[at : at + TOGETHER]]
        bounds = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in held])]).tolist()
        ids, weights = (np.concatenate(side) for side in zip(*held, strict=True))
        parts.append((ids.astype(np.int32), weights, bounds))
    return parts


def document_features(text: str, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document and their shares of all its features."""
    data, offsets = utf8(pa.array([text], pa.large_string()))
    words = split(data, offsets)
    found = kinds(data, words)
    ids, owner = features(found.raw, found.hash, plan)
    if not len(ids):
        return ids, np.zeros(0, np.float32)
    again, n = repeats(words), len(found.raw)
    times = np.bincount(found.which[~again], minlength=n)
    marks = np.bincount(owner, minlength=n)[found.which[again]].sum()
    distinct, place = np.unique(np.append(ids, REPEATED), return_inverse=True)
    weight = np.bincount(place, np.append(times[owner], marks), len(distinct))
    return distinct, (weight / max(weight.sum(), 1)).astype(np.float32)


def held_out() -> Column:
    return fold(F.col("doc_id"), 3) == 1


def fit(docs: DataFrame, labels: DataFrame, plan: Plan = Plan()) -> Model:
    """Learn from the labelled documents outside the held-out fold."""
    texts, wanted = training_sample(docs, labels, "quality", ~held_out(), plan.sample, plan.sample_chars, plan.seed, 0.5)
    model = train(texts, wanted, plan)
    del texts, wanted
    give_back()
    return model


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (1: good) and predicted for every document's whole text."""
    return verdicts(docs, model.score, held_out())


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a score of at least 0.5, with all their columns."""
    return scored(docs, model.score).where("score >= 0.5").select("record.*")
