"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Input of a step is a word: its hashed vector beside the mean of the hashed vectors of its character
n-grams. Two gated recurrent layers read a window forwards and backwards, attention pools their
states, a logistic unit gives the window's score. A document is cut into windows of `Plan.window`
words that overlap by `window - stride`; all of them are scored, and the highest score counts.

Learning happens once, on the driver, over at most `Plan.sample` labelled documents of
`Plan.sample_chars` characters together. Only documents are labelled, so rounds alternate: score all
windows, then learn from the highest window of each document (and one other of the clean ones).

Defined results: a null, empty or white-space text has one empty window, whose score is that of the
bias; labels that are null, repeated with different values or of one class only are left out or give
a constant model; ids may be null or repeated; an empty table gives an empty result; columns besides
id and text are neither inputs nor touched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.labelled import fold, scored, training_sample, verdicts
from navloom.llm.shared import give_back, mix64, utf8
from navloom.llm.words import character_ngrams, kinds, kinds_of_texts, split

Arrays = dict[str, np.ndarray]
#: Words whose n-grams are cut, or whose vectors are gathered, together; bounds the work arrays.
WORDS_AT_ONCE = 1 << 12
WAYS = ("ahead", "back")
#: Windows that are read together.
WINDOWS_AT_ONCE = 1024


@dataclass(frozen=True)
class Plan:
    """Bounds and sizes; `sample` and `sample_chars` bound what the driver reads to learn from."""

    window: int = 64
    stride: int = 48
    word_buckets: int = 1 << 16
    gram_buckets: int = 1 << 16
    word_size: int = 8
    gram_size: int = 12
    shortest: int = 3
    longest: int = 5
    state: int = 8
    rounds: int = 6
    least_steps: int = 240
    batch: int = 64
    rate: float = 0.08
    sample: int = 3200
    sample_chars: int = 10_000_000
    seed: int = 5


def parameters(plan: Plan) -> Arrays:
    random = np.random.default_rng(plan.seed)
    size, h = plan.word_size + plan.gram_size, plan.state

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    p = {
        "word": draw(plan.word_buckets, plan.word_size, scale=0.1),
        "gram": draw(plan.gram_buckets, plan.gram_size, scale=0.1),
        "attend": draw(2 * h, scale=0.1),
        "out": draw(2 * h, scale=0.3),
        "bias": np.zeros(1, np.float32),
    }
    for way in WAYS:
        p[f"{way}_in"] = draw(size, 3 * h, scale=size**-0.5)
        p[f"{way}_state"] = draw(h, 3 * h, scale=h**-0.5)
        p[f"{way}_bias"] = np.zeros(3 * h, np.float32)
    return p


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def sum_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    if not len(rows):
        return rows, values
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.add.reduceat(values[order], first, axis=0)


@dataclass
class Lexicon:
    """Distinct words: the bucket of each, and the buckets of their n-grams one word after another."""

    word: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, raw: list[str], hashes: np.ndarray, plan: Plan) -> Lexicon:
        buckets, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(raw), WORDS_AT_ONCE):
            part = raw[at : at + WORDS_AT_ONCE]
            grams, owner = character_ngrams(part, plan.shortest, plan.longest)
            order = np.argsort(owner, kind="stable")
            buckets.append((grams[order] % np.uint64(plan.gram_buckets)).astype(np.int32))
            lengths.append(np.bincount(owner, minlength=len(part)))
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        word = (mix64(hashes + np.uint64(3)) % np.uint64(plan.word_buckets)).astype(np.int64)
        return cls(word, np.concatenate(buckets), bounds)

    def pick(self, kinds_wanted: np.ndarray) -> Lexicon:
        length = (self.bounds[1:] - self.bounds[:-1])[kinds_wanted]
        ends = np.cumsum(length)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.bounds[:-1][kinds_wanted] - ends + length, length)
        return Lexicon(self.word[kinds_wanted], self.grams[at], np.concatenate([[0], ends]))

    def inputs(self, p: Arrays, start: int = 0, end: int | None = None) -> np.ndarray:
        """A word vector beside the mean of the n-gram vectors, for the words start:end; every word has n-grams."""
        word = self.word[start:end]
        if not len(word):
            return np.zeros((0, p["word"].shape[1] + p["gram"].shape[1]), np.float32)
        bounds = self.bounds[start : start + len(word) + 1]
        vectors = p["gram"][self.grams[bounds[0] : bounds[-1]]]
        sums = np.add.reduceat(vectors, bounds[:-1] - bounds[0], axis=0)
        return np.hstack([p["word"][word], sums / np.diff(bounds)[:, None].astype(np.float32)])

    def given(self, p: Arrays) -> Arrays:
        """What each direction's layer is given for each word, once for all windows; the last row is for none."""
        n = len(self.word)
        out = {way: np.empty((n + 1, p[f"{way}_in"].shape[1]), np.float32) for way in WAYS}
        for at in range(0, n, WORDS_AT_ONCE):
            inputs = self.inputs(p, at, at + WORDS_AT_ONCE)
            for way in WAYS:
                out[way][at : at + len(inputs)] = inputs @ p[f"{way}_in"] + p[f"{way}_bias"]
        for way in WAYS:
            out[way][n] = p[f"{way}_bias"]
        return out


def windows(bounds: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents with words bounds[i]:bounds[i+1]: first word, words and document of every window."""
    words = np.diff(bounds)
    count = 1 + np.maximum(0, -(-(words - plan.window) // plan.stride))
    doc = np.repeat(np.arange(len(words)), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    first = bounds[:-1][doc] + number * plan.stride
    return first, np.minimum(plan.window, bounds[1:][doc] - first), doc


def steps_of(which: np.ndarray, first: np.ndarray, size: np.ndarray, plan: Plan, none: int) -> np.ndarray:
    """Kinds of word in each window, a row per step; `none` beyond a window's end."""
    at = first[None, :] + np.arange(plan.window)[:, None]
    inside = np.arange(plan.window)[:, None] < size[None, :]
    return np.where(inside, which[np.minimum(at, max(len(which) - 1, 0))] if len(which) else none, none)


def _read(p: Arrays, way: str, given: np.ndarray, steps: np.ndarray, mask: np.ndarray, trace: list | None) -> np.ndarray:
    """States of one direction; `given` holds the layer's input for each kind, the last row for none."""
    h = p[f"{way}_state"].shape[0]
    state = np.zeros((steps.shape[1], h), np.float32)
    states = np.empty((*steps.shape, h), np.float32)
    for t in range(steps.shape[0]) if way == "ahead" else reversed(range(steps.shape[0])):
        a = given[steps[t]]
        u = state @ p[f"{way}_state"]
        gates = sigmoid(a[:, : 2 * h] + u[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        c = np.tanh(a[:, 2 * h :] + r * u[:, 2 * h :])
        new = state + z * (c - state) * mask[t][:, None]
        if trace is not None:
            trace.append((t, state, z, r, c, u[:, 2 * h :]))
        state = states[t] = new
    return states


def _logits(p: Arrays, given: Arrays, steps: np.ndarray, keep: bool = False):
    """Logit of every window; `given` has a row for each kind of word and a last one for none."""
    none = len(given["ahead"]) - 1
    mask = (steps != none).astype(np.float32)
    traces: dict[str, list | None] = {way: [] if keep else None for way in WAYS}
    states = np.concatenate([_read(p, way, given[way], steps, mask, traces[way]) for way in WAYS], axis=2)
    raised = np.exp(states @ p["attend"]) * mask
    share = raised / np.maximum(raised.sum(0), 1e-9)
    pooled = np.einsum("tb,tbh->bh", share, states)
    logit = pooled @ p["out"] + p["bias"][0]
    return (logit, states, share, pooled, mask, traces) if keep else logit


def _forward(p: Arrays, inputs: np.ndarray, steps: np.ndarray, keep: bool = False):
    """Logit of every window, from the inputs of each kind of word."""
    padded = np.vstack([inputs, np.zeros((1, inputs.shape[1]), np.float32)])
    found = _logits(p, {way: padded @ p[f"{way}_in"] + p[f"{way}_bias"] for way in WAYS}, steps, keep)
    return (*found, padded) if keep else found


def _gradients(p: Arrays, lexicon: Lexicon, steps: np.ndarray, labels: np.ndarray) -> tuple[Arrays, np.ndarray, np.ndarray]:
    """Gradients of the mean log loss; those of the tables as (row, value) pairs summed by row."""
    inputs = lexicon.inputs(p)
    logit, states, share, pooled, mask, traces, padded = _forward(p, inputs, steps, keep=True)
    h = p["ahead_state"].shape[0]
    error = ((sigmoid(logit) - labels) / len(labels)).astype(np.float32)
    g = {"out": error @ pooled, "bias": error.sum(keepdims=True)}
    d_pooled = error[:, None] * p["out"]
    towards = np.einsum("tbh,bh->tb", states, d_pooled)
    d_score = share * (towards - (share * towards).sum(0))
    g["attend"] = np.einsum("tb,tbh->h", d_score, states)
    d_states = share[:, :, None] * d_pooled + d_score[:, :, None] * p["attend"]
    d_padded = np.zeros_like(padded)
    for way, part in (("ahead", slice(0, h)), ("back", slice(h, 2 * h))):
        d_steps = np.empty((*steps.shape, 3 * h), np.float32)
        g[f"{way}_state"] = np.zeros_like(p[f"{way}_state"])
        d_next = np.zeros((steps.shape[1], h), np.float32)
        for t, before, z, r, c, u in reversed(traces[way]):
            d = d_states[t][:, part] + d_next
            m = mask[t][:, None]
            d_c = d * z * m * (1 - c * c)
            d_z = d * (c - before) * m * z * (1 - z)
            d_r = d_c * u * r * (1 - r)
            d_u = np.hstack([d_z, d_r, d_c * r])
            d_next = d * (1 - z * m) + d_u @ p[f"{way}_state"].T
            g[f"{way}_state"] += before.T @ d_u
            d_steps[t] = np.hstack([d_z, d_r, d_c])
        d_given = np.zeros((len(padded), 3 * h), np.float32)
        rows, sums = sum_rows(steps.ravel(), d_steps.reshape(-1, 3 * h))
        d_given[rows] = sums
        g[f"{way}_in"] = padded.T @ d_given
        g[f"{way}_bias"] = d_given.sum(0)
        d_padded += d_given @ p[f"{way}_in"].T
    d_inputs = d_padded[:-1]
    width = p["word"].shape[1]
    lengths = np.diff(lexicon.bounds)
    return g, d_inputs[:, :width], np.repeat(d_inputs[:, width:] / lengths[:, None], lengths, axis=0)


@dataclass
class Model:
    p: Arrays
    plan: Plan
    sure: float | None = None

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.sure is not None:
            return np.full(len(texts), self.sure)
        data, offsets = utf8(texts)
        words = split(data, offsets)
        found = kinds(data, words)
        lexicon = Lexicon.of(found.raw, found.hash, self.plan)
        first, size, doc = windows(words.per_doc(len(texts)), self.plan)
        given = lexicon.given(self.p)
        logits = np.empty(len(first))
        for at in range(0, len(first), WINDOWS_AT_ONCE):
            part = slice(at, at + WINDOWS_AT_ONCE)
            steps = steps_of(found.which, first[part], size[part], self.plan, len(found.raw))
            logits[part] = _logits(self.p, given, steps)
        return sigmoid(np.maximum.reduceat(logits, np.searchsorted(doc, np.arange(len(texts)))))


def train(texts: list[str], labels: np.ndarray, plan: Plan = Plan()) -> Model:
    p = parameters(plan)
    if len(set(labels.tolist())) < 2:
        return Model(p, plan, 0.5 if not len(labels) else float(0.01 + 0.98 * labels[0]))
    random = np.random.default_rng(plan.seed)
    found, bounds = kinds_of_texts(texts)
    lexicon, which = Lexicon.of(found.raw, found.hash, plan), found.which
    del found  # the words themselves are not needed any more
    first, size, doc = windows(bounds, plan)
    starts = np.searchsorted(doc, np.arange(len(texts) + 1))
    squares = {name: np.full_like(value, 1e-6) for name, value in p.items()}
    rounds = max(plan.rounds, -(-plan.least_steps * plan.batch // len(texts)))
    for round_number in range(rounds):
        if round_number:
            logits = _all_logits(p, lexicon, which, first, size, plan)
            top = np.array([a + int(np.argmax(logits[a:b])) for a, b in zip(starts[:-1], starts[1:], strict=True)])
        else:
            top = starts[:-1] + (random.random(len(texts)) * np.diff(starts)).astype(int)
        other = starts[:-1] + (random.random(len(texts)) * np.diff(starts)).astype(int)
        more = labels == 0 if round_number else np.ones(len(texts), bool)
        chosen = np.concatenate([top, other[more]])
        random.shuffle(chosen)
        rate = plan.rate * (1 - round_number / rounds)
        for at in range(0, len(chosen), plan.batch):
            part = chosen[at : at + plan.batch]
            steps = steps_of(which, first[part], size[part], plan, len(lexicon.word))
            _learn(p, squares, lexicon, steps, labels[doc[part]], len(lexicon.word), rate)
    return Model(p, plan)


def _all_logits(p: Arrays, lexicon: Lexicon, which: np.ndarray, first: np.ndarray, size: np.ndarray, plan: Plan) -> np.ndarray:
    given = lexicon.given(p)
    out = np.empty(len(first), np.float32)
    for at in range(0, len(first), WINDOWS_AT_ONCE):
        part = slice(at, at + WINDOWS_AT_ONCE)
        out[part] = _logits(p, given, steps_of(which, first[part], size[part], plan, len(lexicon.word)))
    return out


def _learn(p: Arrays, squares: Arrays, lexicon: Lexicon, steps: np.ndarray, labels: np.ndarray, none: int, rate: float) -> None:
    """One step with rates that fall with each parameter's summed squared gradients."""
    used, local = np.unique(steps, return_inverse=True)
    local = local.reshape(steps.shape)
    real = used[used != none]
    picked = lexicon.pick(real)
    dense, d_word, d_gram = _gradients(p, picked, local, labels)
    for name, g in dense.items():
        squares[name] += g * g
        p[name] -= rate * g / np.sqrt(squares[name])
    for name, rows, values in (("word", picked.word, d_word), ("gram", picked.grams, d_gram)):
        distinct, g = sum_rows(rows, values)
        squares[name][distinct] += g * g
        p[name][distinct] -= rate * g / np.sqrt(squares[name][distinct])


def held_out() -> Column:
    return fold(F.col("doc_id"), 5) == 0


def fit(docs: DataFrame, labels: DataFrame, plan: Plan = Plan()) -> Model:
    """Learn from the labelled documents outside the held-out fold."""
    texts, wanted = training_sample(docs, labels, "toxic", ~held_out(), plan.sample, plan.sample_chars, plan.seed, 0.45)
    model = train(texts, wanted, plan)
    del texts, wanted
    give_back()
    return model


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (1: toxic) and predicted for every document's whole text."""
    return verdicts(docs, model.score, held_out())


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a score below 0.5, with all their columns."""
    return scored(docs, model.score).where("score < 0.5").select("record.*")
