"""Runs of repeated words, found online by square catchers over completed power-of-two blocks.

Words are appended to a stream. Whenever 2^k words fill an aligned block, that block gets a catcher.
Every further word completes one suffix of 2^k words, and the suffix is compared with the blocks that
lie 2 * 2^k to 4 * 2^k words back (by hashes of windows, each made of two of the level below). A
square of period p has a whole block of the level 2 * 2^k <= p < 4 * 2^k in its first half, so its
second half meets exactly that catcher, at distance p; level 0 also takes periods 1 to 3. What a
catcher reports are squares at (block, period); adjacent ones of a period merge into chains, and the
ends of a chain lie less than a block further out, found by halving. Chains are runs; a run met with
multiples of its smallest period has the same ends each time, so the smallest period stays.

Work is n log n comparisons of numbers, in numpy over all texts of a slice, and memory is one 64-bit
number per word and level. Reported runs are checked on the words themselves.

Defined results: words are maximal stretches without white space (0x20, 0x09-0x0D) and are compared as
bytes; a null or empty text, or one of white space alone, has no words, no runs and an empty collapsed
text; rows with equal or null ids are told apart by nothing and give a row each; an empty table gives
no rows; columns besides id and text are not read. A text of any length is one row in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from navloom.llm.shared import mix64, sliced, utf8
from navloom.llm.words import SAME, split

#: A run holds its period at least so often, and at least so many words.
TIMES = 4
SHORTEST = 6

_PAIR = np.uint64(0xA0761D6478BD642F)


class Catchers:
    """A stream of words, given by their hashes, and the squares caught in it so far."""

    def __init__(self, times: int = TIMES, shortest: int = SHORTEST):
        if times < 2:
            raise ValueError("a run holds its period at least twice")
        self.times, self.shortest = times, shortest
        self.windows = [np.zeros(0, np.uint64)]
        self.first = np.zeros(0, np.int64)
        self.squares: list[list[tuple[np.ndarray, np.ndarray]]] = [[]]

    def append(self, words: np.ndarray, first: np.ndarray) -> None:
        """Further words; `first` tells for each where in the stream its text begins."""
        old = len(self.first)
        self.first = np.concatenate([self.first, first])
        self.windows[0] = np.concatenate([self.windows[0], words])
        longest = int((np.arange(len(self.first)) - self.first).max(initial=-1)) + 1
        level = 0
        while level == 0 or self.times << (level + 1) <= longest:
            if level:
                self._complete(level)
            self._compare(level, old)
            level += 1

    def _complete(self, level: int) -> None:
        """Hashes of the windows of this level whose last word has come."""
        if len(self.windows) == level:
            self.windows.append(np.zeros(0, np.uint64))
            self.squares.append([])
        half, known, end = 1 << (level - 1), len(self.windows[level]), len(self.first) - (1 << level) + 1
        below = self.windows[level - 1]
        new = mix64(below[known:end] * _PAIR + below[known + half : end + half])
        self.windows[level] = np.concatenate([self.windows[level], new])

    def _compare(self, level: int, old: int) -> None:
        """Suffixes completed by words from `old` on, against the catchers in reach."""
        block, window = 1 << level, self.windows[level]
        suffix = np.arange(max(0, self._compared(level, old)), len(window))
        whole = self.first[suffix + block - 1] <= suffix
        for back in (1, 2, 3) if level == 0 else (2, 3):
            caught = ((suffix >> level) - back) << level
            met = whole & (caught >= self.first[suffix])
            met &= window[suffix] == window[np.maximum(caught, 0)]
            if met.any():
                self.squares[level].append((caught[met], (suffix - caught)[met]))

    def _compared(self, level: int, old: int) -> int:
        """The first suffix of a level not compared before: all of them while no text was long enough for it."""
        longest = int((np.arange(old) - self.first[:old]).max(initial=-1)) + 1
        return old - (1 << level) + 1 if level == 0 or self.times << (level + 1) <= longest else 0

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and smallest period of every run in what was appended, by start, then period."""
        begin = np.flatnonzero(np.diff(self.first, prepend=-1))
        ends = np.append(begin[1:], len(self.first))
        found = [self._merged(level, begin, ends) for level in range(len(self.squares))]
        start, end, period = (np.concatenate(side) for side in zip(*found, strict=True))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        start, end, period = start[new], end[new], period[new]
        order = np.lexsort((period, start))
        return start[order], end[order], period[order]

    def _merged(self, level: int, begin: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The squares of a level as runs: chains of adjacent blocks with their ends."""
        none = np.zeros(0, np.int64)
        if not self.squares[level]:
            return none, none, none
        block = 1 << level
        caught, period = (np.concatenate(side) for side in zip(*self.squares[level], strict=True))
        order = np.lexsort((caught, period))
        caught, period = caught[order], period[order]
        new = np.ones(len(caught), bool)
        new[1:] = (period[1:] != period[:-1]) | (caught[1:] != caught[:-1] + block)
        heads = np.flatnonzero(new)
        left, period = caught[heads], period[heads]
        right = caught[np.append(heads[1:], len(caught)) - 1] + block
        # Of the equal stretch, less than a block lies outside of the chain on either side.
        long = right - left + 2 * (block - 1) + period >= np.maximum(self.shortest, self.times * period)
        left, right, period = left[long], right[long], period[long]
        text = np.searchsorted(begin, left, side="right") - 1
        lowest, highest = begin[text], ends[text]
        for j in range(level - 1, -1, -1):
            step, window = 1 << j, self.windows[j]
            ahead = right + period + step <= highest
            at = np.where(ahead, right, 0)
            right = right + step * (ahead & (window[at] == window[np.where(ahead, right + period, 0)]))
            behind = left - step >= lowest
            at = np.where(behind, left - step, 0)
            left = left - step * (behind & (window[at] == window[np.where(behind, left - step + period, 0)]))
        right = right + period
        good = right - left >= np.maximum(self.shortest, self.times * period)
        return left[good], right[good], period[good]


def _found(times: int, shortest: int):
    """For mapInArrow: (doc_id, text) to (doc_id, n_words, runs, collapsed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            data, offsets = utf8(batch.column("text"))
            words = split(data, offsets, letters=SAME)
            bounds = words.per_doc(batch.num_rows)
            catchers = Catchers(times, shortest)
            catchers.append(words.hash, bounds[words.doc])
            start, end, period = catchers.runs()
            doc = words.doc[start]
            ranges = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            local = start - bounds[doc]
            raw = data.tobytes()
            texts = []
            for i in range(batch.num_rows):
                own = raw[offsets[i] : offsets[i + 1]].split()
                if ranges[i] < ranges[i + 1]:
                    of = slice(ranges[i], ranges[i + 1])
                    own = _collapsed(own, local[of].tolist(), (end - start)[of].tolist(), period[of].tolist())
                texts.append(b" ".join(own))
            runs = pa.StructArray.from_arrays(
                [pa.array(local), pa.array(end - start), pa.array(period)], names=["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(ranges.astype(np.int32)), runs),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def _collapsed(words: list[bytes], starts: list[int], lengths: list[int], periods: list[int]) -> list[bytes]:
    """The words without what any run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in zip(starts, lengths, periods, strict=True):
        if words[start : start + length - period] != words[start + period : start + length]:
            raise ValueError("two different words have one 64-bit hash")
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def find(docs: DataFrame, times: int = TIMES, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (start, length and smallest period, by start, then period) and collapsed text.

    A run is a stretch of at least max(shortest, times * period) words that no neighbouring word
    extends; the collapsed text keeps only the first period of each, words joined by one space.
    """
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(_found(times, shortest), schema)
