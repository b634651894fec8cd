"""Concatenate and cut: all documents as one stream of tokens, cut into windows of fixed length.

Pass one tokenizes every partition, stores its ids and sums them; a prefix sum over the partitions'
totals gives each partition its place in the stream, and the running total inside the partition each
document. Pass two cuts the stream at every multiple of the length. A window inside a partition is
whole there; a window across partitions is the sum of the boundary pieces of both.

Defined results: a null or empty text has no ids of its own, so it is just the end id; rows with
equal or null keys stay separate documents; an empty table gives no pieces; columns besides key and
text are not read. Only the last window can be shorter than the length.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navloom.llm.shared import keep, sliced, utf8
from navloom.llm.words import split

END_ID = 1
LENGTH = 2048
#: Word parts a task remembers the ids of; more are tokenized again.
REMEMBERED = 1_000_000
#: Text handled at a time; smaller than elsewhere, as a worker also holds the vocabulary and what it remembers.
SLICE_BYTES = 1 << 19
#: Partitions whose totals may be broadcast (16 bytes each).
BROADCAST_PARTITIONS = 1_000_000

#: Bytes of marks: the tokenizer never joins tokens across the border of letters and marks behind them.
MARK = np.zeros(256, bool)
MARK[list(b".,;:!?$%&*#|()-")] = True
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Letters of two bytes in UTF-8, by code point, that normalizing and lower-casing leave letters.
TWO_BYTE_LETTER = np.array(
    [c >= 0x80 and all(x.isalpha() for x in (chr(c), unicodedata.normalize("NFC", chr(c)).lower())) for c in range(0x800)]
)


def _byte_characters() -> str:
    """The printable character that byte-level tokenizers write for each byte, as a 256-long string."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in printable else chr(next(others)) for b in range(256))


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters of one or two bytes; longer ones are not looked up."""
    letter = ASCII_LETTER[data]
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xDF))
    lead = lead[TWO_BYTE_LETTER[((data[lead] & 0x1F).astype(np.int32) << 6) | (data[lead + 1] & 0x3F)]]
    letter[lead] = letter[lead + 1] = True
    return letter


def before_marks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where words of letters alone and marks behind them are cut, so that fewer words are different."""
    behind = np.where(MARK[data], 0, np.arange(1, len(data) + 1, dtype=np.int32))
    core = np.maximum(np.maximum.accumulate(behind)[end - 1], start)
    other = np.zeros(len(data) + 1, np.int32)
    np.cumsum(~_letters(data), out=other[1:])
    return core[(core > start) & (core < end) & (other[core] == other[start])]


class WordIds:
    """Token ids of words split at white space and before marks, remembered by the word's hash.

    White space never joins two tokens of this tokenizer and is dropped, and letters are lower-cased,
    so a text's ids are its words' ids in order. Texts holding a special token's string are
    tokenized as a whole. What is remembered lies in arrays: `keys` are sorted hashes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.to_byte_characters = dict(enumerate(_byte_characters()))
        self.normalizer, self.model = self.tokenizer.normalizer, self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        if not word.isalpha():
            return self.whole(word)
        if word.isascii():
            normal = word.lower()
        else:
            normal = self.normalizer.normalize_str(word)
            if not normal.isalpha():
                return self.whole(word)
            normal = normal.encode().decode("latin-1").translate(self.to_byte_characters)
        return [t.id for t in self.model.tokenize(normal)]

    def _learn(self, hashes: np.ndarray, words: Iterator[str]) -> None:
        """Words that are not known yet, by ascending hash."""
        found = [self._word(word) for word in words]
        length = np.fromiter(map(len, found), np.int32, len(found))
        used = self.used + int(length.sum())
        if used > len(self.ids):
            self.ids = np.resize(self.ids, max(used, len(self.ids) * 3 // 2))
        self.ids[self.used : used] = np.fromiter(chain.from_iterable(found), np.uint32, used - self.used)
        at = np.searchsorted(self.keys, hashes)
        self.start = np.insert(self.start, at, self.used + np.cumsum(length) - length)
        self.length = np.insert(self.length, at, length)
        self.keys = np.insert(self.keys, at, hashes)
        self.used = used

    def _unknown(self, kinds: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(kinds), bool)
        at = np.searchsorted(self.keys, kinds)
        return self.keys[np.minimum(at, len(self.keys) - 1)] != kinds

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the n + 1 offsets of each text's ids."""
        data, offsets = utf8(texts)
        words = split(data, offsets, cuts=before_marks)
        if len(self.keys) > REMEMBERED:
            self._forget()
        kinds, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        new = self._unknown(kinds)
        raw, at = data.tobytes(), first[new]
        spans = zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)
        self._learn(kinds[new], (raw[a:b].decode() for a, b in spans))
        place = np.searchsorted(self.keys, kinds)[which]
        start, length = self.start[place], self.length[place]
        ends = np.cumsum(length, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(start - (ends - length), length)]
        bounds = np.concatenate([[0], ends])[words.per_doc(len(offsets) - 1)]
        return ids, bounds


_encoders: dict[str, WordIds] = {}


def token_ids(path: str):
    """For mapInArrow over (key, text): the ids of each document with the end id, and its place in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(path) or _encoders.setdefault(path, WordIds(path))
        partition, before = TaskContext.get().partitionId(), 0
        for batch in sliced(batches, limit=SLICE_BYTES):
            texts = batch.column("text")
            ids, bounds = encoder.encode(texts)
            documents = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            raw = utf8(texts)[0].tobytes()
            if any(s in raw for s in encoder.special):
                for i, text in enumerate(texts.to_pylist()):
                    if text and any(s.decode() in text for s in encoder.special):
                        documents[i] = np.array(encoder.whole(text), np.uint32)
            end = np.array([END_ID], "<u4").tobytes()
            packed = [d.astype("<u4").tobytes() + end for d in documents]
            counts = np.array([len(p) // 4 for p in packed], np.int64)
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(packed, pa.binary()),
                    pa.array(counts),
                    pa.array(np.full(len(packed), partition, np.int32)),
                    pa.array(starts),
                ],
                names=["key", "ids", "tokens", "part", "before"],
            )

    return run


def tokenized(records: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored table of each document's ids (little-endian 32-bit), count, partition and place in it."""
    given = records.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = given.schema["key"].dataType.simpleString()
    schema = f"key {kind}, ids binary, tokens long, part int, before long"
    return keep(given.mapInArrow(token_ids(tokenizer), schema), "tokens")


def pieces(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Cut the stream of stored token tables: a row for each document in each window.

    key, start (ids of its document before it), size, ids, doc_tokens, sequence_id, offset (in the
    window) and boundary (the window continues in another partition).
    """
    totals = documents.groupBy("part").agg(F.sum("tokens").alias("total"))
    above = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    first = totals.select("part", "total", F.coalesce(F.sum("total").over(above), F.lit(0)).alias("first"))
    if totals.count() <= BROADCAST_PARTITIONS:
        first = F.broadcast(first)
    placed = documents.join(first, "part").withColumn("at", F.col("first") + F.col("before"))
    window = F.explode(
        F.sequence(F.expr(f"at div {length}"), F.expr(f"(at + tokens - 1) div {length}"))
    ).alias("sequence_id")
    cut = placed.select("key", "ids", "tokens", "at", "first", "total", window)
    opens, closes = F.col("sequence_id") * length, (F.col("sequence_id") + 1) * length
    start = F.greatest(F.lit(0), opens - F.col("at"))
    size = F.least(F.col("tokens"), closes - F.col("at")) - start
    return cut.select(
        "key",
        start.alias("start"),
        size.alias("size"),
        F.substring("ids", (start * 4 + 1).cast("int"), (size * 4).cast("int")).alias("ids"),
        F.col("tokens").alias("doc_tokens"),
        "sequence_id",
        F.greatest(F.lit(0), F.col("at") - opens).alias("offset"),
        ((opens < F.col("first")) | (closes > F.col("first") + F.col("total"))).alias("boundary"),
    )


def sequences(cut: DataFrame) -> DataFrame:
    """The windows themselves: sequence_id, ids of its pieces in order, tokens. A window is the bound of a group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda left, part: F.concat(left, part["ids"]))
    return cut.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("size").alias("tokens"))
