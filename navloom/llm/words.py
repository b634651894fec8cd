"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from navloom.llm.shared import POWERS as _powers
from navloom.llm.shared import mix64, sliced, utf8

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SAME = np.arange(256, dtype=np.uint8)
#: A random value for each byte, and an odd multiplier for positions: a word's hash is the sum of
#: value x multiplier^place modulo 2^64, mixed afterwards.
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
STEP = 0x9E3779B97F4A7C15 | 1


def _power_table(length: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP^i and STEP^-i modulo 2^64 for i below `length`, kept for the next batch."""
    if len(_powers.get("up", ())) < length:
        size = max(length, min(1 << (length - 1).bit_length(), 1 << 21))
        for name, base in (("up", STEP), ("down", pow(STEP, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    up, down = _powers["up"][:length], _powers["down"][:length]
    if len(_powers["up"]) > 1 << 23:  # a very long text: do not hold on to its tables
        _powers.clear()
    return up, down


@dataclass
class Words:
    """Words of n texts in order: byte range, text number and hash of each."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    def per_doc(self, docs: int) -> np.ndarray:
        """The n + 1 offsets of each text's words."""
        return np.searchsorted(self.doc, np.arange(docs + 1))


def split(
    data: np.ndarray,
    offsets: np.ndarray,
    between: np.ndarray = SPACE,
    letters: np.ndarray = LOWER,
    cuts: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> Words:
    """Maximal runs of bytes that are not `between` words (white space 0x20, 0x09-0x0D), of each text.

    Hashes are of the bytes as `letters` maps them: A-Z lower-cased, or all as they are with `SAME`.
    `cuts` takes the bytes, starts and ends of the runs and tells places inside runs where they are divided.
    """
    size = len(data)
    if size == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64))
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    solid = ~between[data]
    before = np.empty(size, bool)
    before[0] = True
    before[1:] = ~solid[:-1]
    start = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.empty(size, bool)
    after[-1] = True
    after[:-1] = ~solid[1:]
    end = np.flatnonzero(solid & (after | edge[1:])) + 1
    if cuts is not None:
        inside = cuts(data, start, end)
        start, end = (np.sort(np.concatenate([x, inside]), kind="stable") for x in (start, end))
    up, down = _power_table(size)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(BYTE_VALUE[letters[data]] * up, dtype=np.uint64, out=total[1:])
    value = (total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(start, end, doc, mix64(value))


#: Text of a training sample handled at a time; small, as the driver's memory holds all else of the session.
LEARNT_BYTES = 1 << 18


@dataclass
class Kinds:
    """The distinct words of some texts, with which of them each word is."""

    raw: list[str]
    hash: np.ndarray
    which: np.ndarray


#: What is added to a word's hash when it begins with a capital, or holds other capitals.
CAPITALS = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def kinds(data: np.ndarray, words: Words) -> Kinds:
    """Distinct words, told apart by letters and by none, one initial or other capitals A-Z."""
    if not len(words.hash):
        return Kinds([], words.hash, np.zeros(0, np.int64))
    upper = LOWER[data] != data
    seen = np.concatenate([[0], np.cumsum(upper)])
    capitals = seen[words.end] - seen[words.start]
    shape = np.where(capitals == 0, 0, np.where((capitals == 1) & upper[words.start], 1, 2))
    found, first, which = np.unique(words.hash + CAPITALS[shape], return_index=True, return_inverse=True)
    raw = data.tobytes()
    spans = zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)
    return Kinds([raw[a:b].decode(errors="replace") for a, b in spans], mix64(found), which)


def character_ngrams(words: list[str], shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the words, each between a begin and an end mark, and whose each is."""
    length = np.array([len(w) for w in words], np.int64) + 2
    end = np.cumsum(length)
    code = np.zeros(int(end[-1]) if len(end) else 0, np.uint64)
    inner = np.ones(len(code), bool)
    code[end - length], code[end - 1] = 2, 3
    inner[end - length] = inner[end - 1] = False
    code[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(words)), length)
    hashes, owners = [], []
    for n in range(shortest, longest + 1):
        if len(code) < n:
            continue
        last = len(code) - n + 1
        value = np.full(last, n, np.uint64)
        for j in range(n):
            value = value * np.uint64(0x100000001B3) + code[j : j + last]
        inside = owner[:last] == owner[n - 1 :]
        hashes.append(mix64(value[inside]))
        owners.append(owner[:last][inside])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def kinds_of_texts(texts: list[str]) -> tuple[Kinds, np.ndarray]:
    """The distinct words of many texts and the n + 1 offsets of each text's words.

    Texts are read in slices of `LEARNT_BYTES`, and a word that an earlier slice had is not kept again.
    """
    given = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
    raw: list[str] = []
    distinct, number = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted hashes, and which came when
    which, counts = [], []
    for part in sliced(iter([given]), limit=LEARNT_BYTES):
        data, offsets = utf8(part.column("text"))
        words = split(data, offsets)
        found = kinds(data, words)
        at = np.searchsorted(distinct, found.hash)
        new = np.append(distinct, np.uint64(0))[at] != found.hash
        new |= at == len(distinct)
        fresh = np.flatnonzero(new)
        came = np.empty(len(new), np.int32)
        came[~new] = number[at[~new]]
        came[fresh] = len(raw) + np.arange(len(fresh))
        raw += [found.raw[i] for i in fresh.tolist()]
        fresh = fresh[np.argsort(found.hash[fresh])]
        distinct = np.insert(distinct, at[fresh], found.hash[fresh])
        number = np.insert(number, at[fresh], came[fresh])
        which.append(came[found.which])
        counts.append(np.diff(words.per_doc(part.num_rows)))
    place = np.empty(len(number), np.int32)
    place[number] = np.arange(len(number), dtype=np.int32)
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    return Kinds([raw[i] for i in number.tolist()], distinct, place[np.concatenate(which)]), bounds
