"""License scans: templates with optional and replaceable regions, matched as automata over words.

A template is wording in which `[...]` may be left out (regions nest) and `{name:a-b}` stands for any
a to b words. Its words, lower-cased, become the states of an automaton; leaving a region out becomes
arcs around it, a replaceable region a chain of states that take any word. A text is accepted from a
word on if the automaton gets through, that is if all mandatory wording stands there exactly, in
order; the longest way through is the place. Automata are made deterministic as they run: a set of
states and a word lead to a set that is remembered.

Words are maximal stretches of bytes other than 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F after lower-casing
A-Z, so punctuation, markup and line breaks between words never matter. Places are sought only where
the first three mandatory words of a template stand, which numpy finds for a whole slice at once; an
optional beginning is read backwards from there. Every place is reported: of a template there is one
from each word where its mandatory wording begins.

Defined results: a null or empty text has no words, no places, no labels and score 0; the score is the
share of a text's words in its longest place; rows with equal or null ids give a row each; an empty
table gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.shared import sliced, utf8
from navloom.llm.words import LOWER, split

ANCHOR = 3
#: Remembered steps of an automaton; beyond them it starts to remember anew.
STEPS_MOST = 1 << 16

#: Bytes between words, before lower-casing.
BETWEEN = np.ones(256, bool)
BETWEEN[0x80:] = BETWEEN[ord("0") : ord("9") + 1] = BETWEEN[ord("a") : ord("z") + 1] = BETWEEN[ord("A") : ord("Z") + 1] = False


@dataclass(frozen=True)
class Template:
    """`base` templates are plain phrases whose places are counted of their own."""

    label: str
    markup: str
    base: bool = False


# The wording of public licenses and of the notices that name them.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "[released | licensed] under the terms of the mit license"),
    Template(
        "mit",
        "[the mit license [mit]] [copyright {holder:1-12}] permission is hereby granted free of charge to any person obtaining a copy"
        " of this {what:1-6} and associated documentation files the software to deal in the software without restriction"
        " including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of"
        " the software and to permit persons to whom the software is furnished to do so subject to the following conditions"
        " the above copyright notice and this permission notice [including the next paragraph] shall be included in all copies or"
        " substantial portions of the software [the software is provided as is without warranty of any kind express or implied]",
    ),
    Template(
        "isc",
        "[isc license] [copyright {holder:1-12}] permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted [provided that the above copyright notice and this permission notice appear in all copies]",
    ),
    Template(
        "bsd",
        "[copyright {holder:1-12}] redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
    ),
    Template("apache-2", "licensed under the apache license version 2 0 [the license {rest:0-20} compliance with the license]"),
    Template(
        "gpl-2",
        "[[this work is] [licensed] under the [terms of the]] gnu general public license [as published by the free software foundation]"
        " [either] version 2 [of the license] [or at your option any later version]",
    ),
    Template(
        "gpl-3",
        "[[this work is] [licensed] under the [terms of the]] gnu general public license [as published by the free software foundation]"
        " [either] version 3 [of the license] [or at your option any later version]",
    ),
    Template("lgpl", "[under the [terms of the]] gnu lesser general public license [as published by the free software foundation]"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    Template("mpl-2", "mozilla public license version 2 0"),
    Template("cc-by-nc", "[[this {what:1-3} is] licensed under [a | the] [creative commons]] cc by nc {version:0-2}"),
    Template(
        "cc-by-nc",
        "[this {what:1-3} is] [licensed under a] creative commons attribution noncommercial {version:0-2} [international] license",
    ),
    Template("cc-by", "creative commons attribution {version:0-2} [international] license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


def _parsed(markup: str) -> list:
    """Words, ("any", a, b) and ("or", [[...], ...]) of a template's markup; `[x]` is x or nothing, `[x | y]` x, y or nothing."""
    tokens = re.findall(r"\[|\]|\||\{\w+:\d+-\d+\}|[0-9a-z\u0080-\U0010ffff]+|\S", markup.lower())
    stack: list[list[list]] = [[[]]]
    for token in tokens:
        if token == "[":
            stack.append([[]])
        elif token == "|" and len(stack) > 1:
            stack[-1].append([])
        elif token == "]" and len(stack) > 1:
            ways = stack.pop()
            stack[-1][-1].append(("or", [[], *ways]))
        elif token[0] == "{" and len(token) > 1:
            low, high = re.findall(r"\d+", token)[-2:]
            if int(low) > int(high):
                raise ValueError(f"not a region of words: {token}")
            stack[-1][-1].append(("any", int(low), int(high)))
        elif re.fullmatch(r"[0-9a-z\u0080-\U0010ffff]+", token):
            stack[-1][-1].append(token)
        else:
            raise ValueError(f"not template markup: {token} in {markup!r}")
    if len(stack) != 1:
        raise ValueError(f"a region is not closed in {markup!r}")
    return stack[0][0]


def _reversed(parts: list) -> list:
    return [(p[0], [_reversed(way) for way in p[1]]) if isinstance(p, tuple) and p[0] == "or" else p for p in reversed(parts)]


ANY = -1


class Automaton:
    """States are numbers of bits; `run` goes as far as there is a way and tells the longest accepted length."""

    def __init__(self, parts: list, vocabulary: dict[str, int]):
        self.takes: list[int] = []
        self.follow: list[int] = []
        ends, self.empty = self._laid(parts, [], True, vocabulary)
        self.last = 0
        for state in ends:
            self.last |= 1 << state
        self.steps: dict[tuple[int, int], int] = {}

    def _laid(self, parts: list, ends: list[int], at_start: bool, vocabulary: dict[str, int]) -> tuple[list[int], bool]:
        """Add the parts behind the states `ends`; the new ends, and whether the start is one of them."""
        if not hasattr(self, "start"):
            self.start = 0
        for part in parts:
            if isinstance(part, str):
                ends, at_start = [self._state(vocabulary.setdefault(part, len(vocabulary) + 1), ends, at_start)], False
            elif part[0] == "any":
                for i in range(part[2]):
                    state = self._state(ANY, ends, at_start)
                    ends, at_start = (ends + [state], at_start) if i >= part[1] else ([state], False)
            else:
                ways = [self._laid(way, ends, at_start, vocabulary) for way in part[1]]
                ends = sorted({state for way, _ in ways for state in way})
                at_start = any(start for _, start in ways)
        return ends, at_start

    def _state(self, word: int, before: list[int], at_start: bool) -> int:
        state = len(self.takes)
        self.takes.append(word)
        self.follow.append(0)
        for earlier in before:
            self.follow[earlier] |= 1 << state
        if at_start:
            self.start |= 1 << state
        return state

    def _step(self, states: int, word: int) -> int:
        """States that can have taken `word`, of the given ones."""
        known = self.steps.get((states, word))
        if known is None:
            known, rest = 0, states
            while rest:
                bit = rest & -rest
                if self.takes[bit.bit_length() - 1] in (ANY, word):
                    known |= bit
                rest ^= bit
            if len(self.steps) >= STEPS_MOST:
                self.steps.clear()
            self.steps[states, word] = known
        return known

    def _after(self, taken: int) -> int:
        known = self.steps.get((taken, ANY))
        if known is None:
            known, rest = 0, taken
            while rest:
                bit = rest & -rest
                known |= self.follow[bit.bit_length() - 1]
                rest ^= bit
            self.steps[taken, ANY] = known
        return known

    def run(self, words: list[int], at: int, end: int, step: int = 1) -> int:
        """Words of the longest accepted stretch from `at` on (towards `end`), 0 for the empty one, -1 for none."""
        longest, states, place = (0 if self.empty else -1), self.start, at
        while states and place != end:
            taken = self._step(states, words[place])
            if not taken:
                break
            place += step
            if taken & self.last:
                longest = abs(place - at)
            states = self._after(taken)
        return longest


@dataclass
class Scanner:
    """All templates over one vocabulary of words; word 0 is any other."""

    templates: tuple[Template, ...] = TEMPLATES
    vocabulary: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.anchors: dict[tuple[int, ...], list[int]] = {}
        self.heads, self.bodies = [], []
        for number, template in enumerate(self.templates):
            parts = _parsed(template.markup)
            fixed = next((i for i, p in enumerate(parts) if isinstance(p, str)), len(parts))
            first = parts[fixed : fixed + ANCHOR]
            if len(first) < ANCHOR or not all(isinstance(p, str) for p in first):
                raise ValueError(f"{ANCHOR} mandatory words must follow an optional beginning: {template.markup!r}")
            self.heads.append(Automaton(_reversed(parts[:fixed]), self.vocabulary) if fixed else None)
            self.bodies.append(Automaton(parts[fixed:], self.vocabulary))
            self.anchors.setdefault(tuple(self.vocabulary[w] for w in first), []).append(number)
        words = list(self.vocabulary)
        data, offsets = utf8(pa.array(words, pa.large_string()))
        hashes = split(data, offsets, BETWEEN).hash
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.append(np.arange(1, len(words) + 1)[order], 0)
        self.size = len(words) + 1
        codes = np.array([self._code(*(np.array([w]) for w in a))[0] for a in self.anchors])
        order = np.argsort(codes)
        self.codes, self.of_code = codes[order], [list(self.anchors.values())[i] for i in order.tolist()]

    def _code(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (a.astype(np.int64) * self.size + b) * self.size + c

    def places(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
        """The n + 1 word offsets of the texts, and (text, template, first word, words) of each place."""
        found = split(data, offsets, BETWEEN)
        bounds = found.per_doc(len(offsets) - 1)
        at = np.searchsorted(self.hashes, found.hash)
        words = self.numbers[np.where(self.hashes[np.minimum(at, len(self.hashes) - 1)] == found.hash, at, len(self.hashes))]
        if len(words) < ANCHOR:
            return bounds, []
        codes = self._code(words[:-2], words[1:-1], words[2:])
        code = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        starts = np.flatnonzero((self.codes[code] == codes) & (found.doc[:-2] == found.doc[2:]))
        out = []
        numbers = words.tolist() if len(starts) else []
        for start, which in zip(starts.tolist(), code[starts].tolist(), strict=True):
            doc = int(found.doc[start])
            low, high = int(bounds[doc]), int(bounds[doc + 1])
            for number in self.of_code[which]:
                after = self.bodies[number].run(numbers, start, high)
                if after <= 0:
                    continue
                head = self.heads[number]
                before = head.run(numbers, start - 1, low - 1, -1) if head else 0
                if before < 0:
                    continue
                out.append((doc, number, start - before - low, before + after))
        return bounds, out


def _scanned(templates: tuple[Template, ...]):
    """For mapInArrow: (doc_id, text) to (doc_id, n_words, places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in sliced(batches):
            bounds, places = scanner.places(*utf8(batch.column("text")))
            rows: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for doc, number, start, words in places:
                template = templates[number]
                rows[doc].append({"label": template.label, "base": template.base, "template": number, "start": start, "words": words})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(rows, _PLACES)], names=["doc_id", "n_words", "places"]
            )

    return run


_PLACES = pa.list_(
    pa.struct(
        [("label", pa.string()), ("base", pa.bool_()), ("template", pa.int32()), ("start", pa.int64()), ("words", pa.int64())]
    )
)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words and places (label, base, template, start and words, by start) of every document."""
    schema = "doc_id long, n_words long, places array<struct<label: string, base: boolean, template: int, start: long, words: long>>"
    return docs.select("doc_id", "text").mapInArrow(_scanned(templates), schema)


def labelled(scanned: DataFrame) -> DataFrame:
    """Places as counts, sorted labels and a score per document."""
    base = F.filter("places", lambda p: p["base"])
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    longest = F.array_max(F.transform("places", lambda p: p["words"]))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.when(F.size("places") > 0, longest / F.col("n_words").cast("double")).otherwise(F.lit(0.0)).alias("score"),
    )
