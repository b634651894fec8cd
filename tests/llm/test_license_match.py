import re

import pytest
from navloom.llm.license_match import TEMPLATES, Scanner, Template, labelled, scan

from tests.llm.data import documents, odd_texts


def scanned(spark, texts, templates=TEMPLATES):
    return [r.asDict(recursive=True) for r in scan(documents(spark, texts), templates).orderBy("doc_id").collect()]


def expression(markup):
    """The template as a regular expression over words with a space on both sides."""
    out = []
    for token in re.findall(r"\[|\]|\||\{\w+:\d+-\d+\}|\w+", markup):
        if token in "[]|":
            out.append({"[": "(?:", "]": ")?", "|": "|"}[token])
        elif token[0] == "{":
            low, high = re.findall(r"\d+", token)[-2:]
            out.append(f"(?: [^ ]+ ){{{low},{high}}}")
        else:
            out.append(f" {token} ")
    return "".join(out)


MIT = """MIT License

Copyright (c) 2021 Some Person

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
"""
NOTICES = [
    "Released under the MIT License.",
    "a Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0. You may use it in compliance with the License",
    "This work is licensed under the GNU General Public License, version 3.",
    MIT,
    MIT.replace("without restriction", "with restriction"),
    MIT.replace("software and associated", "work, data and associated"),
    "under the MIT License under the mit-license UNDER THE MIT LICENSE",
    "under\x00the mit license",
    "apache license version 2 cc by nc under the mit licenses",
    "This nice old thing is licensed under a Creative Commons CC-BY-NC 3 0 1",
    "GNU Lesser General Public License as published by the Free Software Foundation",
]


def test_places_are_those_of_regular_expressions(spark):
    texts = [*odd_texts(), *NOTICES, " ".join(NOTICES) * 40]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, row in zip(texts, scanned(spark, texts), strict=True):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        line = "".join(f" {w} " for w in words)
        want = []
        for number, template in enumerate(TEMPLATES):
            for met in re.finditer(expression(template.markup), line):
                start = line[: met.start()].count(" ") // 2
                want.append((number, start, met.group().count(" ") // 2))
        got = sorted((p["template"], p["start"], p["words"]) for p in row["places"])
        assert got == sorted(want), text
        assert row["n_words"] == len(words)


def test_labels_counts_and_score(spark):
    rows = labelled(scan(documents(spark, [*NOTICES, None, "", "no license"], ", labels string, places string", ("x", "y")))).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == [
        "mit", "cc-by-nc", "apache-2", "gpl-3", "mit", "", "mit", "mit", "", "apache-2,cc-by-nc", "cc-by-nc", "lgpl", "", "", ""
    ]
    assert [r.base_labels for r in rows] == ["mit", "cc-by-nc", "apache-2", "", "", "", "", "mit", "", "apache-2,cc-by-nc", "cc-by-nc", "", "", "", ""]
    seven = rows[7]
    assert (seven.n_words, seven.n_base, seven.first_word, seven.last_word) == (12, 3, 0, 8)
    assert (rows[3].n_base, rows[3].first_word, rows[3].last_word, rows[3].score) == (0, None, None, 1.0)
    assert rows[0].score == 4 / 5 and rows[-1].score == rows[-2].score == rows[-3].score == 0.0


def test_regions_nest_and_an_exact_word_is_demanded(spark):
    own = (Template("own", "[see [the] {what:1-2}] copy may be made [if {who:0-3} agrees] freely"),)
    texts = [
        "copy may be made freely", "see the book copy may be made freely", "see a big book copy may be made freely",
        "copy may be made if freely", "copy may be made if agrees freely", "copy may be made if he and she agrees freely",
        "copy may be made if he and she really agrees freely", "copy may made freely", "copy may be made freel",
    ]
    assert [[(p["start"], p["words"]) for p in r["places"]] for r in scanned(spark, texts, own)] == [
        [(0, 5)], [(0, 8)], [(4, 5)], [], [(0, 7)], [(0, 10)], [], [], []
    ]


@pytest.mark.parametrize("markup", ["copy may [be] made", "[a copy", "copy may be {x:3-1}", "two words"])
def test_wrong_markup_is_an_error(markup):
    with pytest.raises(ValueError):
        Scanner((Template("x", markup),))


def test_an_empty_table_gives_no_rows(spark):
    assert labelled(scan(documents(spark, []).where("false"))).collect() == []
