import hashlib
import random
import zlib

import numpy as np
import pytest
from navloom.llm import periodic_runs, queries
from navloom.llm.periodic_runs import Catchers

from tests.llm.data import documents, odd_texts


def runs_of(words, times=4, shortest=6):
    """Every period tried at every place."""
    n, found = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(shortest, times * p):
                found.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def planted(words, doc_id):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def streams():
    rng = random.Random(5)
    for size in (1, 5, 6, 7, 30, 130, 700):
        for letters in (1, 2, 3, 50):
            yield [rng.randrange(letters) for _ in range(size)]
    for p in (1, 2, 3, 5, 17, 64, 100):
        base = [rng.randrange(9) for _ in range(p)]
        yield [7, 8] + base * 5 + base[: p // 2] + [9] + base * 4
        yield base * 9


def caught(words, cuts=(), times=4, shortest=6):
    hashes = np.random.default_rng(1).integers(1, 2**63, 1000).astype(np.uint64)[np.array(words, int)]
    catchers = Catchers(times, shortest)
    for a, b in zip([0, *cuts], [*cuts, len(words)], strict=True):
        catchers.append(hashes[a:b], np.zeros(b - a, np.int64))
    return [(s, e - s, p) for s, e, p in zip(*(x.tolist() for x in catchers.runs()), strict=True)]


@pytest.mark.parametrize("times", [2, 4])
def test_runs_are_those_of_brute_force(times):
    for words in streams():
        assert caught(words, times=times) == runs_of(words, times)


def test_appending_word_by_word_changes_nothing():
    for words in list(streams())[-14:]:
        assert caught(words, cuts=range(1, len(words))) == runs_of(words)


def test_texts_of_one_stream_do_not_meet():
    catchers = Catchers()
    catchers.append(np.full(12, 3, np.uint64), np.repeat([0, 5], [5, 7]))
    assert [x.tolist() for x in catchers.runs()] == [[5], [12], [1]]


def test_query_is_brute_force(spark):
    loop = "alpha Beta  gamma\n" * 30
    texts = [*odd_texts(), loop, loop.replace("Beta", "beta", 1), "x " * 40_000, ("lorem ipsum dolor " * 9 + "end ") * 5]
    texts += [f"w{i} " * (i % 9) + "a b c d " * i for i in range(60)]
    docs = documents(spark, texts, ", n_words long, runs string", (1, "clash")).union(
        spark.createDataFrame([(None, "a a a a a a a", "x", "y", 1, 2, "z"), (3, "a b a b a b a b", None, None, None, None, None)],
                              "doc_id long, text string, lang string, source string, n_chars long, n_words long, runs string")
    )
    given = docs.select("doc_id", "text").collect()
    got = queries.runs_digest(periodic_runs.find(queries.with_planted_runs(docs))).collect()
    want = []
    for doc_id, text in given:
        words = planted((text or "").encode().split(), doc_id)
        runs = runs_of(words) if len(set(words)) > 1 else [(0, len(words), 1)] if len(words) >= 6 else []
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        want.append((doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r.n_runs for r in got) > 60
    assert [f.dataType.simpleString() for f in queries.runs_digest(periodic_runs.find(docs)).schema] == ["bigint"] * 6 + ["string"] * 2


def test_an_empty_table_gives_no_rows(spark):
    assert periodic_runs.find(documents(spark, []).where("false")).collect() == []
