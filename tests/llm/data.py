"""Small tables with nulls, empty and very long texts, ties, repeats and clashing names."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, texts, more: str = "", extra: tuple = ()):
    """Rows numbered from 0; `more` and `extra` add columns."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), *extra) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + more)


def odd_texts() -> list:
    base = words(120, 1)
    edited = base.split(" ")
    edited[50] = "changed"
    return [
        None,
        "",
        " \n\t ",
        "one",
        "One  ONE\tone",
        base,
        base,
        base.upper(),
        " ".join(edited),
        words(30_000, 2, 5000),
        "ünïcödé ﬁne ΣΑΣ 日本語 it's <|endoftext|> x",
        *[words(80, s) for s in range(10, 30)],
    ]
