import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from navloom.llm import labelled, quality, toxicity
from navloom.llm import words as word_module
from navloom.llm.words import character_ngrams, kinds, split
from navloom.llm.shared import give_back, utf8
from pyspark.sql import functions as F

from .data import documents, odd_texts, words

INSULTS = ["grobklotz", "zankwurm", "motzkopf"]


def toxic_corpus(n=600):
    texts, labels = [], []
    for i in range(n):
        rng = random.Random(i)
        text = words(rng.randrange(20, 260), 1000 + i).split(" ")
        bad = i % 3 == 0
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(INSULTS) + rng.choice(["", "e", "en", "chen"]))
        texts.append(" ".join(text))
        labels.append(int(bad))
    return texts, np.array(labels)


def poor_corpus(n=240):
    texts, labels = [], []
    for i in range(n):
        kind = i % 4
        good = words(60, 2000 + i)
        bad = {0: good.upper() + "!!", 1: " ".join([good.split(" ")[0]] * 60), 2: good.replace(" ", "### ")}.get(kind)
        texts.append(bad or good)
        labels.append(int(bad is None))
    return texts, np.array(labels)


SMALL = toxicity.Plan(word_buckets=1 << 12, gram_buckets=1 << 12, batch=32)


@pytest.fixture(scope="module")
def network():
    texts, labels = toxic_corpus()
    return toxicity.train(texts, labels, SMALL)


def test_held_out_accuracy_of_the_network(network):
    texts, labels = toxic_corpus(800)
    score = network.score(pa.array(texts[600:]))
    assert ((score >= 0.5) == labels[600:]).mean() > 0.95


def test_network_sees_every_window(network):
    clean = words(3000, 5)
    for place in (0, 900, 1500, 2999):
        parts = clean.split(" ")
        parts[place : place + 1] = INSULTS
        scores = network.score(pa.array([clean, " ".join(parts)]))
        assert scores[0] < 0.5 < scores[1]


def test_windows_overlap_and_cover():
    plan = toxicity.Plan()
    for n in (0, 1, 64, 65, 112, 113, 500):
        first, size, _ = toxicity.windows(np.array([0, n]), plan)
        covered = {w for f, s in zip(first.tolist(), size.tolist()) for w in range(f, f + s)}
        assert covered == set(range(n))
        assert all(b - a == plan.stride for a, b in zip(first.tolist(), first.tolist()[1:]))


def test_gradients_match_finite_differences():
    plan = toxicity.Plan(word_buckets=64, gram_buckets=64, window=7, stride=5, state=3, word_size=2, gram_size=2)
    p = {k: v.astype(np.float64) for k, v in toxicity.parameters(plan).items()}
    data, offsets = utf8(pa.array(["a bb ccc dd a", "ee f bb"]))
    w = split(data, offsets)
    found = kinds(data, w)
    lexicon = toxicity.Lexicon.of(found.raw, found.hash, plan)
    first, size, doc = toxicity.windows(w.per_doc(2), plan)
    steps = toxicity.steps_of(found.which, first, size, plan, len(found.raw))
    labels = np.array([1, 0])[doc]

    def loss():
        z = toxicity._forward(p, lexicon.inputs(p), steps)
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    dense, d_word, d_gram = toxicity._gradients(p, lexicon, steps, labels)
    rows, sums = toxicity.sum_rows(lexicon.word, d_word)
    grams, gram_sums = toxicity.sum_rows(lexicon.grams, d_gram)
    checks = [(name, i, dense[name].ravel()[i]) for name in dense for i in (0, dense[name].size - 1)]
    checks += [("word", int(rows[0]) * 2, sums[0, 0]), ("gram", int(grams[1]) * 2 + 1, gram_sums[1, 1])]
    for name, i, given in checks:
        flat, step = p[name].reshape(-1), 1e-3
        flat[i] += step
        up = loss()
        flat[i] -= 2 * step
        down = loss()
        flat[i] += step
        assert abs((up - down) / (2 * step) - given) < 2e-3, name


def test_held_out_accuracy_of_the_quality_classifier():
    texts, labels = poor_corpus(480)
    model = quality.train(texts[:240], labels[:240], quality.Plan(buckets=1 << 13, epochs=10))
    score = model.score(pa.array(texts[240:]))
    assert ((score >= 0.5) == labels[240:]).mean() > 0.97


def test_quality_score_is_the_softmax_of_the_average():
    texts, labels = poor_corpus(60)
    model = quality.train(texts, labels, quality.Plan(buckets=1 << 10, epochs=2))
    for text in texts[:8]:
        ids, weight = quality.document_features(text, model.plan)
        expected = 1 / (1 + np.exp(-(weight @ model.worth[ids] + model.bias)))
        assert abs(model.score(pa.array([text]))[0] - expected) < 1e-5


def test_character_ngrams_by_hand():
    grams, owner = character_ngrams(["ab", "é"], 3, 4)
    assert owner.tolist() == [0, 0, 1, 0]
    again, _ = character_ngrams(["é"], 3, 4)
    assert grams[2] == again[0]


@pytest.mark.parametrize("model", ["network", "classifier"])
def test_odd_texts_and_slices(spark, model, network):
    texts, labels = poor_corpus(80)
    scorer = network if model == "network" else quality.train(texts, labels, quality.Plan(buckets=1 << 10, epochs=2))
    docs = documents(spark, odd_texts(), ", score string, record string", ("s", "r"))
    rows = labelled.scored(docs.union(docs).repartition(3), scorer.score).select("record.*", F.col("score").alias("given")).collect()
    assert len(rows) == 2 * docs.count() and all(0 <= r.given <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert abs(by_text.setdefault((r.text or "").strip(), r.given) - r.given) < 1e-6
    one_by_one = {t: scorer.score(pa.array([t], pa.string()))[0] for t in odd_texts()}
    assert all(abs(one_by_one[r.text] - r.given) < 1e-5 for r in rows)


def test_folds_and_labels(spark):
    import zlib

    docs = documents(spark, [f"text {i}" for i in range(60)])
    rows = [(i, i % 2) for i in range(50)] + [(3, 0), (5, None), (None, 1), (999, 1), (7, 7)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    texts, wanted = labelled.training_sample(docs, labels, "toxic", ~toxicity.held_out(), 1000, 10**6, 1)
    got = dict(zip(texts, wanted.tolist(), strict=True))
    expected = {f"text {i}": i % 2 for i in range(50) if zlib.crc32(str(i).encode()) % 5 and i != 3 and i != 7}
    assert {k: v for k, v in got.items() if k != "text 7"} == expected
    few, _ = labelled.training_sample(docs, labels, "toxic", ~toxicity.held_out(), 10, 10**6, 1, 0.4)
    assert len(few) == 10
    short, _ = labelled.training_sample(docs, labels, "toxic", ~toxicity.held_out(), 1000, 30, 1)
    assert 0 < sum(map(len, short)) <= 30


def test_without_labels_or_rows(spark):
    docs = documents(spark, ["a", "b", None])
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    for module in (toxicity, quality):
        out = module.judge(docs, module.fit(docs, none)).collect()
        assert [r.score for r in out] == [0.5] * 3
        assert module.judge(docs.where("false"), module.fit(docs, none)).count() == 0
        assert module.accepted(docs, module.fit(docs, none)).columns == docs.columns
    one_class = spark.createDataFrame([(0, 1, 1), (1, 1, 1)], "doc_id long, toxic int, quality int")
    assert all(r.predicted == 1 for r in quality.judge(docs, quality.fit(docs, one_class)).collect())


def test_words_of_a_sample_are_the_same_in_any_slices(monkeypatch):
    texts = [*odd_texts(), words(400, 1), words(300, 1).title(), "McAb mCab", words(500, 2), "mCab McAb"]
    texts = [t for t in texts if t is not None]
    found, bounds = word_module.kinds_of_texts(texts)
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    whole = split(data, offsets)
    assert bounds.tolist() == whole.per_doc(len(texts)).tolist()
    assert found.hash.tolist() == sorted(set(kinds(data, whole).hash.tolist()))
    for limit in (1, 50, 700):
        monkeypatch.setattr(word_module, "LEARNT_BYTES", limit)
        again, same_bounds = word_module.kinds_of_texts(texts)
        assert (again.raw, again.hash.tolist(), again.which.tolist()) == (found.raw, found.hash.tolist(), found.which.tolist())
        assert same_bounds.tolist() == bounds.tolist()


def test_learning_holds_few_bytes_a_word_on_the_driver():
    rng = random.Random(3)
    texts = [" ".join(f"{rng.getrandbits(32):08x}" for _ in range(500)) for _ in range(240)]
    plan = toxicity.Plan(word_buckets=1 << 10, gram_buckets=1 << 10, rounds=2, least_steps=1)
    word_module._powers.clear()
    tracemalloc.start()
    toxicity.train(texts, np.arange(240) % 2, plan)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 550 * 240 * 500  # bytes for each word, all different


def test_the_sample_is_found_without_python_processes_of_its_own(spark, monkeypatch):
    docs = documents(spark, [f"text {i}" for i in range(60)])
    text_ids = docs.withColumn("doc_id", F.concat(F.lit("é"), F.col("doc_id").cast("string")))
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int").cache()
    labels.count()
    named = labels.withColumn("doc_id", F.concat(F.lit("é"), F.col("doc_id").cast("string")))

    def parallelize(*_):
        raise AssertionError("rows go through Python on the executors")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", parallelize)
    for given, marks in ((docs, labels), (text_ids, named)):
        texts, wanted = labelled.training_sample(given, marks, "toxic", F.lit(True), 1000, 10**6, 1)
        assert dict(zip(texts, wanted.tolist(), strict=True)) == {f"text {i}": i % 2 for i in range(50)}


def test_scoring_reads_small_slices(spark):
    docs = documents(spark, [words(8000, i) for i in range(60)]).coalesce(1)

    def bytes_together(texts):
        return np.full(len(texts), len(utf8(texts)[0]))

    rows = labelled.scored(docs, bytes_together).select("record.doc_id", "score").collect()
    assert sorted(r.doc_id for r in rows) == list(range(60))
    assert max(r.score for r in rows) <= 1 << 18


def test_a_task_leaves_no_tables_behind():
    split(*utf8(pa.array([words(1000, 1)])))
    assert word_module._powers
    give_back()
    assert not word_module._powers
