"""Every stage of the pipeline against brute force over its own input."""

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from navloom.llm import quality, toxicity
from navloom.llm.queries import MIXING_SQL
from tokenizers import Tokenizer

from .data import documents
from .test_classifiers import poor_corpus, toxic_corpus
from .test_jaccard_join import brute


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """The folder of the tables, and the rows that went into and came out of every stage."""
    root = str(tmp_path_factory.mktemp("pipeline"))
    toxic, is_toxic = toxic_corpus(240)
    poor, is_good = poor_corpus(120)
    texts = [*toxic, *poor, *toxic[1:40:3], *[t + " tail" for t in toxic[2:60:3]], None, ""]
    docs = documents(spark, texts, ", score double, record string", (0.5, "r"))
    docs.write.parquet(f"{root}/documents.parquet")
    rows = [(i, 1, int(t)) for i, t in enumerate(is_toxic)] + [(240 + i, int(g), 0) for i, g in enumerate(is_good)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    given, steps = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, given, root).write.parquet(f"{root}/{name}")
        out = spark.read.parquet(f"{root}/{name}")
        steps.append((name, given, out))
        given = out
    return root, {name: (before, after) for name, before, after in steps}


def test_stages_and_columns(results):
    _, steps = results
    assert list(steps) == ["toxicity", "quality", "jaccard_join", "mixing", "packing"]
    for name, (before, after) in steps.items():
        assert name == "packing" or (after.columns == before.columns and after.count() > 0)


@pytest.mark.parametrize(("name", "module"), [("toxicity", toxicity), ("quality", quality)])
def test_rejected_documents_go_and_clean_ones_stay(spark, results, name, module):
    root, steps = results
    before, after = steps[name]
    model = module.fit(before, spark.read.parquet(f"{root}/labels.parquet"))
    rows = before.collect()
    score = model.score(pa.array([r.text for r in rows], pa.string()))
    good = score < 0.5 if name == "toxicity" else score >= 0.5
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r, g in zip(rows, good) if g)
    assert 0.5 < good.mean() < 1


def test_one_document_of_each_group(results):
    before, after = results[1]["jaccard_join"]
    groups = brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c in groups.values()})
    assert after.count() < before.count()


def test_mixture_is_that_of_sql(results):
    before, after = results[1]["mixing"]
    connection = duckdb.connect()
    connection.register("documents", before.select("doc_id", "text", "source").toArrow())
    expected = [r[0] for r in connection.execute(MIXING_SQL).fetchall()]
    assert sorted(r.doc_id for r in after.collect()) == sorted(expected)


def test_packed_ids(results):
    before, after = results[1]["packing"]
    direct = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = sorted(len(direct.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before.collect())
    rows = after.collect()
    assert sorted(r.doc_tokens for r in rows if r.start == 0) == lengths
    assert sum(r.length for r in rows) == sum(lengths)
    fill = np.bincount([r.sequence_id for r in rows], [r.length for r in rows])
    assert (fill[:-1] == 2048).all()


def test_run_applies_all_stages(spark, results):
    root, steps = results
    assert sorted(map(tuple, corpus_pipeline.run(spark, root).select("doc_id", "start", "length").collect())) == sorted(
        map(tuple, steps["packing"][1].select("doc_id", "start", "length").collect())
    )
