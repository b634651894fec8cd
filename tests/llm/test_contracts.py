"""The registered queries over small written tables: contract columns, their types, and rows that can be told at once."""

import base64
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from navloom.llm import queries

from tests.llm.data import documents, odd_texts

COLUMNS = {
    "op1_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op4_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op6_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op7_html_templates": "page_id bigint, url string, text string, n_chars bigint",
    "op8_embedding_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op9_collision_search": "query_id bigint, rank int, vec_id bigint, score double",
    "op11_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op12_license_match": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op13_centroids": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
}


def vectors():
    rng = random.Random(5)
    centre = [rng.gauss(0, 1) for _ in range(64)]
    near = [[c + rng.gauss(0, 0.1) for c in centre] for _ in range(40)]
    return near + [[rng.gauss(0, 1) for _ in range(64)] for _ in range(120)]


HTML = ["<p>one</p>", "<article><p>two words</p></article>", None, "", "<p>one</p>", "<p>one</p>"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, odd_texts()).write.parquet(f"{path}/documents.parquet")
    pages = [(i, f"http://host/{i}", h) for i, h in enumerate(HTML)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    rows = [(i, v, i % 2) for i, v in enumerate(vectors())] + [(500, None, 0), (600, [0.0] * 64, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="module")
def results(spark, tables):
    known = {}

    def result(name):
        if name not in known:
            frame = queries.QUERIES[name](spark, tables)
            known[name] = frame.dtypes, frame.collect()
        return known[name]

    return result


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_types(results, name):
    types, rows = results(name)
    wanted = [tuple(c.split(" ")) for c in COLUMNS[name].split(", ")]
    assert [t for t in types if t in wanted] == wanted and rows


def test_one_row_for_each_document_page_and_vector(results):
    ids = list(range(len(odd_texts())))
    for name in ("op1_sharding", "op2_jaccard_join", "op11_periodic_runs", "op12_license_match"):
        assert sorted(r.doc_id for r in results(name)[1]) == ids
    for name in ("op4_warc", "op7_html_templates"):
        assert sorted(r.page_id for r in results(name)[1]) == list(range(len(HTML)))
    assert sorted(r.vec_id for r in results("op8_embedding_dedup")[1]) == [*range(160), 500, 600]
    assert sorted(r.vec_id for r in results("op13_centroids")[1]) == [*range(160), 600]


def test_shards(results):
    texts = odd_texts()
    slots = {}
    for r in results("op1_sharding")[1]:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_archives(results):
    last = {h or "": i for i, h in enumerate(HTML)}
    for r in results("op4_warc")[1]:
        payload = HTML[r.page_id] or ""
        digest = base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload.encode()), digest)
        kept = last[payload] == r.page_id
        assert (r.record_type, r.refers_to) == (("response", None) if kept else ("revisit", last[payload]))


def test_pieces_cover_every_id_once(results):
    ends, places = {}, {}
    for r in sorted(results("op6_packing")[1], key=lambda r: (r.doc_id, r.start)):
        assert r.start == ends.get(r.doc_id, 0)
        ends[r.doc_id] = r.start + r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    tokens = {r.doc_id: r.doc_tokens for r in results("op6_packing")[1]}
    assert ends == tokens and sorted(tokens) == list(range(len(odd_texts())))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_nearest_are_those_of_all_distances(results):
    singles = [[float(x) for x in v] for v in np.array(vectors(), "float32")]
    rows = results("op9_collision_search")[1]
    assert sorted({r.query_id for r in rows}) == [0, 100]
    for q in (0, 100):
        wanted = sorted((math.dist(singles[q], v), i) for i, v in enumerate(singles) if i != q)[:10]
        found = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == q)
        assert [f[0] for f in found] == list(range(1, 11))
        assert len({f[1] for f in found} & {i for _, i in wanted}) >= 9
        assert all(s == pytest.approx(math.dist(singles[q], singles[v]), rel=1e-12) for _, v, s in found)


def test_links_are_those_of_all_pairs(results):
    given = np.array(vectors(), "float32").astype(float)
    unit = given / (given**2).sum(axis=1, keepdims=True) ** 0.5
    same = [i % 2 for i in range(len(given))]
    for r in results("op8_embedding_dedup")[1]:
        if r.vec_id < 160:
            linked = [j for j in range(160) if j != r.vec_id and same[j] == same[r.vec_id] and unit[j] @ unit[r.vec_id] >= 0.93]
            assert r.n_links == len(linked) and r.kept == (r.vec_id == r.component_id)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
