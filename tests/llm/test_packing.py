import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from navloom.llm import packing
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .data import documents, odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def packed(docs, length=64):
    return packing.pieces(packing.tokenized(docs, PATH), length)


def test_pieces_are_the_tokenizers_ids(spark):
    docs = documents(spark, odd_texts(), ", ids string, key string, part string", ("a", "b", "c")).repartition(3)
    rows = packed(docs).collect()
    direct = Tokenizer.from_file(PATH)
    for doc in docs.collect():
        own = sorted((r for r in rows if r.key == doc.doc_id), key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u4").tolist()
        assert ids == [*direct.encode(doc.text or "", add_special_tokens=False).ids, 1]
        assert {r.doc_tokens for r in own} == {len(ids)}
        assert [r.start for r in own] == np.cumsum([0, *[r.size for r in own][:-1]]).tolist()


def test_windows_are_full_and_gapless(spark):
    cut = packed(documents(spark, odd_texts()).repartition(4))
    rows = sorted(cut.collect(), key=lambda r: (r.sequence_id, r.offset))
    fill = {}
    for r in rows:
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.size
    last = max(fill)
    assert sorted(fill) == list(range(last + 1)) and all(n == 64 for s, n in fill.items() if s != last)
    whole = packing.sequences(cut).collect()
    assert all(len(bytes(r.ids)) == 4 * r.tokens == 4 * fill[r.sequence_id] for r in whole)
    parts = {r.sequence_id for r in rows if r.boundary}
    assert 0 < len(parts) <= 5


def test_crc_in_spark_is_of_little_endian_ids(spark):
    row = packed(documents(spark, ["hello there"])).select("ids", F.crc32("ids").alias("c")).first()
    assert zlib.crc32(bytes(row.ids)) == row.c


def test_repeated_null_and_empty(spark):
    docs = documents(spark, [None, "", "x"]).withColumn("doc_id", F.lit(None).cast("long"))
    assert sorted(r.doc_tokens for r in packed(docs).collect()) == [1, 1, 2]
    assert packed(docs.where("false")).count() == 0


def test_marks_do_not_multiply_the_words_remembered():
    encoder = packing.WordIds(PATH)
    encoder.encode(pa.array(["moon moon, moon. Moon; (moon)", None, "été été, été."]))
    assert len(encoder.keys) == len({"moon", ",", ".", ";", "(moon)", "été"})


def test_letters_and_marks_are_cut_as_the_tokenizer_cuts():
    letters = [chr(c) for c in range(0x21, 0x800)] + ["漢", "ﬁ", "e\u0301", "İ", "×", "don't"]
    texts = [f"{x}, {x}{x}. a{x}!? {x}b-) .{x} {x}.{x}," for x in letters]
    ids, bounds = packing.WordIds(PATH).encode(pa.array(texts))
    direct = Tokenizer.from_file(PATH)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == direct.encode(text, add_special_tokens=False).ids, text
