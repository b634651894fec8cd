import base64
import hashlib
import io
import os

import pytest
import zstandard
from navloom.llm import warc

PAGES = "page_id long, url string, html string, digest string, id string, revisit string"


def rows():
    long = "<p>" + "é" * 400_000 + "</p>"
    out = [(i, f"http://a.b/{i}?x=\r\ny z", f"<p>{i % 7}</p>") for i in range(60)]
    out += [(104, "http://z", long + "z")]
    out += [(100, None, None), (101, "http://e", ""), (102, "http://l", long), (103, "http://l", long), (None, "http://n", "<p>3</p>")]
    out += [(None, "http://m", "alone"), (None, "http://m", "alone"), (59, "http://again", "<p>3</p>"), (200, "u", "twice"), (200, "u", "twice")]
    return [(*r, "d", "i", "r") for r in out]


def expected(given, least=0):
    groups = {}
    for page_id, _, html, *_ in given:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        for k, i in enumerate(ids):
            single = k == 0 or len(payload) < least
            out.append((i, len(payload), digest, "response" if single else "revisit", None if single else ids[0]))
    return sorted(map(str, out))


@pytest.mark.parametrize("least", [0, 9])
def test_round_trip(spark, folder, least):
    pages = spark.createDataFrame(rows(), PAGES).repartition(3)
    index = warc.write_archives(pages, folder, least)
    records = warc.read_archives(index, folder).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records]
    assert sorted(map(str, found)) == expected(rows(), least)
    for r in records:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert "\n" not in (r.url or "")


def test_bundles_are_plain_zstandard_and_seekable(spark, folder):
    pages = spark.createDataFrame(rows(), PAGES).coalesce(1)
    index = warc.write_archives(pages, folder)
    path = folder.removeprefix("file://")
    names = [n for n in os.listdir(path) if n.endswith(".zst")]
    assert not os.listdir(f"{path}/_attempts")
    whole = b"".join(
        zstandard.ZstdDecompressor().stream_reader(open(f"{path}/{n}", "rb"), read_across_frames=True).read() for n in sorted(names)
    )
    assert whole.count(b"WARC/1.1\r\n") == len(rows())
    frames = {(r.bundle, r.frame) for r in index.collect()}
    assert len(frames) > 1
    sizes = {r.bundle: 0 for r in index.collect()}
    assert set(sizes) <= set(names)


def test_damage_is_noticed():
    out = io.BytesIO()
    writer = warc.BundleWriter(out)
    frame, offset = writer.add(warc.encode_record(1, "u", b"payload", None, False))
    writer.close()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    plain = warc.BundleReader(Source(out.getvalue())).frame(frame)
    assert warc.decode_record(plain, offset)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.decode_record(plain.replace(b"payload\r\n", b"pAyload\r\n"), offset)
    with pytest.raises(ValueError):
        warc.BundleReader(Source(out.getvalue()[:-1]))


def test_empty_table(spark, folder):
    pages = spark.createDataFrame([], PAGES)
    assert warc.read_archives(warc.write_archives(pages, folder), folder).count() == 0
