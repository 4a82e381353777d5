import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from lociweave.llm import warc


def fixture():
    big = "<p>ü</p>" * 30
    pages = [(5, big), (3, big), (9, big), (1, "short"), (2, "short"), (4, None), (6, ""), (7, "x" * 99), (8, "x" * 99), (10, "x" * 100), (11, "x" * 100), (12, "WARC/1.1\r\n\r\nfoo" * 20000)]
    return pages + [(3, big), (None, big), (None, "only nulls have this " * 9), (None, "only nulls have this " * 9), (13, "\x00\r\n\r\n")]


def expected(pages):
    out = []
    for p, h in pages:
        b = (h or "").encode()
        same = [q for q, g in pages if (g or "").encode() == b]
        ids = [q for q in same if q is not None]
        first = min(ids) if len(b) >= 100 and len(same) > 1 and ids else None
        again = first is not None and p != first
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    pages = fixture()
    df = spark.createDataFrame(pages, "page_id long, html string").withColumn("digest", F.lit("mine")).withColumn("payload", F.lit(1))
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_archives(warc.classified(df), folder, archive_bytes=2000)
    assert manifest.count() > 2 and manifest.agg(F.sum("n_records")).first()[0] == len(pages)
    rows = warc.read_archives(manifest, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected(pages)
    texts = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, h in pages}
    assert all(bytes(r.payload) == (texts[r.payload_digest] if r.record_type == "response" else b"") for r in rows)


def test_one_gzip_member_per_record(spark, tmp_path):
    df = spark.createDataFrame(fixture(), "page_id long, html string").coalesce(1)
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_archives(warc.classified(df), folder)
    members = 0
    for r in manifest.collect():
        data = (tmp_path / "w" / r.path).read_bytes()
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        while data:
            d = zlib.decompressobj(31)
            assert d.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")
            data, members = d.unused_data, members + 1
    assert members == len(fixture())


def one(payload=b"hello", kind="response"):
    return warc.record(1, payload, hashlib.sha256(payload).hexdigest(), kind, 7)


def test_small_reads():
    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 3))

    found = list(warc.read_records(Slow(one() + one(b"x" * 5000) + one(b"", "revisit"))))
    assert [f["payload_bytes"] for f in found] == [5, 5000, 0] and found[2]["refers_to"] == 7
    assert list(warc.read_records(io.BytesIO(b""))) == []


def broken(change):
    plain = gzip.decompress(one())
    return gzip.compress(change(plain))


@pytest.mark.parametrize(
    "data, said",
    [
        (broken(lambda x: x.replace(b"hello", b"hallo")), "digest"),
        (broken(lambda x: x[:-2]), "line ends"),
        (broken(lambda x: x[:-12]), "Content-Length"),
        (broken(lambda x: b"X" + x), "not a WARC"),
        (one()[:-20], "inside a record"),
        (broken(lambda x: x + b"more"), "line ends"),
    ],
)
def test_broken_records(data, said):
    with pytest.raises(ValueError, match=said):
        list(warc.read_records(io.BytesIO(data)))


def test_payload_digest_is_verified():
    payload = b"hello"
    data = warc.record(1, payload, hashlib.sha256(b"other").hexdigest(), "response", None)
    with pytest.raises(ValueError, match="payload digest"):
        list(warc.read_records(io.BytesIO(data)))


def test_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, html string")
    folder = f"file://{tmp_path}/w"
    assert warc.read_archives(warc.write_archives(warc.classified(df), folder), folder).count() == 0
