import hashlib
import io
import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from roadflux.llm import warc


def pages():
    rng = random.Random(6)
    bodies = ["", "x" * 999, "y" * 1000, "é" * 500, "<p>" + "lorem ipsum " * 400, None, "WARC/1.1\r\n\r\n" * 100]
    rows = [(i, f"http://a.example/{i}", rng.choice(bodies)) for i in range(80)]
    rows += [(i, f"http://b.example/{i}", "".join(rng.choices("abc <>\r\n", k=rng.choice([10, 3000])))) for i in range(100, 160)]
    return rows + [(None, "http://n.example", "y" * 1000), (None, None, None), (40, "http://again", "y" * 1000), (500, "bad\r\nurl: ü", "z" * 2_000_000)]


def want(rows):
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(largest.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        owner = largest.get(h or "")
        revisit = len(data) >= 1000 and owner is not None and owner != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", owner if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [64 << 20, 2000])
def test_round_trip(spark, size):
    rows = pages()
    frame = spark.createDataFrame([(h, i, u, "x") for i, u, h in rows], "html string, page_id long, url string, digest string").repartition(3)
    manifest = warc.write(frame, archive_bytes=size)
    got = warc.read(manifest).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == want(rows)
    bodies = {(r.page_id, bytes(r.payload)) for r in got if r.record_type == "response"}
    assert bodies <= {(i, (h or "").encode()) for i, _, h in rows}
    assert manifest.count() >= (20 if size == 2000 else 3)
    path = manifest.first().path
    files, inner = warc.filesystem(path)
    with files.open_input_stream(inner, compression=None) as stream:
        assert struct.unpack("<I", stream.read(4))[0] == warc.DICTIONARY_MAGIC


def test_an_archive_a_task(spark):
    rows = [(i, "http://a.example", "".join(random.Random(i).choices("abcdefgh", k=3000))) for i in range(60)]
    manifest = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), archive_bytes=6000)
    read = warc.read(manifest).select("page_id", F.spark_partition_id().alias("task")).collect()
    assert len(read) == 60 and len({r.task for r in read}) == manifest.count() > 8


def test_empty(spark):
    manifest = warc.write(spark.createDataFrame([], "page_id long, url string, html string"))
    assert manifest.count() == 0 and warc.read(manifest).count() == 0


def packed(*records, dictionary=b""):
    return b"".join(zstandard.ZstdCompressor().compress(r) for r in records)


GOOD = warc.encode(1, "http://x", b"abc", hashlib.sha1(b"abc").hexdigest(), None)


@pytest.mark.parametrize("raw", [
    GOOD.replace(b"WARC/1.1", b"WARC/0.1"), GOOD.replace(b"abc", b"abd"), GOOD + b"x", GOOD[:-1], GOOD.replace(b"WARC-Date", b"X-Date"),
    GOOD.replace(b"WARC-Type: response", b"WARC-Type: response\r\nWARC-Type: response"), GOOD.replace(b"WARC-Type: response", b"WARC-Type: other"),
    GOOD.replace(b"length: 3", b"length: 4").replace(b"Content-Length: 3", b"Content-Length: 4"),
])
def test_malformed_records(raw):
    assert next(warc.records(io.BytesIO(packed(GOOD)), "f")).payload == b"abc"
    with pytest.raises(warc.Malformed, match="record 1"):
        list(warc.records(io.BytesIO(packed(GOOD, raw)), "f"))


def test_cut_off():
    data = packed(GOOD, GOOD)
    for end in (len(data) - 3, len(data) // 2 + 4):
        with pytest.raises(warc.Malformed, match="cut off"):
            list(warc.records(io.BytesIO(data[:end]), "f"))


def test_a_dictionary_that_is_not_compressed():
    samples = [f"<p>page number {i} with the same words</p>".encode() * 3 for i in range(500)]
    trained = zstandard.train_dictionary(2000, samples).as_bytes()
    record = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(trained)).compress(GOOD)
    data = struct.pack("<II", warc.DICTIONARY_MAGIC, len(trained)) + trained + record
    assert [r.payload for r in warc.records(io.BytesIO(data), "f")] == [b"abc"]
