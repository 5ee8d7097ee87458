"""WARC archives compressed with Zstandard: writer and reader.

Each archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself a Zstandard frame; then every
record is a frame of its own. A record has a header block, a blank line, Content-Length bytes and two line ends; its block is an HTTP
response: header lines, a blank line and the payload.

``write`` makes archives of at most about ``ARCHIVE_BYTES`` in the shared folder. Of rows with equal payloads of at least ``REVISIT_FROM``
bytes, those with the largest page id are responses, the others revisit it: they hold the HTTP header only and name the
response. A manifest, a table of the archives of the tasks that succeeded, says which files belong; files that lost tasks left
behind are not in it. The dictionary is trained on at most ``SAMPLES`` payloads of at most ``SAMPLE_BYTES`` (those with the smallest
hash of the id); with too few samples to train, archives have no dictionary.

``read`` decodes archives frame by frame. It fails, naming file and record, on a bad version line, a missing or repeated header, a
wrong length, a digest that differs from the payload, trailing bytes in a record or a cut-off frame.

Null payloads are empty, null URLs and ids have no header line. A row without id whose payload others share revisits the largest id; if none of
them has an id all are responses. Extra columns are not used. Empty tables give no archive and no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, functions as F

from roadflux import workspace
from roadflux.llm.samples import smallest

REVISIT_FROM = 1000
ARCHIVE_BYTES = 64 << 20
SAMPLES = 400
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
MOST_TASKS = 20_000
ROWS_PER_BATCH = 500
READ_BYTES = 1 << 20
# Fixed values of the format.
VERSION = "WARC/1.1"
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PRINTABLE = "".join(map(chr, range(33, 127)))
DATE = "2024-01-01T00:00:00Z"


class Record(NamedTuple):
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


class Malformed(ValueError):
    pass


def record_name(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def encode(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}"]
    lines.append(f"WARC-Record-ID: {record_name(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}")
    if url is not None:
        lines.append("WARC-Target-URI: " + urllib.parse.quote(url, safe=_PRINTABLE))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _header_lines(data: bytes, where: str) -> tuple[str, dict[str, str]]:
    first, *lines = data.decode("utf-8").split("\r\n")
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        key = name.strip().lower()
        if not colon or not re.fullmatch(r"[A-Za-z0-9-]+", name) or key in out:
            raise Malformed(f"{where}: header line {line!r}")
        out[key] = value.strip()
    return first, out


def _length(headers: dict[str, str], where: str) -> int:
    if not re.fullmatch(r"\d+", headers.get("content-length", "")):
        raise Malformed(f"{where}: no valid Content-Length")
    return int(headers["content-length"])


def decode(data: bytes, where: str) -> Record:
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, headers = _header_lines(head, where)
    if not gap or version != VERSION:
        raise Malformed(f"{where}: version line {version!r}")
    missing = {"warc-type", "warc-date", "warc-record-id", "warc-payload-digest"} - set(headers)
    if missing or headers["warc-type"] not in ("response", "revisit"):
        raise Malformed(f"{where}: {sorted(missing) or headers['warc-type']}")
    if headers["warc-type"] == "revisit" and not {"warc-refers-to", "warc-profile"} <= set(headers):
        raise Malformed(f"{where}: a revisit that names no record")
    size = _length(headers, where)
    if len(rest) != size + 4 or not rest.endswith(b"\r\n\r\n"):
        raise Malformed(f"{where}: {len(rest) - 4} bytes instead of {size}")
    http_head, gap, payload = rest[:size].partition(b"\r\n\r\n")
    status, http = _header_lines(http_head, where)
    if not gap or not status.startswith("HTTP/"):
        raise Malformed(f"{where}: no HTTP response")
    if headers["warc-type"] == "revisit":
        if payload:
            raise Malformed(f"{where}: a revisit with a payload")
    elif len(payload) != _length(http, where) or f"sha1:{hashlib.sha1(payload).hexdigest()}" != headers["warc-payload-digest"]:
        raise Malformed(f"{where}: payload differs from its length or digest")
    return Record(headers, http, payload)


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def records(stream, where: str) -> Iterator[Record]:
    """Read an archive from a binary stream: one frame, one record."""
    held = stream.read(READ_BYTES)
    dictionary = None
    if len(held) >= 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", held[4:8])[0]
        while len(held) < 8 + size:
            more = stream.read(READ_BYTES)
            if not more:
                raise Malformed(f"{where}: cut off in the dictionary")
            held += more
        body, held = held[8:8 + size], held[8 + size:]
        if body[:4] == struct.pack("<I", FRAME_MAGIC):
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        dictionary = zstandard.ZstdCompressionDict(body)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    number = 0
    while held or (held := stream.read(READ_BYTES)):
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not held:
                held = stream.read(READ_BYTES)
                if not held:
                    raise Malformed(f"{where}, record {number}: cut off")
            try:
                parts.append(frame.decompress(held))
            except zstandard.ZstdError as error:
                raise Malformed(f"{where}, record {number}: {error}") from error
            held = frame.unused_data if frame.eof else b""
        yield decode(b"".join(parts), f"{where}, record {number}")
        number += 1


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path in the shared folder, and the path within it."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        scheme, _, rest = path.partition(":")
        return pyarrow.fs.FileSystem.from_uri(path if rest.startswith("//") else f"{scheme}://{rest}")
    return pyarrow.fs.LocalFileSystem(), path


def train(pages: DataFrame, id_col: str, html_col: str) -> bytes:
    small = pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).alias("html")).where(
        F.octet_length("html").between(1, SAMPLE_BYTES))
    chosen = smallest(small, F.xxhash64("id"), SAMPLES, pages.count(), "id", "html")
    samples = [r.html.encode() for r in chosen.collect()]  # at most SAMPLES * SAMPLE_BYTES
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives; the manifest (path, n_records, n_bytes)."""
    spark = pages.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    folder = workspace.fresh_path(spark, "archives")
    dictionary = train(pages, id_col, html_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    # Only shared payloads go back to the pages: far fewer rows than pages, as a rule.
    owners = rows.where(F.octet_length("html") >= REVISIT_FROM).groupBy(F.col("digest").alias("of")).agg(
        F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1 and owner is not null")
    owners = workspace.written(owners.select("of", "owner"), "owners")
    joined = rows.join(owners, rows["digest"] == owners["of"], "left")
    planned = joined.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=LEVEL)
        out, name, n_records, n_bytes = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": pa.array([f"{folder}/{name}"]), "n_records": pa.array([n_records], pa.int64()),
                                               "n_bytes": pa.array([n_bytes], pa.int64())})

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    name, n_records, n_bytes = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    if dictionary:
                        n_bytes += out.write(dictionary_frame(dictionary)) or 0
                frame = packer.compress(encode(page_id, url, html.encode(), digest, refers_to))
                out.write(frame)
                n_records, n_bytes = n_records + 1, n_bytes + len(frame)
                if n_bytes >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return workspace.written(planned.mapInArrow(run, "path string, n_records long, n_bytes long"), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """The records of the archives: page_id, url, record_type, refers_to, payload (null for a revisit), payload_bytes, payload_digest."""
    spark = manifest.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)

    def page_of(name: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
        return int(found[1]) if found else None

    names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, inner = filesystem(path)
                held, size, seen = [], 0, 0
                with files.open_input_stream(inner, compression=None) as stream:
                    for record in records(stream, path):
                        h = record.headers
                        revisit = h["warc-type"] == "revisit"
                        held.append((page_of(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-type"], page_of(h.get("warc-refers-to")),
                                     None if revisit else record.payload, _length(record.http, path), h["warc-payload-digest"].removeprefix("sha1:")))
                        seen, size = seen + 1, size + len(record.payload)
                        if size > 4 * READ_BYTES or len(held) >= ROWS_PER_BATCH:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                            held, size = [], 0
                if seen != wanted:
                    raise Malformed(f"{path}: {seen} records instead of {wanted}")
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    # An archive a task, up to MOST_TASKS, beyond which tasks read several. Given a number, adaptive execution leaves the partitions
    # apart; the names are random, so that ranges of them hold one each.
    tasks = max(1, min(manifest.count(), MOST_TASKS))
    paths = manifest.select("path", "n_records").repartitionByRange(tasks, "path")
    return paths.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string")
