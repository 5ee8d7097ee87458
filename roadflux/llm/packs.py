"""Packs of documents, and questions that packs ask about keys the whole corpus shares.

A pack is about a megabyte of whole documents (a longer document is a pack of its own), stored as one row of a table
that is bucketed by the pack's number. Operators that need to know "does this string also occur in another document?"
work in rounds:

1. every pack sends its distinct keys, cut into ranges ("shards") of the key space, one row per shard that it touches;
2. a shard sees the keys of all packs and answers each of these rows with bits per key, in the order it was sent;
3. the answers go back to their packs. Only answers move: the bucketed packs stay where they are.

A key that a third of all documents hold arrives at most once per pack, so no key makes a shard heavy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from roadflux import workspace

PACK_BYTES = 1 << 20
ROWS_PER_BATCH = 500
NO_ID = np.iinfo(np.int64).max


@dataclass
class Packs:
    """The stored packs, and what sizes the shards."""

    frame: DataFrame
    schema: object
    id_at: int
    text_at: int
    text_bytes: int

    def shards(self, bytes_each: int) -> int:
        spark = self.frame.sparkSession
        return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-self.text_bytes // bytes_each))


def pack(docs: DataFrame, id_col: str, text_col: str, pack_bytes: int = PACK_BYTES) -> Packs:
    """Store the documents as packs; every column travels along, whatever its name."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    names = docs.columns
    id_at, text_at = names.index(id_col), names.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    plain = plain.withColumn(f"c{id_at}", F.col(f"c{id_at}").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            lengths = string_lengths(batch.column(text_at))
            start = 0
            for at, n in enumerate(lengths.tolist()):
                if size and size + n > pack_bytes:
                    held.append(batch.slice(start, at - start))
                    yield _stored(number, held, size)
                    number, held, size, start = number + 1, [], 0, at
                size += n + 16
            held.append(batch.slice(start))
        if size:
            yield _stored(number, held, size)

    path = workspace.fresh_path(spark, "packs")
    name = f"packs_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (plain.mapInArrow(run, "pack long, n_bytes long, body binary")
        .write.bucketBy(buckets, "pack").option("path", path).option("compression", "uncompressed").saveAsTable(name))
    stored = spark.table(name)
    total = stored.agg(F.sum("n_bytes")).first()[0] or 0
    return Packs(stored, docs.schema, id_at, text_at, total)


def _stored(number: int, held: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
    table = pa.Table.from_batches([b for b in held if b.num_rows])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return pa.RecordBatch.from_pydict({
        "pack": pa.array([number], pa.int64()), "n_bytes": pa.array([size], pa.int64()),
        "body": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
    })


def opened(body: bytes) -> pa.Table:
    with pa.ipc.open_stream(body) as stream:
        return stream.read_all().combine_chunks()


def string_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each string, 0 for null."""
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(column), 0).cast(pa.int64()))


def ids_of(table: pa.Table, at: int) -> np.ndarray:
    """Document ids; a document without an id counts as later than all others."""
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(table.column(at).cast(pa.int64()), NO_ID).combine_chunks())


def holders(cells: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct cells, and in how many documents each is. Entries of a document follow each other."""
    if not len(cells):
        return cells, np.zeros(0, np.int64)
    order = np.argsort(cells, kind="stable")
    cells, doc = cells[order], doc[order]
    new = np.ones(len(cells), bool)
    new[1:] = cells[1:] != cells[:-1]
    another = new.copy()
    another[1:] |= doc[1:] != doc[:-1]
    starts = np.flatnonzero(new)
    return cells[starts], np.minimum(np.add.reduceat(another.astype(np.int64), starts), MOST_COUNTED)


# Sorted 64-bit keys, as compressed differences.
def squeeze(keys: np.ndarray) -> bytes:
    steps = np.diff(keys.astype(np.uint64), prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(np.uint64)
    return np.cumsum(steps, dtype=np.uint64)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def cell_bits(n_keys: int) -> int:
    """Width of the key space: 64 cells or more for each key, so that few different keys meet."""
    return min(62, max(16, int(n_keys).bit_length() + 6))


def shard_edges(key_bits: int, shards: int) -> np.ndarray:
    return np.array([-(-(s << key_bits) // shards) for s in range(1, shards)], np.uint64)


def with_answers(packs: Packs, *answers: DataFrame) -> DataFrame:
    """Packs beside what came back for them: columns answers0, answers1, ... of (shard, bits)."""
    out = packs.frame
    for i, answer in enumerate(answers):
        by_pack = answer.groupBy(F.col("pack").alias("to")).agg(F.collect_list(F.struct("shard", "bits")).alias(f"answers{i}"))
        out = out.join(by_pack.hint("shuffle_hash"), out["pack"] == by_pack["to"], "left").drop("to")
    return out


def each_pack(frame: DataFrame, run: Callable[..., Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """run(pack, table, answers0 as a dict of shard -> bytes, ...) over all packs."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                got = {name: row.column(k)[0].as_py() for k, name in enumerate(row.schema.names)}
                told = [{a["shard"]: a["bits"] for a in got[k] or []} for k in sorted(got) if k.startswith("answers")]
                yield from run(got["pack"], opened(got["body"]), *told)

    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    wanted = [c for c in frame.columns if c != "n_bytes"]
    return frame.select(*wanted).mapInArrow(over, schema)


MOST_COUNTED = 255  # documents of one pack that count for a key


def shared_keys(packs: Packs, keys: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], key_bits: int, shards: int,
                common: int = 1 << 62) -> DataFrame:
    """Which keys occur in two documents or more, and which in ``common`` or more: (pack, shard, bits); a bit per distinct
    key of the pack in that shard for the first question, then as many bytes for the second.

    keys(table) gives the pack's sorted distinct keys, and how many of its documents hold each (up to ``MOST_COUNTED``).
    """
    edges = shard_edges(key_bits, shards)

    def ask(number: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        pack_bytes = zstandard.ZstdCompressor(level=1)
        cells, counts = keys(table)
        ends = [0, *np.searchsorted(cells, edges).tolist(), len(cells)]
        rows = [(s, a, b) for s, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
        if rows:
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([s for s, _, _ in rows], pa.int32()),
                "pack": pa.array([number] * len(rows), pa.int64()),
                "cells": pa.array([squeeze(cells[a:b]) for _, a, b in rows], pa.binary()),
                "counts": pa.array([pack_bytes.compress(counts[a:b].astype(np.uint8).tobytes()) for _, a, b in rows], pa.binary()),
            })

    def answer(group: pa.Table) -> pa.Table:
        from_packs = [unsqueeze(c.as_py()) for c in group.column("cells")]
        sizes = [len(c) for c in from_packs]
        cells = np.concatenate(from_packs)
        unpack = zstandard.ZstdDecompressor()
        counts = np.concatenate([np.frombuffer(unpack.decompress(c.as_py()), np.uint8) for c in group.column("counts")]).astype(np.int64)
        order = np.argsort(cells, kind="stable")
        starts = np.flatnonzero(np.diff(cells[order], prepend=cells[order[0]] + np.uint64(1)))
        sums = np.add.reduceat(counts[order], starts)
        holders = np.empty(len(cells), np.int64)
        holders[order] = np.repeat(sums, np.diff(starts, append=len(cells)))
        ends = np.cumsum([0, *sizes])
        return pa.table({
            "pack": group.column("pack"), "shard": group.column("shard"),
            "bits": pa.array([bits(holders[a:b] >= 2) + bits(holders[a:b] >= common) for a, b in zip(ends, ends[1:])], pa.binary()),
        })

    asked = each_pack(packs.frame, ask, "shard int, pack long, cells binary, counts binary")
    return asked.groupBy("shard").applyInArrow(answer, "pack long, shard int, bits binary")


def flags_of(told: dict[int, bytes], cells: np.ndarray, key_bits: int, shards: int, question: int = 0) -> np.ndarray:
    """The answers to the keys that shared_keys() had sent for this pack: 0 in two documents or more, 1 common."""
    ends = [0, *np.searchsorted(cells, shard_edges(key_bits, shards)).tolist(), len(cells)]
    out = np.zeros(len(cells), bool)
    for s, (a, b) in enumerate(zip(ends, ends[1:])):
        if a < b:
            out[a:b] = unbits(told[s][question * -(-(b - a) // 8):], b - a)
    return out
