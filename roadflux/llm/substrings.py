"""Substring dedup with a count-min prefilter.

Windows of ``window`` words that also start in a document with a smaller id lose their words.

1. Every pack counts, for each cell of a sketch, the documents that hold a window of that cell; the packs' sketches are
   merged shard by shard (``packs.shared_keys``). A merged cell never counts less than the true number of documents
   holding a window, so every repeated window lies in a cell counted twice or more. The sketch has one row; its width
   follows the corpus (64 cells or more per word), and it is never gathered in one place.
2. Only windows in such cells are grouped exactly, by a 128-bit identity of their word sequence and with the smallest
   document id of the pack; the group's smallest id decides.

Windows are judged on the input. Null text counts as no words. A null id counts as later than all others; rows that
repeat an id never remove each other's words. Extra columns pass through. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, types as T

from roadflux import workspace
from roadflux.llm import packs as P

WINDOW = 13
BYTES_PER_SHARD = 16 << 20
# Odd multipliers of the two window hashes, drawn once from a fixed seed.
_FACTORS = np.random.default_rng(20240613).integers(0, 1 << 62, (2, 4096), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Windows:
    """All windows of a pack: identity (two 64-bit halves), the row of the document, the first word."""

    def __init__(self, table: pa.Table, id_at: int, text_at: int, window: int):
        self.ids = P.ids_of(table, id_at)
        self.words = [(t.as_py() or "").encode().split() for t in table.column(text_at)]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        digest = xxhash.xxh3_128_digest
        raw = b"".join([digest(w) for words in self.words for w in words])
        halves = np.frombuffer(raw, np.uint64).reshape(-1, 2)
        n = max(0, len(halves) - window + 1)
        row = np.repeat(np.arange(len(sizes)), sizes)
        # words of one document only
        self.start = np.flatnonzero(row[:n] == row[window - 1:]) if n else np.zeros(0, np.int64)
        self.row = row[self.start] if n else np.zeros(0, np.int64)
        self.h = []
        for k in range(2):
            total = np.zeros(n, np.uint64)
            for i in range(window):
                total += halves[i:i + n, k] * _FACTORS[k, i]
            self.h.append(_mixed(total)[self.start])
        self.doc = self.ids[self.row]

    def cells(self, key_bits: int) -> np.ndarray:
        return self.h[0] >> np.uint64(64 - key_bits)

    def sketch(self, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted cells, and how many documents of this pack count in each."""
        return P.holders(self.cells(key_bits), self.row)

    def repeated(self, told: dict[int, bytes], key_bits: int, shards: int) -> np.ndarray:
        """Windows (positions in start, row, h) whose cell counts two documents or more."""
        cells, _ = self.sketch(key_bits)
        flags = P.flags_of(told, cells, key_bits, shards)
        return np.flatnonzero(flags[np.searchsorted(cells, self.cells(key_bits))]) if len(cells) else np.zeros(0, np.int64)

    def distinct(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct identities among the chosen windows, the smallest id of each, and each window's place there."""
        a, b, doc = self.h[0][chosen], self.h[1][chosen], self.doc[chosen]
        order = np.lexsort((doc, b, a))
        a, b, doc = a[order], b[order], doc[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        place = np.empty(len(a), np.int64)
        place[order] = np.cumsum(new) - 1
        return a[new], b[new], doc[new], place


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
          pack_bytes: int = P.PACK_BYTES) -> DataFrame:
    """All columns, plus n_words, n_removed, kept_text (kept words joined by a space) and kept_sha256."""
    taken = {"n_words", "n_removed", "kept_text", "kept_sha256"} & set(docs.columns)
    if taken:
        docs = docs.drop(*taken)
    packs = P.pack(docs, id_col, text_col, pack_bytes)
    id_at, text_at = packs.id_at, packs.text_at
    key_bits = P.cell_bits(packs.text_bytes // 4)
    shards = packs.shards(BYTES_PER_SHARD)

    def sketch(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return Windows(table, id_at, text_at, window).sketch(key_bits)

    counted = workspace.written(P.shared_keys(packs, sketch, key_bits, shards), "sketch-answers")
    edges = P.shard_edges(64, shards)

    def send(number: int, table: pa.Table, told: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        own = Windows(table, id_at, text_at, window)
        a, b, doc, _ = own.distinct(own.repeated(told, key_bits, shards))
        ends = [0, *np.searchsorted(a, edges).tolist(), len(a)]
        rows = [(s, x, y) for s, (x, y) in enumerate(zip(ends, ends[1:])) if x < y]
        if rows:
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([s for s, _, _ in rows], pa.int32()),
                "pack": pa.array([number] * len(rows), pa.int64()),
                "first": pa.array([P.squeeze(a[x:y]) for _, x, y in rows], pa.binary()),
                "second": pa.array([b[x:y].tobytes() for _, x, y in rows], pa.binary()),
                "doc": pa.array([doc[x:y].tobytes() for _, x, y in rows], pa.binary()),
            })

    def decide(group: pa.Table) -> pa.Table:
        firsts = [P.unsqueeze(x.as_py()) for x in group.column("first")]
        a = np.concatenate(firsts)
        b = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in group.column("second")])
        doc = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in group.column("doc")])
        order = np.lexsort((doc, b, a))
        new = np.ones(len(a), bool)
        new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
        smallest = doc[order][new][np.cumsum(new) - 1]
        later = np.empty(len(a), bool)
        later[order] = smallest < doc[order]
        ends = np.cumsum([0, *map(len, firsts)])
        return pa.table({
            "pack": group.column("pack"), "shard": group.column("shard"),
            "bits": pa.array([P.bits(later[x:y]) for x, y in zip(ends, ends[1:])], pa.binary()),
        })

    sent = P.each_pack(P.with_answers(packs, counted), send, "shard int, pack long, first binary, second binary, doc binary")
    decided = sent.groupBy("shard").applyInArrow(decide, "pack long, shard int, bits binary")
    out_schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                               T.StructField("kept_text", T.StringType()), T.StructField("kept_sha256", T.StringType())])
    inner = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(out_schema.fields)])

    def cut(number: int, table: pa.Table, told: dict[int, bytes], later: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        own = Windows(table, id_at, text_at, window)
        chosen = own.repeated(told, key_bits, shards)
        a, _, doc, place = own.distinct(chosen)
        ends = [0, *np.searchsorted(a, edges).tolist(), len(a)]
        elsewhere = np.zeros(len(a), bool)
        for s, (x, y) in enumerate(zip(ends, ends[1:])):
            if x < y:
                elsewhere[x:y] = P.unbits(later[s], y - x)
        gone = chosen[elsewhere[place] | (doc[place] < own.doc[chosen])]
        change = np.zeros(own.first[-1] + 1, np.int64)
        np.add.at(change, own.start[gone], 1)
        np.add.at(change, own.start[gone] + window, -1)
        removed = np.cumsum(change)[:-1] > 0
        n_words, n_removed, texts, digests = [], [], [], []
        for i, words in enumerate(own.words):
            drop = removed[own.first[i]:own.first[i + 1]]
            count = int(drop.sum())
            kept = b" ".join([w for w, d in zip(words, drop.tolist()) if not d] if count else words)
            n_words.append(len(words))
            n_removed.append(count)
            texts.append(kept)
            digests.append(hashlib.sha256(kept).hexdigest())
        columns = [*table.columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                   pa.array(texts, pa.binary()).cast(pa.string()), pa.array(digests)]
        yield from pa.table(columns, names=[f"c{i}" for i in range(len(columns))]).to_batches(P.ROWS_PER_BATCH)

    done = P.each_pack(P.with_answers(packs, counted, decided), cut, inner)
    return done.toDF(*out_schema.names)
