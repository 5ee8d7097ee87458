"""Suffix-array dedup of byte strings.

``suffix_array`` is the linear grouping construction: suffixes are grouped by their longest Lyndon prefix, group by group
in descending order through pointers to the previous smaller suffix; then each group's order is emitted in one ascending
sweep. Nothing is renamed or solved recursively.

``dedup`` finds the bytes covered by a string of ``length`` bytes that also starts in a document with a smaller id:

1. Each string of ``length`` bytes is represented by one of its grams (the one with the smallest hash, the leftmost of
   equals). Equal strings have equal grams, so a string whose gram occurs in no other document is unique. Packs ask which
   of their grams others hold (``packs.shared_keys``).
2. The strings around one shared gram form a segment (their overlap, written once). Equal segments of a pack travel as one,
   with the smallest id. All segments of a gram meet in one shard. (Strings of a gram that ``COMMON`` documents or more hold
   are sent one by one and meet by their own hash instead.)
3. In a shard, equal segments are one text with its smallest id, which decides for all its strings. Strings can also be shared
   by different texts around one gram. A text is first cut to what it has in common with any other text on either side of
   the gram; strings beyond that are in no other text. A suffix array over all the cut texts brings equal strings
   together, and the smallest id among them decides.
4. The answer, a bit per string, goes back to the packs.

Null text counts as empty. A null id counts as later than all others; rows that repeat an id never remove each other's
bytes. Extra columns pass through, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, types as T

from roadflux import workspace
from roadflux.llm import packs as P

LENGTH = 50
GRAM = 24
COMMON = 5000  # documents that make a gram common
BYTES_PER_SHARD = 8 << 20
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def suffix_array(symbols: list[int]) -> list[int]:
    """Start positions of all suffixes in ascending order; a suffix that is a prefix of another comes first.

    Symbols are non-negative integers. Works on positions 0..n of the text with an end mark below every symbol.
    """
    text = [s + 1 for s in symbols]
    text.append(0)
    n = len(text)
    # Groups by first symbol: order[] holds the suffixes by group, start/size describe the group that begins there.
    counts = [0] * (max(text) + 1)
    for c in text:
        counts[c] += 1
    begin, at = [0] * len(counts), 0
    for c, k in enumerate(counts):
        begin[c] = at
        at += k
    group = [begin[c] for c in text]
    size = [0] * n
    for c, k in enumerate(counts):
        if k:
            size[begin[c]] = k
    order, place, fill = [0] * n, [0] * n, list(begin)
    for i, c in enumerate(text):
        k = fill[c]
        order[k] = i
        place[i] = k
        fill[c] = k + 1
    previous = [-1] * n
    end = n
    while end:
        start = group[order[end - 1]]
        if start == end - 1:  # most groups: one suffix, one previous smaller suffix to move
            end = start
            i = order[start]
            p = i - 1
            while p >= 0:
                g = group[p]
                if g < start:
                    previous[i] = p
                    left = size[g] - 1
                    if left:
                        size[g] = left
                        last = g + left
                        q, k = order[last], place[p]
                        order[last], order[k] = p, q
                        place[p], place[q] = last, k
                        size[last] = 1
                        group[p] = last
                    break
                p = previous[p]
            continue
        members = order[start:end]
        members.sort()
        children: dict[int, int] = {}
        # the nearest suffix to the left in a smaller group; larger groups already know theirs
        for i in members:
            p = i - 1
            while p >= 0:
                g = group[p]
                if g < start:
                    break
                p = previous[p]
            previous[i] = p
            if p >= 0:
                children[p] = children.get(p, 0) + 1
        if children:
            most = max(children.values())
            by_count = [list(children)] if most == 1 else [[] for _ in range(most)]
            if most > 1:
                for p, k in children.items():
                    by_count[most - k].append(p)
            # more children of this group rank higher; each subset leaves its old groups as new groups above them
            for subset in by_count:
                touched: dict[int, int] = {}
                for p in subset:
                    g = group[p]
                    left = size[g] - 1
                    size[g] = left
                    last = g + left
                    q, k = order[last], place[p]
                    order[last], order[k] = p, q
                    place[p], place[q] = last, k
                    touched[g] = touched.get(g, 0) + 1
                for g, moved in touched.items():
                    top = g + size[g]
                    size[top] = moved
                    for p in order[top:top + moved]:
                        group[p] = top
        end = start
    # Ascending sweep: what a placed suffix follows directly is next in its own group.
    out, done = [0] * n, bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    slot = list(range(n))
    for k in range(n):
        s = out[k] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[slot[g]] = s
            slot[g] += 1
            done[s] = 1
            s = previous[s]
    return out[1:]


def smallest_owner(texts: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """For each string of ``length`` bytes in each text, the smallest owner of a text that holds it."""
    joined = b"".join([t + b"\x00" for t in texts])
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1) - 1
    symbols = data.astype(np.int64) + 1
    symbols[ends] = 0
    order = np.array(suffix_array(symbols.tolist()), np.int64)
    room = np.repeat(ends, sizes + 1) - np.arange(len(data))
    order = order[room[order] >= length]
    owner = np.repeat(owners, sizes + 1)
    best = np.full(len(data), P.NO_ID, np.int64)
    if len(order):
        padded = np.concatenate([data, np.zeros(length, np.uint8)])
        same = np.ones(len(order) - 1, bool)
        for k in [*range(0, length - 7, 8), length - 8] if length >= 8 else range(length):
            part = np.ndarray((len(data),), "<u8" if length >= 8 else np.uint8, padded, k, (1,))[order]
            same &= part[1:] == part[:-1]
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        lowest = np.minimum.reduceat(owner[order], starts)
        best[order] = np.repeat(lowest, np.diff(starts, append=len(order)))
    begins = ends - sizes
    return [best[b:b + n - length + 1] for b, n in zip(begins.tolist(), sizes.tolist())]


Text = tuple[int, int, bytes]  # cell of the gram, bytes before the gram, bytes


def common_stretches(texts: list[tuple[int, bytes]], length: int) -> list[tuple[int, int]]:
    """For texts (bytes before the gram, bytes) around one gram: the stretch [from, to) outside of which no string of
    ``length`` bytes is in another of the texts; empty if none is at all."""
    width = max(len(t) for _, t in texts)

    def longest(sides: list[bytes]) -> list[int]:
        """Of each side, the longest prefix that another side has."""
        order = sorted(range(len(sides)), key=sides.__getitem__)
        numbers = [int.from_bytes(s.ljust(width, b"\x00")) for s in sides]
        out = [0] * len(sides)
        for a, b in zip(order, order[1:]):
            same = min(width - ((numbers[a] ^ numbers[b]).bit_length() + 7) // 8, len(sides[a]), len(sides[b]))
            if same > out[a]:
                out[a] = same
            if same > out[b]:
                out[b] = same
        return out

    before = longest([t[:left][::-1] for left, t in texts])
    after = longest([t[left:] for left, t in texts])
    return [(left - x, left + y) if x + y >= length else (0, 0) for (left, _), x, y in zip(texts, before, after)]


_string_hash = xxhash.xxh3_64_intdigest
_AT_ONCE = 1 << 14  # strings at once: what is computed for them stays in the processor's cache


def _representatives(padded: np.ndarray, windows: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the gram at each position, and for each string the position of its gram: smallest hash, then leftmost."""
    width = length - gram + 1
    hashed, chosen = np.empty(windows + width - 1, np.uint64), np.empty(windows, np.int64)
    high = np.uint64(0xFFFFFFFF00000000)
    for start in range(0, windows, _AT_ONCE):
        n = min(_AT_ONCE, windows - start)
        h = np.zeros(n + width - 1, np.uint64)
        for k in [*range(0, gram - 7, 8), *([gram - 8] if gram % 8 else [])]:
            h ^= np.ndarray((len(h),), "<u8", padded, start + k, (1,))
            h *= _C1
            h ^= h >> np.uint64(29)
        h *= _C2
        h ^= h >> np.uint64(32)
        hashed[start:start + len(h)] = h
        # 32 bits of the hash, then of the position
        low = (h & high) | np.arange(start, start + len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
        chosen[start:start + n] = low & np.uint64(0xFFFFFFFF)
    return hashed, chosen


class Segments:
    """Strings of a pack by representative gram: parallel arrays over maximal runs of strings that share one."""

    def __init__(self, table: pa.Table, id_at: int, text_at: int, length: int, gram: int):
        self.length = length
        self.ids = P.ids_of(table, id_at)
        texts = [(t.as_py() or "").encode() for t in table.column(text_at)]
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])
        self.data = b"".join(texts)
        windows = len(self.data) - length + 1
        self.start = self.count = self.doc = self.left = np.zeros(0, np.int64)
        self.hash = np.zeros(0, np.uint64)
        if windows <= 0:
            return
        hashed, chosen = _representatives(np.frombuffer(self.data + b"\x00" * 8, np.uint8), windows, length, gram)
        row = np.repeat(np.arange(len(texts)), self.sizes)
        valid = row[:windows] == row[length - 1:]
        cut = np.ones(windows, bool)
        cut[1:] = (chosen[1:] != chosen[:-1]) | (row[1:windows] != row[:windows - 1])
        cut |= ~valid
        begins = np.flatnonzero(cut)
        lengths = np.diff(begins, append=windows)
        keep = valid[begins]
        self.start, self.count = begins[keep], lengths[keep]
        self.doc = row[self.start]
        self.left = chosen[self.start] - self.start  # bytes of the segment before the gram
        self.hash = hashed[chosen[self.start]] * _C3

    def cells(self, key_bits: int) -> np.ndarray:
        return self.hash >> np.uint64(64 - key_bits)

    def grams(self, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
        return P.holders(self.cells(key_bits), self.doc)

    def shared(self, told: dict[int, bytes], key_bits: int, shards: int) -> np.ndarray:
        """Segments whose gram other documents hold. Strings of a common gram become segments of their own, which stand
        for themselves: no shard then gets all that surrounds such a gram."""
        cells, _ = self.grams(key_bits)
        if not len(cells):
            return np.zeros(0, np.int64)
        at = np.searchsorted(cells, self.cells(key_bits))
        kept = P.flags_of(told, cells, key_bits, shards)[at]
        common = P.flags_of(told, cells, key_bits, shards, question=1)[at]
        plain, split = np.flatnonzero(kept & ~common), np.flatnonzero(kept & common)
        if len(split):
            counts = self.count[split]
            start = np.repeat(self.start[split] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            own = [_string_hash(self.data[a:a + self.length]) for a in start.tolist()]
            doc, ones = np.repeat(self.doc[split], counts), np.ones(len(start), np.int64)
            self.hash = np.concatenate([self.hash[plain], np.array(own, np.uint64)])
            self.start, self.doc = np.concatenate([self.start[plain], start]), np.concatenate([self.doc[plain], doc])
            self.count, self.left = np.concatenate([self.count[plain], ones]), np.concatenate([self.left[plain], 0 * ones])
            return np.arange(len(self.start))
        return plain

    def texts(self, chosen: np.ndarray, key_bits: int) -> tuple[list[Text], list[int], np.ndarray]:
        """Distinct texts of the chosen segments by cell, the smallest id of each, and each segment's place."""
        data, found = self.data, self.cells(key_bits)[chosen]
        order = np.argsort(found, kind="stable")
        at = chosen[order]
        start = self.start[at]
        keys = zip(found[order].tolist(), self.left[at].tolist(),
                   [data[a:b] for a, b in zip(start.tolist(), (start + self.count[at] + self.length - 1).tolist())])
        number: dict[Text, int] = {}
        place = np.empty(len(chosen), np.int64)
        place[order] = np.fromiter((number.setdefault(key, len(number)) for key in keys), np.int64, len(chosen))
        smallest = np.full(len(number), P.NO_ID, np.int64)
        np.minimum.at(smallest, place, self.ids[self.doc[chosen]])
        return list(number), smallest.tolist(), place


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
          pack_bytes: int = P.PACK_BYTES, common: int = COMMON) -> DataFrame:
    """All columns, plus n_bytes, n_removed, n_spans (removed runs), kept (remaining bytes) and kept_sha256.

    ``length`` is at least ``gram``, and ``gram`` at least 8.
    """
    added = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept", T.BinaryType()),
             ("kept_sha256", T.StringType())]
    docs = docs.drop(*[name for name, _ in added if name in docs.columns])
    packs = P.pack(docs, id_col, text_col, pack_bytes)
    id_at, text_at = packs.id_at, packs.text_at
    key_bits = P.cell_bits(packs.text_bytes // 8)
    shards = packs.shards(BYTES_PER_SHARD)
    edges = P.shard_edges(key_bits, shards)

    def grams(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return Segments(table, id_at, text_at, length, gram).grams(key_bits)

    shared = workspace.written(P.shared_keys(packs, grams, key_bits, shards, common), "gram-answers")

    def by_shard(ordered: list[Text]) -> list[tuple[int, int, int]]:
        cells = np.array([t[0] for t in ordered], np.uint64)
        ends = [0, *np.searchsorted(cells, edges).tolist(), len(cells)]
        return [(s, x, y) for s, (x, y) in enumerate(zip(ends, ends[1:])) if x < y]

    def send(number: int, table: pa.Table, told: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        own = Segments(table, id_at, text_at, length, gram)
        ordered, smallest, _ = own.texts(own.shared(told, key_bits, shards), key_bits)
        rows = by_shard(ordered)
        if rows:
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([s for s, _, _ in rows], pa.int32()),
                "pack": pa.array([number] * len(rows), pa.int64()),
                "cells": pa.array([P.squeeze(np.array([t[0] for t in ordered[x:y]], np.uint64)) for _, x, y in rows], pa.binary()),
                "lefts": pa.array([np.array([t[1] for t in ordered[x:y]], np.uint16).tobytes() for _, x, y in rows], pa.binary()),
                "sizes": pa.array([np.array([len(t[2]) for t in ordered[x:y]], np.uint32).tobytes() for _, x, y in rows], pa.binary()),
                "texts": pa.array([zstandard.ZstdCompressor(level=1).compress(b"".join([t[2] for t in ordered[x:y]])) for _, x, y in rows], pa.binary()),
                "docs": pa.array([np.array(smallest[x:y], np.int64).tobytes() for _, x, y in rows], pa.binary()),
            })

    def decide(group: pa.Table) -> pa.Table:
        number: dict[Text, int] = {}  # of the distinct texts
        lowest: list[int] = []
        entries: list[tuple[np.ndarray, np.ndarray]] = []
        unpack = zstandard.ZstdDecompressor()
        for r in range(group.num_rows):
            row = {name: group.column(name)[r].as_py() for name in ("cells", "lefts", "sizes", "texts", "docs")}
            ends = np.cumsum(np.frombuffer(row["sizes"], np.uint32)).tolist()
            joined, docs = unpack.decompress(row["texts"]), np.frombuffer(row["docs"], np.int64)
            own = []
            for cell, left, a, b, doc in zip(P.unsqueeze(row["cells"]).tolist(), np.frombuffer(row["lefts"], np.uint16).tolist(),
                                             [0, *ends], ends, docs.tolist()):
                key = (cell, left, joined[a:b])
                k = number.setdefault(key, len(lowest))
                if k == len(lowest):
                    lowest.append(doc)
                elif doc < lowest[k]:
                    lowest[k] = doc
                own.append(k)
            entries.append((np.array(own, np.int64), docs))
        # the smallest id of every string of every distinct text; its text's, unless another text has the string too
        keys = list(number)
        strings = np.array([len(t) - length + 1 for _, _, t in keys], np.int64)
        offset = np.concatenate([[0], np.cumsum(strings)])
        best = np.repeat(np.array(lowest, np.int64), strings)
        by_cell: dict[int, list[int]] = {}
        for k, (cell, _, _) in enumerate(keys):
            by_cell.setdefault(cell, []).append(k)
        owner: dict[bytes, int] = {}
        cut: list[tuple[int, int, bytes]] = []
        for members in by_cell.values():
            if len(members) > 1:
                for k, (x, y) in zip(members, common_stretches([keys[k][1:] for k in members], length)):
                    if x < y:
                        text = keys[k][2][x:y]
                        cut.append((k, x, text))
                        if lowest[k] < owner.get(text, P.NO_ID + 1):
                            owner[text] = lowest[k]
        if cut:
            texts = list(owner)
            found = dict(zip(texts, smallest_owner(texts, np.array([owner[t] for t in texts], np.int64), length)))
            for k, x, text in cut:
                at = offset[k] + x
                best[at:at + len(found[text])] = found[text]
        answers = []
        for own, docs in entries:
            counts = strings[own]
            at = np.repeat(offset[own] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            answers.append(P.bits(best[at] < np.repeat(docs, counts)))
        return pa.table({"pack": group.column("pack"), "shard": group.column("shard"), "bits": pa.array(answers, pa.binary())})

    sent = P.each_pack(P.with_answers(packs, shared), send,
                       "shard int, pack long, cells binary, lefts binary, sizes binary, texts binary, docs binary")
    decided = sent.groupBy("shard").applyInArrow(decide, "pack long, shard int, bits binary")
    out_schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in added]])
    inner = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(out_schema.fields)])

    def cut(number: int, table: pa.Table, told: dict[int, bytes], later: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        own = Segments(table, id_at, text_at, length, gram)
        chosen = own.shared(told, key_bits, shards)
        ordered, smallest, place = own.texts(chosen, key_bits)
        strings = np.array([len(t) - length + 1 for _, _, t in ordered], np.int64)
        offset = np.concatenate([[0], np.cumsum(strings)])
        elsewhere = np.zeros(offset[-1], bool)
        for s, x, y in by_shard(ordered):
            elsewhere[offset[x]:offset[y]] = P.unbits(later[s], int(offset[y] - offset[x]))
        gone = np.zeros(len(own.data) + 1, bool)
        if len(chosen):
            # Strings of one pack meet again here only if their texts are equal; the shard has judged all others.
            before = np.array(smallest, np.int64)[place] < own.ids[own.doc[chosen]]
            counts = own.count[chosen]
            at = np.repeat(own.start[chosen] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            source = np.repeat(offset[place] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            gone[at] = elsewhere[source] | np.repeat(before, counts)
        change = np.zeros(len(own.data) + length + 1, np.int64)
        starts = np.flatnonzero(gone)
        change[starts] += 1
        change[starts + length] -= 1
        removed = np.cumsum(change)[:len(own.data)] > 0
        data = np.frombuffer(own.data, np.uint8)
        n_removed, n_spans, kept, digests = [], [], [], []
        for a, b in zip(own.begins.tolist(), own.begins[1:].tolist()):
            drop = removed[a:b]
            n_removed.append(int(drop.sum()))
            n_spans.append(int(drop[:1].sum() + (drop[1:] & ~drop[:-1]).sum()))
            left = data[a:b][~drop].tobytes()
            kept.append(left)
            digests.append(hashlib.sha256(left).hexdigest())
        columns = [*table.columns, pa.array(own.sizes), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                   pa.array(kept, pa.binary()), pa.array(digests)]
        yield from pa.table(columns, names=[f"c{i}" for i in range(len(columns))]).to_batches(P.ROWS_PER_BATCH)

    done = P.each_pack(P.with_answers(packs, shared, decided), cut, inner)
    return done.toDF(*out_schema.names)
