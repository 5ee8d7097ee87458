"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are shuffled by their full text first, with counts combined before the shuffle, so that copies cost one count. Each distinct
text is tokenised and aligned once, and pair counts are weighted by its number of copies; the measures are joined to the
documents at the end.

A text is encoded as a space and the text by A (byte-level BPE, a file of the ``tokenizers`` library) and as the text by B (a
``sentencepiece`` model, which adds the space), without special tokens; their strings inside texts are plain text. Tokens are
bytes: A's entry byte-level decoded; B's piece in UTF-8 with U+2581 as space and <0xHH> as that byte. Where the joined bytes of
either differ from the space and the text, and for null and empty texts, there are no tokens (zeros, an empty digest).

* Offsets at which tokens of A and of B end cut both into groups.
* A link is a pair of token occurrences whose byte ranges overlap. All end offsets of both sides together cut the text into
  intervals, one for each link.
* The count of an id pair is the number of documents that hold it linked, copies included; a link is best if its pair's count is
  the highest that the id of A has, ties included.

Pair counts: the ``HOT`` most frequent pairs at most (cut at a step of a logarithmic histogram, 17 bytes each) go to every task;
links of all other pairs meet their counts by a join. So frequent pairs are never shuffled by key, and no size is assumed for
the rest. Texts of which there are very many copies (a thousandth of all documents each, so a thousand texts at most) are
broadcast to their documents; all others are joined.

Texts are cut into parts where a single space stands between a word's end and a letter or digit: neither tokenizer has tokens across it
(A's words begin at the space; of B's pieces none has a space after another character, which is checked), so the tokens are those of
the whole text. Tasks take texts in slices of about ``SLICE`` bytes and tokenise and align each distinct part once, known ones not
again; a long text is a slice of its own. Repeated rows and ids get a row each. Columns other than
the two named are not used. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadflux import workspace

SLICE = 4 << 20
BLOCK = 4096
KNOWN, KNOWN_BYTES = 500_000, 64 << 20
HOT = 1 << 19
COPIES, LEAST_COPIES = 1000, 100
_BETWEEN = re.compile(r"(?<=[\w.,;:!?)'\"-]) (?=\w)")
_ALIGNED = ("key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs array<bigint>, times array<int>")


def parts(text: str) -> list[str]:
    """The text cut at single spaces before letters and digits, which are left out: both tokenizers put one before every part."""
    return _BETWEEN.split(text)


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class Tokenizers:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        letters = _byte_letters()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.size_b = len(pieces)
        self.lengths_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.parts = Parts(self)
        # Ids as text with what follows them: in a group "," and at its end "|" after A and ";" after B.
        self.shown = [b"%d%c" % (i, mark) for n, marks in ((len(self.bytes_a), b",|"), (self.size_b, b",;")) for mark in marks for i in range(n)]

    def encoded(self, distinct: list[str]) -> tuple[list[int], list[int], np.ndarray]:
        """Ids by A and by B of all parts, one after the other, and the bytes that each part has there: none if it is not spelt."""
        ids_a, ids_b, size = [], [], np.array([1 + len(p.encode()) for p in distinct], np.int64)
        step = BLOCK if self.separable else 1
        for k in range(0, len(distinct), step):
            held = distinct[k:k + step]
            both = self._spelling(" ".join(held))
            if both is not None:
                ids_a += both[0]
                ids_b += both[1]
                continue
            for n, part in enumerate(held, k):
                both = self._spelling(part)
                if both is None:
                    size[n] = 0
                else:
                    ids_a += both[0]
                    ids_b += both[1]
        return ids_a, ids_b, size

    def _spelling(self, text: str) -> tuple[list[int], list[int]] | None:
        a, b = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)
        data = b" " + text.encode()
        spelt = b"".join(map(self.bytes_a.__getitem__, a)) == data and b"".join(map(self.bytes_b.__getitem__, b)) == data
        return (a, b) if spelt else None


@functools.lru_cache(maxsize=1)
def _loaded(a: bytes, b: bytes) -> Tokenizers:
    return Tokenizers(a, b)


class Parts:
    """Parts aligned once each: counts of tokens and groups, their groups as text, and their links as pairs.

    Parts stay known over slices and tasks of a process, up to ``KNOWN`` of them or ``KNOWN_BYTES``; then it begins anew.
    """

    def __init__(self, tok: Tokenizers):
        self.tok = tok
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.bytes, self.shown = 0, []
        self.spelt, self.links = np.zeros(0, bool), np.zeros(0, np.int64)
        self.n_a, self.n_b, self.n_links, self.n_groups, self.first_link = (np.zeros(0, np.int64) for _ in range(5))

    def places(self, distinct: list[str]) -> np.ndarray:
        if len(self.at) + len(distinct) > KNOWN or self.bytes > KNOWN_BYTES:
            self._forget()
        new = [p for p in distinct if p not in self.at]
        if new:
            self._add(new)
        return np.fromiter(map(self.at.__getitem__, distinct), np.int64, len(distinct))

    def _add(self, new: list[str]) -> None:
        tok = self.tok
        ids_a, ids_b, bytes_of = tok.encoded(new)
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(tok.lengths_a[a]), np.cumsum(tok.lengths_b[b])
        is_a, is_b = np.zeros(int(bytes_of.sum()) + 1, bool), np.zeros(int(bytes_of.sum()) + 1, bool)
        is_a[ends_a], is_b[ends_b] = True, True
        ends, cuts = np.flatnonzero(is_a | is_b), np.flatnonzero(is_a & is_b)

        limits = np.cumsum(bytes_of)  # where each part ends
        if not (is_a & is_b)[limits[limits > 0]].all():
            raise ValueError("tokens reach over a space between words; these tokenizers are not of the kinds described above")
        in_part = lambda ends: np.diff(np.searchsorted(ends, limits, side="right"), prepend=0)
        n_a, n_b, n_links, n_groups = (in_part(e) for e in (ends_a, ends_b, ends, cuts))
        both = lambda old, more: np.concatenate([old, more])
        self.first_link = both(self.first_link, len(self.links) + np.cumsum(n_links) - n_links)
        self.links = both(self.links, a[np.searchsorted(ends_a, ends)] * tok.size_b + b[np.searchsorted(ends_b, ends)])
        self.n_a, self.n_b, self.n_links, self.n_groups = both(self.n_a, n_a), both(self.n_b, n_b), both(self.n_links, n_links), both(self.n_groups, n_groups)
        self.spelt = both(self.spelt, bytes_of > 0)
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
        self.bytes += int(bytes_of.sum())

        # Groups in order, A before B in each; ids of a group keep their order, since the sort is stable.
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        last = is_a & is_b
        marks = np.concatenate([a + last[ends_a] * len(tok.bytes_a), 2 * len(tok.bytes_a) + b + last[ends_b] * tok.size_b])[order].tolist()
        cut = [0, *np.cumsum(n_a + n_b).tolist()]
        self.shown += [b"".join(map(tok.shown.__getitem__, marks[x:y])) for x, y in zip(cut, cut[1:])]


def aligned(tok: Tokenizers, texts: list[str]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each text; a pair is A's id times B's size plus B's id.

    Parts that are equal, in one text or in several, are aligned once. Every part ends a token of both sides, so a text's groups and links
    are those of its parts in turn.
    """
    cut = [(parts(t) if tok.separable else [t]) if t else [] for t in texts]
    coded = pa.array(list(itertools.chain.from_iterable(cut)), pa.string()).dictionary_encode()
    own = tok.parts
    ids, until = own.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()], np.cumsum([len(c) for c in cut]).tolist()
    done, begun = [], 0
    for end in until:
        at, begun = ids[begun:end], end
        if not len(at) or not own.spelt[at].all():
            done.append((0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32)))
            continue
        shown = b"".join(map(own.shown.__getitem__, at.tolist()))
        # Links of all parts, one after the other.
        sizes = own.n_links[at]
        ahead = np.cumsum(sizes) - sizes
        links = own.links[np.repeat(own.first_link[at] - ahead, sizes) + np.arange(sizes.sum())]
        pairs, times = np.unique(links, return_counts=True)
        done.append((int(own.n_a[at].sum()), int(own.n_b[at].sum()), int(own.n_groups[at].sum()), len(links), hashlib.sha256(shown[:-1]).hexdigest(), pairs, times.astype(np.int32)))
    return done


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]), kind))


def _aligned_texts(texts: DataFrame, files) -> DataFrame:
    """A row per distinct text: copies, measures, its distinct pairs (ascending) and how often each is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _loaded(*files.value)
        for batch in batches:
            first = size = 0
            for k in range(batch.num_rows):
                size += len(batch.column(2)[k].as_buffer())
                if size < SLICE and k + 1 < batch.num_rows:
                    continue
                piece = batch.slice(first, k + 1 - first)
                first, size = k + 1, 0
                columns = list(zip(*aligned(tok, piece.column(2).to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string()),
                     _lists(columns[5], pa.int64()), _lists(columns[6], pa.int32())],
                    [f.split()[0] for f in _ALIGNED.split(", ")])

    return texts.mapInArrow(run, _ALIGNED)


def _hot(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, at most ``most``, ascending, with their counts and whether they are best."""
    step = F.floor(F.log2("n") * 8)
    heights = sorted(((r.step, r.m) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("m")).collect()), reverse=True)  # 8 rows per power of two
    total, bound = 0, None
    for at, m in heights:
        total += m
        if total > most:
            break
        bound = at
    if bound is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    table = counts.where(step >= bound).select("pair", "n", "best").toArrow()
    pair, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    return pair[order], n[order], best[order].astype(bool)


def _measured(own: DataFrame, hot) -> DataFrame:
    """(key, n_best, count_sum, rest, rest_times): sums over links of frequent pairs, and the pairs that are not among those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = hot.value
        for batch in batches:
            pairs, times = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(np.int64)
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            place = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            found = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
            sums, bests = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            if found.any():
                np.add.at(sums, row[found], times[found] * n[place[found]])
                np.add.at(bests, row[found], times[found] * best[place[found]])
            left = np.concatenate([[0], np.cumsum(np.bincount(row[~found], minlength=batch.num_rows))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(left), pa.array(x[~found], t)) for x, t in ((pairs, pa.int64()), (times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bests), pa.array(sums), *lists], ["key", "n_best", "count_sum", "rest", "rest_times"])

    rows = own.where("n_links > 0").select("key", "pairs", "times")
    return rows.mapInArrow(run, "key binary, n_best long, count_sum long, rest array<bigint>, rest_times array<bigint>")


def align(docs: DataFrame, a: bytes, b: bytes, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): a row per document.

    ``a`` and ``b`` are the contents of the two tokenizer files; they travel to the tasks as a broadcast of that size.
    """
    spark = docs.sparkSession
    context, tok = spark.sparkContext, _loaded(a, b)
    key = F.when(F.length(text_col) > 0, F.unhex(F.sha2(text_col, 256))).alias("key")
    named = workspace.written(docs.select(F.col(id_col).cast("long").alias("doc_id"), key), "document-texts")
    texts = docs.where(F.length(text_col) > 0).groupBy(F.col(text_col).alias("text")).agg(F.count("*").alias("copies"))
    texts = texts.select(F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text")
    own = _stored(_aligned_texts(texts, context.broadcast((a, b))), "aligned-texts")

    counts = own.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("n"))
    counts = workspace.written(counts.withColumn("a", F.floor(F.col("pair") / F.lit(tok.size_b)).cast("long")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))  # a row per entry of A
    counts = counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    measured = workspace.written(_measured(own, context.broadcast(_hot(counts, hot))), "measured-texts")

    rest = measured.select("key", F.explode(F.arrays_zip("rest", "rest_times")).alias("x")).select("key", F.col("x.rest").alias("pair"), F.col("x.rest_times").alias("times"))
    rest = rest.join(counts, "pair").select("key", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    sums = measured.select("key", "n_best", "count_sum").unionByName(rest).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    of_text = own.select("key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "key", "left")
    of_text = workspace.written(of_text, "text-measures")

    many = F.col("copies") > max(LEAST_COPIES, named.count() // COPIES)
    copied = F.broadcast(of_text.where(many))  # fewer than COPIES rows
    others = of_text.where(~many)
    in_copied, without = F.broadcast(of_text.where(many).select("key")), named.where(F.col("key").isNull())
    joined = named.join(copied, "key").unionByName(named.join(in_copied, "key", "left_anti").where(F.col("key").isNotNull()).join(others, "key"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    whole = joined.select("doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers], "groups_sha256")
    return whole.unionByName(without.select("doc_id", *[F.lit(0).cast("long").alias(c) for c in numbers], F.lit("").alias("groups_sha256")))


def _stored(rows: DataFrame, label: str) -> DataFrame:
    """As ``workspace.written``, packed tighter: most of it is sorted numbers."""
    path = workspace.fresh_path(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
