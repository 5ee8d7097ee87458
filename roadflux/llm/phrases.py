"""Phrase collocations by best-first branch-and-bound growth.

A-Z are lower-cased, texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``. Everything is
counted per language. f(phrase) is the number of its occurrences as adjacent words of a piece, overlaps included. Phrases of two
or three words with a = f(phrase) of at least ``least`` are candidates. Cut after its first k words a candidate has the score
floor(1000000 a a / (l r)), l and r the counts of both parts; its lowest-scoring cut counts (ties: the smallest k). A two-word
candidate is dropped if a three-word candidate that holds it has half its count or more.

Phrases grow word by word, and the count of a prefix bounds what can grow out of it:

* a phrase occurs at most as often as its parts, so only words and pairs that occur ``least`` times are grown at all;
* with l = f(w) and r >= a, no phrase that begins with the pair (w, v) scores above floor(1000000 f(w v) / f(w)).

So after words and pairs are counted, the frontier (pairs by that bound) is expanded from the best on: down to a floor, per language,
which is the score that ``most`` pairs reach. Three-word phrases are counted only for prefixes whose bound reaches the floor, and for
suffixes whose own score does (whether those pairs survive depends on them). If a language then has ``most`` survivors at or above its
floor, all of them, ties included, are known and no unexpanded prefix can reach the last one: it is settled. Otherwise its floor
is lowered to a score that four times as many pairs reach, until it is settled or everything is expanded.

Counting: each task sums up stretches of ``CHUNK`` bytes, so a frequent phrase sends one row per stretch, and Spark adds those up. What
need not be counted is left out by bitmaps of ``BITS`` bits (8 MB, whatever the input; false hits only cost time, exact joins decide).
Ranks use a histogram of scores, at most a million and one rows a language.

A null text is empty, a null language is ``und``. Rows without words add nothing; repeated rows count each. Whole texts of any
length are read in stretches. Columns other than the two named are not used, so extra ones may have any name. Empty tables give an
empty result. Counts must stay below 10^16. Phrases with equal score and count are ordered by their UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadflux import workspace

LEAST = 10
MOST = 2000
CHUNK = 4 << 20
BITS = 1 << 26
MILLION = 1_000_000
# What ends a piece, and the letters that are lower-cased. 0xFF is no byte of UTF-8 and stands for every end.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_END = b"\xff"
_PLAIN = bytes.maketrans(ENDS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _END * len(ENDS) + b"abcdefghijklmnopqrstuvwxyz")
_GAP = re.compile(rb"[\x20\x09\xff]")


def stretches(data: bytes, size: int, chunk: int = CHUNK) -> Iterator[list[bytes]]:
    """The words and ends of ``data`` in lists; each begins with the last ``size`` - 1 of the one before, so that every phrase
    of ``size`` words is in exactly one list."""
    data, at, carry = data.translate(_PLAIN), 0, []
    while at < len(data):
        gap = _GAP.search(data, at + chunk)
        end = gap.start() if gap else len(data)
        words = carry + data[at:end].replace(_END, b" \xff ").split()
        yield words
        carry, at = words[len(words) - size + 1:] if size > 1 else [], end


def _by_language(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[tuple[str, bytes]]:
    """The texts of a task, joined per language to stretches of about ``chunk`` bytes."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            data = text.as_py()
            if data is not None:
                held.setdefault(lang.as_py(), []).append(data)
                size += len(data)
                if size >= chunk:
                    yield from ((k, _END.join(v)) for k, v in held.items())
                    held, size = {}, 0
    yield from ((k, _END.join(v)) for k, v in held.items())


def _on(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)


def _cells(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return ((first >> np.uint64(17) ^ second) & np.uint64(BITS - 1)).astype(np.int64)


def _counted(docs: DataFrame, size: int, words=None, grown=None, chunk: int = CHUNK) -> DataFrame:
    """(lang, w1.., n): occurrences of phrases of ``size`` words. ``words`` is the bitmap of words worth counting; ``grown`` has
    those of all pairs, of prefixes to expand, and of suffixes whose extensions are wanted."""
    names = ["lang", *[f"w{k + 1}" for k in range(size)], "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in _by_language(batches, chunk):
            seed = xxhash.xxh64_intdigest(lang, 42)
            for tokens in stretches(data, size, chunk):
                coded = pa.array(tokens, pa.binary()).dictionary_encode()
                own, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
                end = pc.index(own, _END).as_py()
                fits = np.ones(len(own), bool)
                if end >= 0:
                    fits[end] = False
                if words is not None or grown is not None:
                    hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in own.to_pylist()], np.uint64)
                    if words is not None:
                        fits &= _on(words.value, (hashes & np.uint64(BITS - 1)).astype(np.int64))
                if len(ids) < size:
                    continue
                parts = [ids[k:len(ids) - size + 1 + k] for k in range(size)]
                kept = np.logical_and.reduce([fits[p] for p in parts])
                parts = [p[kept] for p in parts]
                if grown is not None:
                    pairs, prefixes, suffixes = (b.value for b in grown)
                    left, right = _cells(hashes[parts[0]], hashes[parts[1]]), _cells(hashes[parts[1]], hashes[parts[2]])
                    kept = _on(pairs, left) & _on(pairs, right)
                    kept[kept] = _on(prefixes, left[kept]) | _on(suffixes, right[kept])
                    parts = [p[kept] for p in parts]
                key = parts[0]
                for p in parts[1:]:
                    key = key * len(own) + p
                found, times = np.unique(key, return_counts=True)
                columns = []
                for _ in range(size):
                    found, at = np.divmod(found, len(own))
                    columns.append(own.take(pa.array(at)).cast(pa.string()))
                if len(times):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(times)), *columns[::-1], pa.array(times.astype(np.int64))], names)

    schema = ", ".join(f"{c} {'long' if c == 'n' else 'string'}" for c in names)
    return docs.mapInArrow(run, schema).groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


def _bitmap(rows: DataFrame, cell: Column):
    """The cells as one bitmap for all tasks: 8 MB at most."""
    spark = rows.sparkSession
    at = cell.bitwiseAND(F.lit(BITS - 1)) + 1
    parts = rows.select(at.alias("c")).groupBy(F.bitmap_bucket_number("c").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("c")).alias("b"))
    whole = np.zeros(BITS // 8, np.uint8)
    for row in parts.collect():
        part = np.frombuffer(bytes(row.b), np.uint8)
        whole[(row.k - 1) * len(part):row.k * len(part)] = part
    return spark.sparkContext.broadcast(whole)


def _pair_cell() -> Column:
    return F.shiftrightunsigned(F.xxhash64("lang", "w1"), 17).bitwiseXOR(F.xxhash64("lang", "w2"))


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = lambda c: c.cast("decimal(16,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(MILLION).cast("decimal(7,0)"), wide(left) * wide(right)).cast("long")


def _pairs(docs: DataFrame, words: DataFrame, least: int, chunk: int) -> DataFrame:
    """(lang, w1, w2, a, l, r, score, bound) of every two-word candidate."""
    frequent = words.where(F.col("n") >= least)
    bits = _bitmap(frequent, F.xxhash64("lang", "w1"))
    found = _counted(docs, 2, words=bits, chunk=chunk).where(F.col("n") >= least).withColumnRenamed("n", "a")
    found = found.join(frequent.select("lang", "w1", F.col("n").alias("l")), ["lang", "w1"])
    found = found.join(frequent.select("lang", F.col("w1").alias("w2"), F.col("n").alias("r")), ["lang", "w2"])
    bound = F.call_function("div", F.col("a").cast("decimal(16,0)") * F.lit(MILLION).cast("decimal(7,0)"), F.col("l").cast("decimal(16,0)")).cast("long")
    found = found.select("lang", "w1", "w2", "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"), bound.alias("bound"))
    return workspace.written(found, "phrase-pairs")


def _floors(pairs: DataFrame, reached: int) -> DataFrame:
    """(lang, floor): the highest score that ``reached`` pairs of the language have or exceed, 0 if there are fewer."""
    heights = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    found = heights.withColumn("above", above).groupBy("lang").agg(F.max(F.when(F.col("above") >= reached, F.col("score"))).alias("floor"))
    return found.select("lang", F.coalesce("floor", F.lit(0)).alias("floor"))


def _grown(docs: DataFrame, pairs: DataFrame, least: int, chunk: int) -> DataFrame:
    """(lang, w1, w2, w3, a, l, r, score): three-word phrases whose prefix is bounded by its floor or more, or whose suffix scores so.

    ``pairs`` has the column floor.
    """
    maps = [_bitmap(pairs, _pair_cell()), _bitmap(pairs.where("bound >= floor"), _pair_cell()), _bitmap(pairs.where("score >= floor"), _pair_cell())]
    found = _counted(docs, 3, grown=maps, chunk=chunk).where(F.col("n") >= least).withColumnRenamed("n", "a")
    left = pairs.select("lang", "w1", "w2", F.col("l").alias("f1"), F.col("a").alias("f12"))
    right = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("r").alias("f3"))
    found = found.join(left, ["lang", "w1", "w2"]).join(right, ["lang", "w2", "w3"])
    early, late = _score(F.col("a"), F.col("f1"), F.col("f23")), _score(F.col("a"), F.col("f12"), F.col("f3"))
    cut = F.when(late < early, F.struct(F.col("f12").alias("l"), F.col("f3").alias("r"), late.alias("score")))
    cut = cut.otherwise(F.struct(F.col("f1").alias("l"), F.col("f23").alias("r"), early.alias("score")))
    return workspace.written(found.select("lang", "w1", "w2", "w3", "a", cut.alias("c")).select("lang", "w1", "w2", "w3", "a", "c.*"), "phrase-triples")


def _survivors(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) at or above the floor of the language."""
    ends = [triples.select("lang", "w1", "w2", F.col("a").alias("longer")), triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("a").alias("longer"))]
    longest = ends[0].unionByName(ends[1]).groupBy("lang", "w1", "w2").agg(F.max("longer").alias("longer"))
    own = pairs.where("score >= floor").join(longest, ["lang", "w1", "w2"], "left")
    own = own.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * 50))
    floors = pairs.groupBy("lang").agg(F.first("floor").alias("floor"))
    three = triples.join(floors, "lang").where("score >= floor")
    shown = ["a", "l", "r", "score"]
    return own.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), *shown).unionByName(
        three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), *shown))


def mined(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, most: int = MOST, chunk: int = CHUNK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``most`` survivors of each language."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    words = workspace.written(_counted(texts, 1, chunk=chunk), "phrase-words")
    pairs = _pairs(texts, words, least, chunk)
    reached, settled = most, []
    while True:
        floored = workspace.written(pairs.join(_floors(pairs, reached), "lang"), "phrase-frontier")
        triples = _grown(texts, floored, least, chunk)
        found = workspace.written(_survivors(floored, triples), "phrase-survivors")
        state = floored.groupBy("lang").agg(F.first("floor").alias("floor")).join(found.groupBy("lang").agg(F.count("*").alias("known")), "lang", "left")
        settles = (F.col("floor") == 0) | (F.coalesce("known", F.lit(0)) >= most)
        state = workspace.written(state.select("lang", settles.alias("settles")), "phrase-state")
        settled.append(found.join(state.where("settles"), "lang", "left_semi"))
        rest = state.where(~F.col("settles")).select("lang")
        if rest.isEmpty():
            break
        pairs, texts, reached = pairs.join(rest, "lang", "left_semi"), texts.join(rest, "lang", "left_semi"), reached * 4
    whole = settled[0]
    for more in settled[1:]:
        whole = whole.unionByName(more)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    ranked = whole.withColumn("rank", place.cast("int")).where(F.col("rank") <= most).withColumn("rank", F.col("rank").cast("long"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
