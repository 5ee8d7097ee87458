"""Language identification by hyperdimensional profiles.

Each letter (and the gap between words) has a random vector of ``DIMENSIONS`` signs, seeded by its code point. A trigram's
vector binds its letters' vectors, permuted by their place: r(r(a)) * r(b) * c. A document's vector bundles (sums) the vectors of
all its trigrams, a language's prototype the documents of that language. A document has the language whose prototype has the
highest cosine with its own vector; the cosine, 0 at least, is the score.

Texts are lower-cased; runs of characters that are not letters are one gap, also at both ends. Documents learn if their language is
not null and crc32 of the id as text, mod ``FOLDS``, is not 0; rows without id are neither learned from nor held out. All of
them are learned from; sums are whole numbers, so reruns agree. A text that is null or without letter is ``und`` with score 0, and so is
every text if nothing was learned. Ties go to the first language in code point order. Extra columns are not used. Empty tables
give empty results. Texts of any length are taken a million characters at a time, their trigrams ``SLICE`` at a time. At most
``MOST_LANGUAGES`` languages are taken; more is an error, since the prototypes travel to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DIMENSIONS = 1024
FOLDS = 5
SEED = 5
UNKNOWN = "und"
MOST_LANGUAGES = 4096
ROWS_PER_BATCH = 200
SLICE = 1 << 14
_CHARS_AT_ONCE = 1 << 20
_SPACE = 0x110000


class Trigrams:
    """Bundles the trigrams of texts; knows letters and their vectors."""

    def __init__(self) -> None:
        self.is_letter = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), np.bool_)
        self.vectors: dict[int, np.ndarray] = {}

    def vector(self, code: int) -> np.ndarray:
        got = self.vectors.get(code)
        if got is None:
            got = self.vectors[code] = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1
        return got

    def bundles(self, runs: list[tuple[int, str]], owners: int) -> tuple[np.ndarray, np.ndarray]:
        """Per owner the sum of its trigrams' vectors, and whether it has a letter. runs: (owner, stretch of text).

        Trigrams are multiplied in slices of ``SLICE``, so that memory does not grow with the number of distinct ones. A call has
        far fewer than 2^24 characters: sums are exact in single precision.
        """
        codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for _, t in runs]
        sizes = np.array([len(c) for c in codes], np.int64)
        owner = np.array([o for o, _ in runs], np.int64)
        code = np.concatenate(codes)
        row = np.repeat(np.arange(len(runs)), sizes)
        letter = self.is_letter[code]
        has_letter = np.bincount(owner[row], weights=letter, minlength=owners) > 0
        symbol = np.where(letter, code, np.uint32(_SPACE))
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of a run of other characters
        keep[0] = True
        keep[np.cumsum(sizes)[:-1]] = True  # each stretch starts with a symbol of its own
        symbol, row = symbol[keep], row[keep]
        sums = np.zeros((owners, DIMENSIONS), np.int64)
        whole = np.flatnonzero(row[2:] == row[:-2])
        if not len(whole):
            return sums, has_letter
        alphabet, dense = _dense(symbol, _SPACE + 1)
        size = len(alphabet)
        known, place = _dense((dense[whole] * size + dense[whole + 1]) * size + dense[whole + 2], size ** 3)
        own = owner[row[whole]]
        letters = np.stack([self.vector(int(c)) for c in alphabet])
        first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
        if len(known) > SLICE:
            order = np.argsort(place, kind="stable")
            own, place = own[order], place[order]
        for start in range(0, len(known), SLICE):
            part = known[start:start + SLICE]
            lo, hi = (np.searchsorted(place, [start, start + len(part)]) if len(known) > SLICE else (0, len(place)))
            counts = np.bincount(own[lo:hi] * len(part) + place[lo:hi] - start, minlength=owners * len(part)).reshape(owners, len(part))
            vectors = first[part // (size * size)] * second[part // size % size] * letters[part % size]
            sums += np.rint(counts.astype(np.float32) @ vectors.astype(np.float32)).astype(np.int64)
        return sums, has_letter


def _dense(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and each value's place among them."""
    if bound > 1 << 24:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(bound, np.bool_)
    seen[values] = True
    known = np.flatnonzero(seen)
    places = np.empty(bound, np.int64)
    places[known] = np.arange(len(known))
    return known, places[values]


def _portions(texts: list[str | None]) -> Iterator[list[tuple[int, str]]]:
    """Lists of (place of the text, stretch) of about a million characters each.

    A text is lower-cased as a whole and stands between gaps. A longer one is cut; each further stretch starts with the last two
    symbols before it, so that every trigram is in one stretch.
    """
    held: list[tuple[int, str]] = []
    size = 0
    for k, t in enumerate(texts):
        whole = f" {(t or '').lower()} "
        before = ""
        for at in range(0, len(whole), _CHARS_AT_ONCE):
            stretch = before + whole[at:at + _CHARS_AT_ONCE]
            if held and size + len(stretch) > _CHARS_AT_ONCE:
                yield held
                held, size = [], 0
            held.append((k, stretch))
            size += len(stretch)
            if at + _CHARS_AT_ONCE < len(whole):
                before = _last_two(stretch)
    if held:
        yield held


def _last_two(stretch: str) -> str:
    """The last two symbols of a stretch as characters; fewer if it has fewer."""
    found: list[str] = []
    for c in reversed(stretch):
        if c.isalpha():
            found.append(c)
        elif not found or found[-1] != " ":
            found.append(" ")
        if len(found) == 2:
            break
    return "".join(reversed(found))


def held_out(id_col: str):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes by language."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    taught = docs.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        trigrams, sums = Trigrams(), {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            own = sorted(set(langs))
            at = [own.index(x) for x in langs]
            for runs in _portions(texts):
                found, _ = trigrams.bundles([(at[k], t) for k, t in runs], len(own))
                for lang, vector in zip(own, found):
                    sums[lang] = sums.get(lang, 0) + vector
        salt = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([salt] * len(sums), pa.int32()),
                                          pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["lang", "salt", "sum"])

    def add(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v.as_py(), np.int64) for v in group.column("sum")], axis=0)
        return group.slice(0, 1).set_column(2, "sum", pa.array([total.tobytes()], pa.binary()))

    parts = taught.mapInArrow(bundle, "lang string, salt int, sum binary")
    sums = parts.groupBy("lang", "salt").applyInArrow(add, parts.schema).groupBy("lang").applyInArrow(add, parts.schema)
    found = sums.limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {r.lang: np.frombuffer(r.sum, np.int64) for r in found}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    names = sorted(prototypes, key=lambda s: s.encode())
    rows = [prototypes[n] / max(np.linalg.norm(prototypes[n].astype(np.float64)), 1e-300) for n in names]
    profile = spark.sparkContext.broadcast((names, np.array(rows).reshape(len(names), DIMENSIONS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, (langs, unit) = Trigrams(), profile.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            own, lettered = np.zeros((len(texts), DIMENSIONS), np.int64), np.zeros(len(texts), np.bool_)
            for runs in _portions(texts):
                lo, hi = runs[0][0], runs[-1][0] + 1
                sums, letters = trigrams.bundles([(k - lo, t) for k, t in runs], hi - lo)
                own[lo:hi] += sums
                lettered[lo:hi] |= letters
            norms = np.sqrt((own.astype(np.float64) ** 2).sum(axis=1))
            near = own @ unit.T / np.maximum(norms, 1e-300)[:, None]
            picked, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for k in np.flatnonzero(lettered).tolist() if langs else ():
                top = int(near[k].argmax())
                picked[k], scores[k] = langs[top], float(min(1.0, max(0.0, near[k, top])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(picked, pa.string()), pa.array(scores, pa.float64())],
                                             ["id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, held_out boolean, lang_pred string, score double")
