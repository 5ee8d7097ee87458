"""Toxicity as severity grades: cumulative-link ordinal regression on sparse text features.

P(grade <= k) = logistic(threshold_k - w.x): one weight per feature, shared by all thresholds, which stay in order. The output is
the expected severity (the sum over k of P(grade >= k)), and the probability of any severity.

Features of a document, taken once each, hashed to ``BUCKETS``: its lower-cased words without marks at either end, and their
first three, four and five letters. A feature is learned if it was seen in ``SEEN`` sample documents or more, and if their mean
grade is ``SURE`` standard errors or more from the sample's.

``fit`` learns from at most ``PER_GRADE`` documents of each grade, those with the smallest seeded hash of the id; this bound is what
reaches the driver. ``score`` reads every whole text. A document with several labels has the highest; labels or documents
without an id or grade teach nothing; of documents that repeat an id one is learned. With fewer than two grades in the sample
nothing is severe. Null and empty texts have no features. Extra columns pass through; columns named like the added ones are
replaced. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from roadflux import workspace
from roadflux.llm.samples import smallest

BUCKETS = 1 << 18
PER_GRADE = 3000
MOST_GRADES = 16
SEEN = 4
SURE = 4.5
PENALTY = 2e-4
STEPS = 300
SEED = 11
REJECT_FROM = 0.5
ROWS_PER_BATCH = 500
_MARKS = ".,;:!?|\"'()[]{}<>«»…-–—*#_"
_MOST_WORDS_KEPT = 200_000


class Features:
    """Hashed features, all or those ``wanted``; those of recent words are kept."""

    def __init__(self, wanted: np.ndarray | None = None) -> None:
        self.known: dict[str, tuple[int, ...]] = {}
        self.heads: dict[str, tuple[int, ...]] = {}
        self.wanted = wanted

    def _hashed(self, *parts: str) -> tuple[int, ...]:
        found = [xxhash.xxh32_intdigest(p) % BUCKETS for p in parts]
        return tuple(found) if self.wanted is None else tuple([h for h in found if self.wanted[h]])

    def of_word(self, word: str) -> tuple[int, ...]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= _MOST_WORDS_KEPT:
                self.known.clear()
                self.heads.clear()
            bare = word.strip(_MARKS)
            head = self.heads.get(bare[:5])
            if head is None:
                head = self.heads[bare[:5]] = self._hashed(*(f"{n}{bare[:n]}" for n in (3, 4, 5) if len(bare) >= n))
            got = self.known[word] = head + (self._hashed(bare) if bare else ())
        return got

    def of_text(self, text: str | None) -> np.ndarray:
        found: set[int] = set()
        known = self.known
        for word in set((text or "").lower().split()):
            got = known.get(word)
            if got is None:
                got = self.of_word(word)
            if got:
                found.update(got)
        return np.fromiter(sorted(found), np.int64, len(found))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]

    def at_least(self, value: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each threshold k; a column per threshold."""
        return _logistic(value[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def learn(rows: list[np.ndarray], grades: np.ndarray) -> Model:
    """Maximum likelihood with an L2 penalty on the weights; Adam over all rows."""
    seen_grades = sorted(set(grades.tolist()))
    k = len(seen_grades) - 1
    if k < 1:
        return Model(np.zeros(BUCKETS, np.float32), np.zeros(0), seen_grades)
    level = np.searchsorted(seen_grades, grades)
    every = np.concatenate(rows)
    counts = np.bincount(every, minlength=BUCKETS)
    sums = np.bincount(every, weights=np.repeat(grades, [len(r) for r in rows]), minlength=BUCKETS)
    apart = np.abs(sums - counts * grades.mean()) / np.sqrt(np.maximum(counts, 1)) / grades.std()
    learned = (counts >= SEEN) & (apart >= SURE)
    column = np.cumsum(learned) - 1
    own = [column[r[learned[r]]] for r in rows]
    sizes = np.array([len(r) for r in own])
    index = np.concatenate(own).astype(np.int64)
    row = np.repeat(np.arange(len(own)), sizes)
    share = np.bincount(level, minlength=k + 1) / len(level)
    w = np.zeros(int(learned.sum()))
    below = np.cumsum(share)[:k]
    # ordered thresholds: the first, and logarithms of the gaps
    start = np.log(below / (1 - below))
    theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    moments = [np.zeros(len(w) + k), np.zeros(len(w) + k)]
    for step in range(1, STEPS + 1):
        cuts = np.concatenate([theta[:1], theta[:1] + np.cumsum(np.exp(theta[1:]))])
        z = np.bincount(row, weights=w[index], minlength=len(own))
        edges = np.concatenate([np.full((len(z), 1), -50.0), cuts[None, :] - z[:, None], np.full((len(z), 1), 50.0)], axis=1)
        upper, lower = _logistic(edges[np.arange(len(z)), level + 1]), _logistic(edges[np.arange(len(z)), level])
        upper[level == k], lower[level == 0] = 1.0, 0.0
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        dz = (du - dl) / p / len(z)  # of the negative log-likelihood
        dcut = np.zeros(k)
        np.add.at(dcut, level[level < k], -(du / p)[level < k] / len(z))
        np.add.at(dcut, level[level > 0] - 1, (dl / p)[level > 0] / len(z))
        dtheta = np.cumsum(dcut[::-1])[::-1].copy()
        dtheta[1:] *= np.exp(theta[1:])
        slope = np.concatenate([np.bincount(index, weights=dz[row], minlength=len(w)) + PENALTY * w, dtheta])
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.999 * moments[1] + 0.001 * slope ** 2
        move = 0.05 * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.999 ** step)) + 1e-8)
        w -= move[:len(w)]
        theta -= move[len(w):]
    full = np.zeros(BUCKETS, np.float32)
    full[learned] = w
    return Model(full, np.concatenate([theta[:1], theta[:1] + np.cumsum(np.exp(theta[1:]))]), seen_grades)


def with_severe(rows: list[np.ndarray], grades: np.ndarray) -> np.ndarray:
    """Three grades from two: of the rows of grade 1, those that a first fit values above their median become grade 2."""
    first = learn(rows, grades)
    value = np.array([first.weights[r].sum(dtype=np.float64) for r in rows])
    return np.where((grades == 1) & (value > np.median(value[grades == 1])), 2, grades)


def fit(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade") -> Model:
    """grades: (id, whole grade from 0 to ``MOST_GRADES``). Grades that only say no or yes (0 and 1) become three, see
    ``with_severe``."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    one = grades.select(F.col(id_col).cast("long").alias("id"), F.col(grade_col).cast("int").alias("grade")).where(
        F.col("id").isNotNull() & F.col("grade").between(0, MOST_GRADES)).groupBy("id").agg(F.max("grade").alias("grade"))
    one = workspace.written(one, "grades")
    present = sorted(tuple(r) for r in one.groupBy("grade").count().collect())
    if not present:
        return learn([], np.zeros(0, np.int64))
    chosen = [smallest(one.where(F.col("grade") == g), F.xxhash64(F.lit(SEED), "id"), PER_GRADE, n, "id") for g, n in present]
    ids = chosen[0]
    for more in chosen[1:]:
        ids = ids.unionByName(more)
    ids = workspace.written(ids, "graded-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features.of_text(t.as_py()).astype(np.int32) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f.tobytes() for f in found], pa.binary())],
                                             ["id", "grade", "found"])

    # at most PER_GRADE * (MOST_GRADES + 1) ids of 12 bytes
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("t"))
    sample = texts.join(F.broadcast(ids), texts["doc"] == ids["id"]).select("id", "grade", "t").mapInArrow(run, "id long, grade int, found binary")
    rows = sample.groupBy("id").agg(F.max("grade").alias("grade"), F.min("found").alias("found")).orderBy("id").collect()
    found = [np.frombuffer(r.found, np.int32).astype(np.int64) for r in rows]
    given = np.array([r.grade for r in rows], np.int64)
    return learn(found, with_severe(found, given) if set(given.tolist()) == {0, 1} else given)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns, plus severity (expected grade), grade (most likely), toxic_score (probability of any severity), toxic."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    added = [("severity", T.DoubleType()), ("grade", T.IntegerType()), ("toxic_score", T.DoubleType()), ("toxic", T.BooleanType())]
    docs = docs.drop(*[n for n, _ in added if n in docs.columns])
    names, at = docs.columns, docs.columns.index(text_col)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS weights of four bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        features = Features(own.weights != 0)
        levels = np.array(own.grades or [0], np.float64)
        for batch in batches:
            value = np.array([float(own.weights[features.of_text(t.as_py())].sum(dtype=np.float64)) for t in batch.column(at)])
            over = own.at_least(value)
            severity = levels[0] + over @ np.diff(levels) if len(levels) > 1 else np.full(len(value), levels[0])
            mass = -np.diff(np.concatenate([np.ones((len(value), 1)), over, np.zeros((len(value), 1))], axis=1), axis=1)
            likely = levels[mass.argmax(axis=1)].astype(np.int32)
            some = over[:, 0] if over.shape[1] else np.zeros(len(value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(severity), pa.array(likely), pa.array(some), pa.array(some >= REJECT_FROM)],
                                             [f"c{i}" for i in range(len(names) + len(added))])

    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate([*docs.schema.fields, *[T.StructField(n, t) for n, t in added]])]
    return docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, T.StructType(fields)).toDF(*names, *[n for n, _ in added])


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades from the table ``labels``, which only says whether a document is toxic: 0 or 1; null if not known."""
    return labels.select("doc_id", F.col("toxic").cast("int").alias("grade"))
