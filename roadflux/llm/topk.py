"""Exact top-k by inner product: columnar branch and bound.

Vectors become integers (floor of ``SCALE`` times each component). Queries are the rows whose id is divisible by ``EVERY``.
Candidates and queries form blocks; each pair of blocks is one task's work. Within it the candidates lie in vertical layout,
a row per dimension, and scores are accumulated one block of dimensions after the other. After each block every query keeps
the candidates whose partial score plus a bound on the rest (product of the remaining norms) reaches the k-th best partial
score minus that bound, and compacts them. The best k of each pair of blocks are merged per query.

Vectors that are null, or hold null or non-finite components, and rows without an id take no part. A row is not a candidate for
queries with its own id; rows that repeat a query's id are answered together, once for each distinct vector. Ties go to the smaller id. Vectors of
unequal length are compared as if padded with zeros. Extra columns are not used. Components may have any finite amount: scores that
64 bits might not hold on the way are added in integers of any size; only a score among a block's k best that no long can hold is refused
with an error. An empty table gives no rows. Very long vectors only make the blocks of a task larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from roadflux import workspace

SCALE = 256
EVERY = 50
K = 5
CANDIDATES_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 1024
DIMENSIONS_PER_STEP = 16
EXACT = 2 ** 62  # sums below it are exact in 64 bits


def _amounts(v: np.ndarray) -> np.ndarray:
    """Absolute values as doubles. What no double holds becomes 2^1000, whose norm is infinite, so it counts as wide all the same."""
    return np.minimum(np.abs(v), 2 ** 1000).astype(np.float64) if v.dtype == object else np.abs(v.astype(np.float64))


def _norms(v: np.ndarray, steps: list[int]) -> np.ndarray:
    """Norms of the vectors (columns) and of what each step of dimensions leaves of them, rounded up."""
    with np.errstate(over="ignore"):
        squares = _amounts(v) ** 2
        return np.array([np.sqrt(squares[s:].sum(axis=0)) * (1 + 1e-9) for s in [*steps, len(v)]])


def _climb(query: np.ndarray, layout: np.ndarray, alive: np.ndarray, mass_q: np.ndarray, mass_c: np.ndarray, steps: list[int], k: int):
    """(candidates, scores) that no k others beat, among ``alive``; in the integers of ``layout``, 64 bits or of any size."""
    wide = layout.dtype == object
    score = np.zeros(len(alive), layout.dtype)
    for n, s in enumerate(steps):
        part = slice(s, s + DIMENSIONS_PER_STEP)
        block = layout[part] if len(alive) == layout.shape[1] else layout[part][:, alive]
        score = score + query[part] @ block
        left_q, left_c = mass_q[n + 1], mass_c[n + 1, alive]
        with np.errstate(over="ignore", invalid="ignore"):
            slack = np.where((left_q == 0) | (left_c == 0), 0.0, np.ceil(left_q * left_c))
        if wide:  # a slack without a bound keeps its candidate
            if not np.isfinite(slack).all():
                continue
            slack = np.array([int(x) for x in slack], object)
        if len(alive) > k:
            floor = np.partition(score - slack, len(alive) - k)[len(alive) - k]
            stay = score + slack >= floor
            alive, score = alive[stay], score[stay]
    if len(alive) > k:
        stay = score >= np.partition(score, len(alive) - k)[len(alive) - k]
        alive, score = alive[stay], score[stay]
    return alive, score


def best(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(row of the query, id, score) of each query's k best candidates, best first.

    No sum of products exceeds the product of the norms. Pairs for which it stays below 2^62 are scored in 64 bits, all others
    in Python integers; both are exact. The arrays hold int64, or objects where a component needs more.
    """
    width = max(queries.shape[1], candidates.shape[1])
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    layout = np.ascontiguousarray(np.pad(candidates, ((0, 0), (0, width - candidates.shape[1]))).T)
    steps = list(range(0, width, DIMENSIONS_PER_STEP))
    mass_q, mass_c = _norms(queries.T, steps), _norms(layout, steps)

    def in_64_bits(v: np.ndarray, fits: np.ndarray) -> np.ndarray:
        return v if v.dtype == np.int64 else np.where(fits, v, 0).astype(np.int64)

    narrow_layout = in_64_bits(layout, mass_c[0] < EXACT)
    narrow_queries = in_64_bits(queries, (mass_q[0] < EXACT)[:, None])
    out = []
    for q in range(len(queries)):
        with np.errstate(over="ignore"):
            narrow = np.maximum(mass_q[0, q], 1) * np.maximum(mass_c[0], 1) < EXACT
        others = ids != query_ids[q]
        alive, score = _climb(narrow_queries[q], narrow_layout, np.flatnonzero(others & narrow), mass_q[:, q], mass_c, steps, k)
        found = list(zip(alive.tolist(), score.tolist()))
        wide = np.flatnonzero(others & ~narrow)
        if len(wide):
            alive, score = _climb(queries[q].astype(object), layout[:, wide].astype(object), np.arange(len(wide)), mass_q[:, q], mass_c[:, wide], steps, k)
            found += zip(wide[alive].tolist(), score.tolist())
        ranked = sorted((-s, int(ids[c])) for c, s in found)[:k]
        out.extend((q, i, -s) for s, i in ranked)
    return out


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for each query."""
    spark = vectors.sparkSession
    raw = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fit = raw.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))
    # floor(SCALE * x) / SCALE: exact as a double, also where SCALE * x has no double. From 2^45 on every double is such a value.
    whole = fit.select("id", F.transform("v", lambda x: F.when(F.abs(x) < 2.0 ** 45, F.floor(x * SCALE) / F.lit(float(SCALE))).otherwise(x)).alias("v"))
    whole = workspace.written(whole, "vectors")
    total = whole.count()
    asked = whole.where(F.col("id") % every == 0).distinct()
    n_c = max(1, -(-total // CANDIDATES_PER_BLOCK))
    n_q = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    block = lambda n: F.pmod(F.xxhash64("id", "v", F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(n))
    # A stated query set against all rows: every query block meets every candidate block once.
    left = whole.withColumn("c", block(n_c)).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))).withColumn(
        "c", F.col("c").cast("int"))
    right = asked.withColumn("q", F.pmod(F.xxhash64("id", "v"), F.lit(n_q)).cast("int")).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))

    def matrix(table: pa.Table) -> np.ndarray:
        column = table.column("v").combine_chunks()
        lengths = np.diff(np.asarray(column.offsets))
        values = np.asarray(column.flatten())
        if np.abs(values).max(initial=0) < EXACT / SCALE:
            scaled = (values * SCALE).astype(np.int64)
        else:
            scaled = np.array([int(x * SCALE) if abs(x) < 2.0 ** 45 else int(x) * SCALE for x in values.tolist()], object)
        out = np.zeros((len(lengths), int(lengths.max(initial=0))), scaled.dtype)
        out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = scaled
        return out

    def meet(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and queries.num_rows:
            query_ids = np.asarray(queries.column("id"))
            rows = best(matrix(queries), query_ids, matrix(candidates), np.asarray(candidates.column("id")), k)
            shown = queries.column("v").to_pylist()
            if any(not -(2 ** 63) <= s < 2 ** 63 for _, _, s in rows):
                raise OverflowError("a score among the best is too large for a long")
            found = [(int(query_ids[q]), shown[q], i, s) for q, i, s in rows]
        return pa.table({"query_id": pa.array([r[0] for r in found], pa.int64()), "v": pa.array([r[1] for r in found], pa.list_(pa.float64())),
                         "vec_id": pa.array([r[2] for r in found], pa.int64()), "score": pa.array([r[3] for r in found], pa.int64())})

    near = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(meet, "query_id long, v array<double>, vec_id long, score long")
    order = Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
