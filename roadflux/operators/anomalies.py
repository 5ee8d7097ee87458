"""Isolation forest (Liu, Ting, Zhou 2008): trees on small samples, scores on all rows.

Each tree sees a few hundred rows, so growing it is a small task of its own; the
samples are drawn by hash and never depend on how the table is partitioned. The
finished forest has at most trees x 2^(height + 1) nodes whatever the input, which
is why it can be sent to every task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

FEATURES = ["vehicle_count", "average_speed", "occupancy_rate", "hour", "day_of_week"]
TREES, SAMPLE, CONTAMINATION, SEED = 100, 256, 0.1, 42  # fixed values
NODES = "tree int, node int, feature int, threshold double, left int, right int, depth double"


def usual_path(rows: int) -> float:
    """Mean depth of an unsuccessful search in a tree over ``rows`` keys."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1) + np.euler_gamma) - 2.0 * (rows - 1) / rows


@dataclass
class Forest:
    feature: np.ndarray  # one row per tree; -1 marks a leaf
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray  # leaf depth plus the usual path of the rows left in it
    sample: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Negated anomaly score: lower is more unusual."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), dtype=np.int32)
            while True:
                f = self.feature[t, at]
                inner = f >= 0
                if not inner.any():
                    break
                goes_left = x[rows, np.maximum(f, 0)] < self.threshold[t, at]
                at = np.where(inner, np.where(goes_left, self.left[t, at], self.right[t, at]), at)
            total += self.depth[t, at]
        return -np.exp2(-(total / len(self.feature)) / max(usual_path(self.sample), 1e-12))


def complete(rows: DataFrame) -> DataFrame:
    """Rows with a value for every feature; the others cannot be scored."""
    return rows.dropna(subset=FEATURES)


def tree_samples(rows: DataFrame, total: int, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """(tree, features) with ``sample`` rows per tree, without replacement in a tree.

    One hash per row keeps about 1.5 x trees x sample rows; only those are offered
    to each tree, again by hash. Rows with equal values share a hash, so a hash
    over all columns that identify a reading goes in.
    """
    wanted = 1.5 * trees * sample
    kept = min(float(total), wanted)
    identity = F.xxhash64(F.lit(seed), *sorted(rows.columns))
    unit = lambda h: F.pmod(h, F.lit(1 << 52)) / float(1 << 52)
    pool = rows.withColumn("_id", identity).filter(unit(F.col("_id")) < kept / max(total, 1))
    share = min(1.0, 1.5 * sample / max(kept, 1.0))
    offered = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn(
        "_draw", F.xxhash64("_id", "tree")
    ).filter(unit(F.col("_draw")) < share)
    first = Window.partitionBy("tree").orderBy("_draw", *FEATURES)
    return offered.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= sample).select("tree", *FEATURES)


def _grow(x: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes as (node, feature, threshold, left, right, depth)."""
    nodes, waiting, made = [], [(0, np.arange(len(x)), 0)], 1
    while waiting:
        node, members, level = waiting.pop()
        low, high = x[members].min(axis=0), x[members].max(axis=0)
        spread = np.flatnonzero(high > low)
        if level >= limit or len(members) <= 1 or len(spread) == 0:
            nodes.append((node, -1, 0.0, 0, 0, level + usual_path(len(members))))
            continue
        f = int(rng.choice(spread))
        cut = float(rng.uniform(low[f], high[f]))
        below = x[members, f] < cut
        if not below.any() or below.all():  # the draw fell on the lowest value
            cut = float(high[f])
            below = x[members, f] < cut
        nodes.append((node, f, cut, made, made + 1, 0.0))
        waiting += [(made, members[below], level + 1), (made + 1, members[~below], level + 1)]
        made += 2
    return nodes


def fit(rows: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    scored = complete(rows)
    total = scored.count()
    if total == 0:
        raise ValueError("no row has a value for every feature")
    size = min(sample, total)
    limit = max(1, math.ceil(math.log2(max(size, 2))))

    def grow(key, frame: pd.DataFrame) -> pd.DataFrame:
        x = frame[FEATURES].to_numpy(dtype=float)
        nodes = _grow(x, limit, np.random.default_rng([seed, int(key[0])]))
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "depth"])
        out.insert(0, "tree", int(key[0]))
        return out

    samples = tree_samples(scored, total, trees, sample, seed)
    # Hashing puts rows in `_draw` order per tree, but a shuffle may deliver them otherwise.
    ordered = lambda key, frame: grow(key, frame.sort_values(FEATURES))
    table = samples.groupBy("tree").applyInPandas(ordered, NODES).toPandas()  # bounded: the forest itself
    grown = sorted(table["tree"].unique())
    width = int(table["node"].max()) + 1
    arrays = {
        "feature": np.full((len(grown), width), -1, dtype=np.int32),
        "threshold": np.zeros((len(grown), width)),
        "left": np.zeros((len(grown), width), dtype=np.int32),
        "right": np.zeros((len(grown), width), dtype=np.int32),
        "depth": np.zeros((len(grown), width)),
    }
    row = np.searchsorted(grown, table["tree"].to_numpy())
    for name, array in arrays.items():
        array[row, table["node"].to_numpy()] = table[name].to_numpy()
    return Forest(**arrays, sample=size)


def score(rows: DataFrame, forest: Forest) -> DataFrame:
    """Add ``anomaly_score``; NULL for a row that lacks a feature."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def scored(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series, e: pd.Series) -> pd.Series:
        x = np.column_stack([s.to_numpy(dtype=float) for s in (a, b, c, d, e)])
        return pd.Series(shared.value.scores(x))

    whole = F.lit(True)
    for c in FEATURES:
        whole = whole & F.col(c).isNotNull()
    return rows.withColumn("anomaly_score", F.when(whole, scored(*[F.col(c).cast("double") for c in FEATURES])))


BINS = 1024
FEW = 10_000


def ranked_value(rows: DataFrame, column: str, share: float) -> float | None:
    """The smallest value that ``share`` of all values does not exceed, exactly.

    Each pass counts the values of ``BINS`` equal bands and goes on in the band that holds the rank, until that band has few
    distinct values; what reaches the driver is one count per band, or those few values.
    """
    facts = rows.agg(F.count(column).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).first()
    if not facts["n"]:
        return None
    rank, low, high = max(1, math.ceil(round(facts["n"] * share, 6))), facts["low"], facts["high"]
    inside = rows.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    while True:
        distinct = inside.groupBy("v").agg(F.count("*").alias("n")).orderBy("v").limit(FEW + 1).collect()
        step = (high - low) / BINS
        if len(distinct) <= FEW or low + step <= low:
            for value in distinct:
                rank -= value["n"]
                if rank <= 0:
                    return value["v"]
        band = F.least(F.lit(BINS - 1), F.floor((F.col("v") - low) / step))
        counts = inside.groupBy(band.alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("b").collect()
        for count in counts:
            if rank <= count["n"]:
                inside = inside.where((F.col("v") >= count["low"]) & (F.col("v") <= count["high"]))
                low, high = count["low"], count["high"]
                break
            rank -= count["n"]


def flag(scored: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """Add ``is_anomaly``: 1 for scores below the exact cut of the most unusual share; NULL without a score.

    ``scored`` is read several times: store it first.
    """
    limit = ranked_value(scored, "anomaly_score", contamination)
    return scored.withColumn("is_anomaly", (F.col("anomaly_score") < F.lit(limit).cast("double")).cast("int"))


def anomaly_share(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.sum("is_anomaly").alias("anomalies"),
        F.count("is_anomaly").alias("rows"),
        F.round(F.avg("is_anomaly") * 100, 1).alias("percent"),
    )


def most_severe(flagged: DataFrame, keep: int = 10) -> DataFrame:
    worst = flagged.filter(F.col("is_anomaly") == 1).orderBy("anomaly_score", *FEATURES).limit(keep)
    return worst.select("vehicle_count", "average_speed", "occupancy_rate", "hour", "anomaly_score")
