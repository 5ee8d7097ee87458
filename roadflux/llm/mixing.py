"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

Size of a document: its words. Sources in code point order, null last, weigh 3, 1, 2, repeating. They share ``SHARE`` of all
words by weight; a target stops at ``MOST`` times its source's words, and the excess is shared anew by weight.

All words are dealt in blocks of about equal size: a source gets as many as its target earns by highest quotients
(target / 1, / 3, / 5, ...), and in the same way deals its blocks to its shards, which are equal cuts of the documents by a hash of
the id. In a shard the documents lie end to end in seeded order and are cut into blocks; the shard takes as many consecutive
blocks as its quota, from a seeded start and around the end, for a second lap if need be. Thus a document is taken in whole blocks
of its neighbourhood, no document more than ``MOST`` times, and reruns agree.

Quotients are only compared where they can decide: an allocation of n blocks over m claims differs from the proportional one by
bounds that leave about two quotients per claim. One row per source is ranked in a single task, one row per shard of a source in
that source's task; documents are only ordered within shards of about ``DOCS_PER_SHARD`` rows.

Null text has size 0, so has blank text; a size 0 takes nothing. Null ids are a value like others; repeated rows count as
documents of their own. Extra columns pass through, columns named like the added ones are replaced. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from roadflux import workspace

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 7
DOCS_PER_SHARD = 2048
BLOCK_WORDS = 64
BLOCKS_PER_GROUP = 1000


def targets(sources: DataFrame, share: float = SHARE) -> DataFrame:
    """(source, source_size) with weight and target: shares by weight under a cap, the excess shared anew.

    Where a source stands at its cap depends on cap / weight alone, so with sources in that order the final shares follow from
    running sums: a source is capped if, all before it capped, its share of the rest is not below its cap.
    """
    by_code = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(by_code) - 1, F.lit(len(WEIGHTS))) + 1)
    cap = F.col("source_size") * F.lit(MOST).cast("double")
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sources.withColumn("weight", weight.cast("double")).withColumn("cap", cap)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    leveled = (ranked.withColumn("total", F.sum("source_size").over(everything) * F.lit(share)).withColumn("level", level)
               .withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap")))
    # capped sources come first, so the first free one has the final level
    final = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(
        by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return leveled.withColumn("target", F.least(F.col("cap"), F.coalesce(final * F.col("weight"), F.col("cap")))).select(
        "source", "source_size", "weight", "target")


def apportion(claims: DataFrame, within: list[str], votes: str, seats: str, order: list[str], out: str) -> DataFrame:
    """Sainte-Lague: deal ``seats`` (the same in all rows of a group) to the rows of each group in proportion to ``votes``.

    With m claims the divisor lies between V / (seats + m/2) and V / (seats - m/2). Rounding by these two bounds gives the
    seats that are safe and those that are open; the open ones go by quotient, ties in the given order.
    """
    group = Window.partitionBy(*within)
    v, n, m, total = F.col(votes), F.col(seats), F.count(F.lit(1)).over(group), F.sum(votes).over(group)
    sure = F.when(total > 0, F.greatest(F.lit(0), F.floor(v * (n - m / 2) / total + 0.5) - 1)).otherwise(0)
    most = F.when(total > 0, F.floor(v * (n + m / 2) / total + 0.5) + 1).otherwise(0)
    rounded = claims.withColumn("__sure", F.least(sure, n)).withColumn("__most", F.least(most, n))
    left = rounded.withColumn("__open", n - F.sum("__sure").over(group))
    one_each = left.withColumn("__k", F.explode_outer(F.when(F.col("__most") > F.col("__sure"), F.sequence("__sure", F.col("__most") - 1))))
    by_quotient = Window.partitionBy(*within).orderBy(F.desc_nulls_last(v / (2 * F.col("__k") + 1)), *order, "__k")
    won = one_each.withColumn("__won", (F.col("__k").isNotNull() & (v > 0) & (F.row_number().over(by_quotient) <= F.col("__open"))).cast("long"))
    names = claims.columns
    return won.groupBy(*names).agg((F.first("__sure") + F.sum("__won")).cast("long").alias(out))


def _matches(left: DataFrame, right: DataFrame, names: dict[str, str]):
    out = F.lit(True)
    for a, b in names.items():
        out = out & left[a].eqNullSafe(right[b])
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """(id, source) of every row with size, source_size, target and taken."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = workspace.written(rows, "sizes")
    n_docs = rows.count()
    n_shards = max(1, -(-n_docs // DOCS_PER_SHARD))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n_shards)))
    groups = workspace.written(dealt.groupBy("source", "shard").agg(F.sum("size").alias("words")), "shards")
    sized = groups.groupBy("source").agg(F.sum("words").alias("source_size"))
    aimed = workspace.written(targets(sized), "targets")
    facts = aimed.agg(F.sum("target").alias("t"), F.count("*").alias("n")).first()
    aim = facts["t"] or 0.0
    block = max(1.0, min(float(BLOCK_WORDS), aim / max(1, facts["n"] * n_shards * BLOCKS_PER_GROUP)))
    # the blocks of all sources, then each source's blocks over its shards
    of_source = apportion(
        aimed.withColumn("all", F.lit(0)).withColumn("seats", F.lit(round(aim / block))), ["all"], "target", "seats",
        ["weight", "source"], "blocks").select(F.col("source").alias("s"), "source_size", "target", F.col("blocks").alias("seats"))
    of_source = workspace.written(of_source, "source-blocks")
    claims = groups.join(of_source, _matches(groups, of_source, {"source": "s"})).drop("s")
    quotas = apportion(claims, ["source"], "words", "seats", ["shard"], "quota")
    quotas = quotas.withColumn("cuts", F.greatest(F.lit(1), F.round(F.col("words") / block).cast("long"))).withColumn(
        "quota", F.least(F.col("quota"), F.col("cuts") * MOST))
    start = F.pmod(F.xxhash64(F.lit(seed + 1), "source", "shard"), F.col("cuts"))
    quotas = quotas.select(F.col("source").alias("s"), F.col("shard").alias("h"), "source_size", "target", "words", "cuts", "quota", start.alias("start"))
    quotas = workspace.written(quotas, "quotas")
    along = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 2), "id"), "id", "size")
    placed = dealt.withColumn("end", F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, 0))).withColumn("begin", F.col("end") - F.col("size"))
    known = placed.join(quotas, _matches(placed, quotas, {"source": "s", "shard": "h"}))
    # whole laps, and the stretch of the last one: from word a to word b, around the end
    laps, more = F.floor(F.col("quota") / F.col("cuts")), F.pmod(F.col("quota"), F.col("cuts"))
    word = lambda cut: F.expr(f"cast((({cut}) * words) div cuts as long)")
    part = (known.withColumn("laps", laps).withColumn("more", more)
            .withColumn("a", word("start")).withColumn("b", word("least(start + more, cuts)"))
            .withColumn("c", word("greatest(start + more - cuts, 0)")))
    overlap = lambda lo, hi: F.greatest(F.lit(0), F.least("end", hi) - F.greatest("begin", lo))
    taken = F.col("laps") * F.col("size") + overlap(F.col("a"), F.col("b")) + overlap(F.lit(0), F.col("c"))
    return part.select("id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
