import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from roadflux.llm import mixing


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, free, got = Fraction(3, 2) * sum(sizes.values()), set(names), {}
    while free:
        whole = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / whole >= 2 * sizes[s]]
        if not over:
            got.update({s: left * weight[s] / whole for s in free})
            break
        for s in over:
            got[s] = Fraction(2 * sizes[s])
            free.discard(s)
        left -= sum(got[s] for s in over)
    return {s: float(t) for s, t in got.items()}


def brute_seats(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        k = max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * got[i] + 1), -i))
        if votes[k] > 0:
            got[k] += 1
    return got


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 50, None: 7, "é": 900}, {"x": 5}, {"a": 0, "b": 0}, {"a": 0, "b": 10},
                                   {f"s{i}": 3 ** (i % 9) for i in range(20)}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_apportion(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for g in range(30):
        votes = [rng.choice([0, 1, 5, 100, rng.randrange(10 ** 6)]) for _ in range(rng.choice([1, 2, 7, 40]))]
        seats = rng.choice([0, 1, 5, 200])
        for i, (v, s) in enumerate(zip(votes, brute_seats(votes, seats))):
            rows.append((g, i, v, seats))
            want[g, i] = s
    frame = spark.createDataFrame(rows, "g int, i int, v long, seats long")
    assert {(r.g, r.i): r.q for r in mixing.apportion(frame, ["g"], "v", "seats", ["i"], "q").collect()} == want


def docs(n, rng):
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 10, 300, 3000])), rng.choice(["s0"] * 6 + ["s1", "s2", "s3", None, "Ä"])) for i in range(n)]
    return rows + [(None, "a b c", "s1"), (5, "x\x0by", "s2"), (5, "x\x0by", "s2"), (n, None, "s3"), (n + 1, "word " * 20000, "s1"), (n + 2, "a", "tiny")]


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DOCS_PER_SHARD", 100)
    rows = docs(900, random.Random(4))
    frame = spark.createDataFrame([(s, i, t, 1) for i, t, s in rows], "source string, doc_id long, text string, size int")
    got = mixing.mix(frame.repartition(5)).collect()
    again = mixing.mix(frame.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    size = {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, taken = brute_targets(size), {}
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], 3), s
    plain = {w for w in want if want[w] < 2 * size[w]}
    assert any(r.taken % r.size for r in got if r.source in plain and r.size)


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_native(spark):
    frame = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = mixing.mix(frame)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
