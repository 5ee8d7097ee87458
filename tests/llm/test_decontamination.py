import random

import pytest
from hypothesis import given, settings, strategies as st

from roadflux.llm import decontamination as D


def nearest(item, text):
    """Smallest edit distance between the item and a stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (c != d)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=20, max_size=60), st.text("abcd", max_size=80), st.integers(0, 2 ** 32))
def test_myers(item, text, seed):
    rng = random.Random(seed)
    if rng.random() < 0.7:
        near = list(item)
        for _ in range(rng.randrange(5)):
            k = rng.randrange(len(near))
            near[k:k + 1] = rng.choice([[], ["x"], [near[k], "y"]])
        text = text[:10] + "".join(near) + text[10:]
    pattern = D.Pattern(item)
    assert pattern.occurs(text) == (nearest(item, text) <= pattern.errors)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", 600)
    monkeypatch.setattr(D, "TEXT_BYTES", 2000)
    rng = random.Random(8)
    words = ["the", "of", "an", "Tion", "ought", "re"]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, text(rng.choice([1, 3, 20, 40]))) for i in range(25)] + [(90, None), (91, "  "), (5, "twice the item"), (None, "no id at all here")]
    docs = []
    for i in range(60):
        body = text(rng.choice([0, 10, 60]))
        if rng.random() < 0.6:
            leak = list(rng.choice(items[:25])[1])
            for _ in range(rng.randrange(8)):
                leak[rng.randrange(len(leak))] = rng.choice("xyz \n")
            body += " \n " + "".join(leak).upper() + " " + text(5)
        docs.append((i, body))
    docs += [(100, None), (101, ""), (7, docs[7][1]), (102, "w " * 3000 + (items[3][1] or ""))]
    frame = spark.createDataFrame([(t, i, 1) for i, t in docs], "text string, doc_id long, c0 int")
    got = D.contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["text", "doc_id", "c0", "leaked"]
    want = []
    for i, t in docs:
        found = [k for k, x in items if D.plain(x) and nearest(D.plain(x), D.plain(t)) <= int(D.ERRORS * len(D.plain(x)))]
        want.append((i, sorted(found, key=lambda k: (k is None, k))))
    assert sorted(((r.doc_id, list(r.leaked)) for r in got.collect()), key=str) == sorted(want, key=str)


def test_blocks_change_neither_plan_nor_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i} holds item number {i % 40} as it is") for i in range(100)], "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(i, f"holds item number {i} as it is") for i in range(40)] + [(7, "holds item number 7 as it is")] * 30, "item_id long, text string")
    plans, results, sizes = [], [], []
    collect = type(items).collect
    monkeypatch.setattr(type(items), "collect", lambda frame: sizes.append(frame.count()) or collect(frame))
    for most, blocks in ((1 << 20, 1), (800, 3)):
        monkeypatch.setattr(D, "BLOCK_BYTES", most)
        assert D.stored(items)[1] == blocks
        got = D.contaminated(docs, items)
        assert all(n <= 1 for n in sizes)
        plans.append(got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))
        results.append(sorted((r.doc_id, tuple(r.leaked)) for r in collect(got)))
    assert plans == [1, 1] and results[0] == results[1]
    assert dict(results[0])[7].count(7) == 31


@pytest.mark.parametrize("n", [0, 3])
def test_empty(spark, n):
    docs = spark.createDataFrame([(i, "x") for i in range(n)], "doc_id long, text string")
    got = D.contaminated(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert [r.leaked for r in got] == [[]] * n
