import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from roadflux.llm import suffixes


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(st.integers(0, 1), max_size=60), st.lists(st.integers(0, 4), max_size=40),
                 st.lists(st.integers(0, 255), max_size=40)))
def test_suffix_array(symbols):
    assert suffixes.suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize("text", [b"a" * 500, b"ab" * 300, b"ba" * 300, bytes(range(256)) * 3, b"abaabaaab" * 40, b"mississippi" * 9])
def test_suffix_array_of_periodic_text(text):
    symbols = list(text)
    assert suffixes.suffix_array(symbols) == sorted(range(len(text)), key=lambda i: symbols[i:])


def test_smallest_owner():
    texts = [b"abcdefghij" * 3, b"xx" + b"abcdefghij" * 2, b"\x00\x00abcdefghijk\x00\x00\x00"]
    got = suffixes.smallest_owner(texts, np.array([7, 3, 9]), 9)
    for k, text in enumerate(texts):
        for i in range(len(text) - 8):
            assert got[k][i] == min(o for o, t in zip([7, 3, 9], texts) if text[i:i + 9] in t)


def brute(docs, length):
    data = [(d, (t or "").encode()) for d, t in docs]
    inf = float("inf")
    first = {}
    for d, b in data:
        for i in range(len(b) - length + 1):
            first[b[i:i + length]] = min(first.get(b[i:i + length], inf), inf if d is None else d)
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (inf if d is None else d):
                gone[i:i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), int(gone.sum()), int(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("alphabet,pack_bytes,common", [("ab", 1 << 20, 3), ("abcdeé ", 400, 5000), ("abcdefghijklmnopqrstuvwxyz ü", 3000, 4)])
def test_against_brute_force(spark, alphabet, pack_bytes, common):
    rng = random.Random(alphabet)
    docs = []
    for i in range(80):
        text = "".join(rng.choices(alphabet, k=rng.choice([0, 5, 49, 60, 300])))
        if docs and rng.random() < 0.6:
            other = rng.choice(docs)[1]
            a = rng.randrange(len(other) + 1)
            text += other[a:a + rng.choice([49, 50, 51, 120])] + "".join(rng.choices(alphabet, k=20))
        docs.append((rng.choice([i, i, i % 5]), text))
    docs += [(None, docs[7][1]), (200, None), (201, ""), (202, docs[9][1]), (202, docs[9][1]), (203, "z" * 4000), (204, "z" * 60),
             (205, "é" * 70), (206, "xy" * 300), (207, "yx" * 40)]
    frame = spark.createDataFrame([(t, d, 1, "x") for d, t in docs], "text string, doc_id long, c0 int, n_bytes string").repartition(4)
    out = suffixes.dedup(frame, pack_bytes=pack_bytes, common=common)
    got = sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()], key=str)
    assert got == brute(docs, 50)


def test_empty(spark):
    assert suffixes.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
