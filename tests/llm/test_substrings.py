import hashlib
import random

import pytest

from roadflux.llm import substrings

SCHEMA = "doc_id long, text string, c0 string, pack int, n_words string"


def brute(docs, window):
    words = [(d, (t or "").split()) for d, t in docs]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, float("inf")), float("inf") if d is None else d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (float("inf") if d is None else d):
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    def text(n):
        return [rng.choice("ab") + rng.choice(["", "é", "x"]) for _ in range(n)]
    docs = []
    for i in range(60):
        words = text(rng.choice([0, 3, 4, 5, 30, 200]))
        if docs and rng.random() < 0.5:
            other = (rng.choice(docs)[1] or "").split()
            a = rng.randrange(len(other) + 1)
            words += other[a:a + 40]
        docs.append((rng.choice([i, i, i, i % 7]), rng.choice([" ", "\n", "\t "]).join(words)))
    return docs + [(None, docs[5][1]), (100, None), (101, ""), (102, docs[9][1]), (102, docs[9][1]), (103, "same " * 3000), (104, "same " * 5)]


@pytest.mark.parametrize("window,pack_bytes", [(5, 1 << 20), (3, 300)])
def test_against_brute_force(spark, window, pack_bytes):
    docs = made(window)
    frame = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in docs], SCHEMA).repartition(3)
    out = substrings.dedup(frame, window=window, pack_bytes=pack_bytes)
    assert out.columns == ["doc_id", "text", "c0", "pack", "n_words", "n_removed", "kept_text", "kept_sha256"]
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text, r.kept_sha256) for r in out.collect()], key=str)
    assert got == brute(docs, window)


def test_empty(spark):
    assert substrings.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_other_whitespace_is_part_of_a_word(spark):
    frame = spark.createDataFrame([(1, "a b c\x0bd\x1fe")], "doc_id long, text string")
    row = substrings.dedup(frame, window=2).first()
    assert row.n_words == 3 and row.kept_text == "a b c d\x1fe"
