import functools
import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from roadflux.llm import language


@functools.cache
def sign(c):
    return np.random.default_rng([language.SEED, c]).integers(0, 2, language.DIMENSIONS) * 2 - 1


def brute_vector(text):
    symbols, gap = [0x110000], True
    for c in (text or "").lower():
        if c.isalpha():
            symbols.append(ord(c))
            gap = False
        elif not gap:
            symbols.append(0x110000)
            gap = True
    if not gap:
        symbols.append(0x110000)
    total = np.zeros(language.DIMENSIONS, np.int64)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        total += np.roll(sign(a), 2) * np.roll(sign(b), 1) * sign(c)
    return total


def corpus():
    rng = random.Random(3)
    words = {"aa": ["lor", "em", "ip", "Sum"], "bb": ["крок", "дім", "та"], "cc": ["über", "straße", "ein"]}
    docs = []
    for i in range(120):
        lang = rng.choice(list(words))
        docs.append((i, ", ".join(rng.choices(words[lang], k=rng.choice([1, 5, 60]))), lang if rng.random() < 0.9 else None))
    docs += [(200, None, "aa"), (201, "12 -- 3", "bb"), (202, "", None), (203, "x", None), (None, "lor em", "cc"), (5, docs[5][1], docs[5][2]),
             (204, "lorem " * 30000, "aa"), (205, "é 1 漢字", None)]
    return docs


def test_against_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame([(t, i, l, 1.0) for i, t, l in docs], "text string, doc_id long, lang string, score double").repartition(3)
    prototypes = language.learn(frame)
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    want = {}
    for i, t, l in docs:
        if i is not None and l is not None and t is not None and not out(i):
            want[l] = want.get(l, 0) + brute_vector(t)
    assert set(want) == set(prototypes) and all((want[l] == prototypes[l]).all() for l in want)
    got = sorted(map(tuple, language.predict(frame, prototypes).collect()), key=str)
    expect = []
    for i, t, _ in docs:
        v = brute_vector(t)
        if not any(c.isalpha() for c in t or ""):
            expect.append((i, i is not None and out(i), "und", 0.0))
        else:
            cos = {l: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for l, p in want.items()}
            best = max(sorted(cos), key=cos.get)
            expect.append((i, i is not None and out(i), best, max(0.0, cos[best])))
    expect.sort(key=str)
    assert [g[:3] for g in got] == [e[:3] for e in expect]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in expect])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab ,Σé漢\n", max_size=40) | st.none(), min_size=1, max_size=6), st.integers(1, 7), st.integers(1, 5))
def test_cut_and_sliced(texts, chars, part):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(language, "_CHARS_AT_ONCE", chars)
        patch.setattr(language, "SLICE", part)
        trigrams, total = language.Trigrams(), np.zeros((len(texts), language.DIMENSIONS), np.int64)
        lettered = np.zeros(len(texts), bool)
        for runs in language._portions(texts):
            sums, letters = trigrams.bundles(runs, len(texts))
            total += sums
            lettered |= letters
    assert (total == np.array([brute_vector(t) for t in texts])).all()
    assert lettered.tolist() == [any(c.isalpha() for c in t or "") for t in texts]


def test_many_distinct_trigrams_in_bounded_memory(tmp_path):
    # in a process of its own, since the peak of this one says nothing: a million characters, some 900,000 distinct trigrams
    script = tmp_path / "peak.py"
    script.write_text(
        "import random, resource\nfrom roadflux.llm import language\nrng = random.Random(1)\n"
        "text = ''.join(chr(0x4E00 + rng.randrange(3000)) for _ in range(1_000_000))\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\ntrigrams = language.Trigrams()\n"
        "for runs in language._portions([text]):\n    trigrams.bundles(runs, 1)\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)\n")
    root = str(Path(language.__file__).parents[2])
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": root}, timeout=300)
    assert int(done.stdout) < 1 << 20  # KB


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = language.predict(docs, language.learn(docs)).join(docs.select(F.col("doc_id").alias("id"), "lang"), "id").where("held_out")
    assert done.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.learn(frame) == {}
    assert language.predict(frame, {}).count() == 0
    one = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert language.predict(one, {}).first().lang_pred == "und"
