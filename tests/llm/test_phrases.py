import random
import re
from collections import Counter

from roadflux.llm import phrases

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least, most):
    counts, totals = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                own.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(q[i:i + len(p)] == p and 100 * b >= 50 * a for q, b in candidates.items() if len(q) > len(p) for i in range(len(q) - len(p) + 1)):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:most], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def got(frame):
    return {tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def corpus(seed, n, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" if k % 3 else f"É{k}A" for k in range(words)]
    docs = []
    for _ in range(n):
        text = "".join(rng.choice(vocabulary[:1 + int(words * rng.random() ** 2)]) + rng.choice([" "] * 12 + ["  ", "\t", ". ", "\n", ",", ";x", " \xa0 "]) for _ in range(rng.randint(0, 60)))
        docs.append((text, rng.choice(["en", "en", "en", "de", None])))
    return docs


def test_same_as_brute_force_with_few_and_many_wanted(spark):
    docs = corpus(1, 400)
    docs += [("Green Ideas sleep furiously now", "en")] * 30 + [("one fixed passage that many documents hold, word by word", "de")] * 12
    frame = spark.createDataFrame(docs, "text string, lang string").repartition(5)
    for most in (3, 5000):
        assert got(phrases.mined(frame, least=4, most=most)) == brute(docs, 4, most)


def test_floor_is_lowered_until_the_last_score_is_settled(spark):
    # Most pairs of high score are dropped for a longer phrase here, and few three-word phrases take their place.
    rng = random.Random(5)
    docs = [("alpha beta gamma", "en")] * 20 + [("delta eps zeta", "en")] * 20
    docs += [(f"p{k} q{k}", "en") for k in range(30) for _ in range(10 + k)] + [(f"p{rng.randrange(30)} r{rng.randrange(9)}", "en") for _ in range(900)]
    frame = spark.createDataFrame(docs, "text string, lang string")
    for most in (3, 7, 31):
        assert got(phrases.mined(frame, least=5, most=most)) == brute(docs, 5, most)


def test_ties_beyond_the_last_place_are_ordered_by_bytes(spark):
    docs = [(f"{a} {b}", "en") for a, b in [("z", "y"), ("é", "f"), ("a", "b"), ("日", "本"), ("𝔸", "x"), ("￮", "k")] for _ in range(6)]
    frame = spark.createDataFrame(docs, "text string, lang string")
    for most in (4,):
        assert got(phrases.mined(frame, least=6, most=most)) == brute(docs, 6, most)


def test_stretches_hold_every_phrase_once():
    text = ("one two, three four five six seven eight nine ten. " * 40).encode()
    for size in (1, 2, 3):
        want, have = Counter(), Counter()
        for words in phrases.stretches(text, size, 1 << 20):
            want.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
        for chunk in (1, 7, 50, 333):
            have.clear()
            for words in phrases.stretches(text, size, chunk):
                have.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
            assert have == want


def test_long_text_in_stretches(spark):
    rng = random.Random(2)
    docs = [(" ".join(rng.choice("abcdefgh") for _ in range(20000)), "en"), ("x" * 300_000 + " y", "en")]
    frame = spark.createDataFrame(docs, "text string, lang string")
    assert got(phrases.mined(frame, least=10, most=30, chunk=1000)) == brute(docs, 10, 30)


def test_edges(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.mined(empty).collect() == []
    docs = [(None, "en"), ("", None), ("  \t ", "de"), (".,;", "fr"), ("a", "en")]
    assert got(phrases.mined(spark.createDataFrame(docs, "text string, lang string"))) == set()
    named = spark.createDataFrame([("a b", None, "x", 1, 2)] * 10, "text string, lang string, w1 string, n int, floor int")
    assert got(phrases.mined(named)) == {("und", 1, "a b", 10, 10, 10, 20, 1_000_000)}


def test_counts_whose_products_pass_64_bits(spark):
    wide = spark.createDataFrame([(9_000_000_000_000, 9_000_000_000_001, 9_000_000_000_003)], "a long, l long, r long")
    a, left, right = 9_000_000_000_000, 9_000_000_000_001, 9_000_000_000_003
    assert wide.select(phrases._score(wide["a"], wide["l"], wide["r"])).first()[0] == 1_000_000 * a * a // (left * right)
