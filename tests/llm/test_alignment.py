import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest

from roadflux.llm import alignment

A = Path(public_tokenizers.path("byte_bpe_50k.json")).read_bytes()
B = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tok():
    return alignment.Tokenizers(A, B)


def spans(ids, entries):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(entries[i]), i))
        at += len(entries[i])
    return out


def brute(tok, docs):
    linked, grouped, sizes = {}, {}, {}
    for n, (_, text) in enumerate(docs):
        linked[n], grouped[n], sizes[n] = [], "", (0, 0, 0)
        if not text:
            continue
        a, b = tok.a.encode(" " + text, add_special_tokens=False).ids, tok.b.encode(text)
        data = b" " + text.encode()
        if b"".join(tok.bytes_a[i] for i in a) != data or b"".join(tok.bytes_b[i] for i in b) != data:
            continue
        own_a, own_b = spans(a, tok.bytes_a), spans(b, tok.bytes_b)
        linked[n] = [(x, y) for s, e, x in own_a for t, f, y in own_b if s < f and t < e]
        cuts = sorted({e for _, e, _ in own_a} & {e for _, e, _ in own_b})
        shown, before = [], 0
        for c in cuts:
            shown.append("|".join(",".join(str(i) for s, e, i in own if before <= s and e <= c) for own in (own_a, own_b)))
            before = c
        grouped[n], sizes[n] = hashlib.sha256(";".join(shown).encode()).hexdigest(), (len(a), len(b), len(cuts))
    counts = Counter(p for own in linked.values() for p in set(own))
    highest = defaultdict(int)
    for (x, _), c in counts.items():
        highest[x] = max(highest[x], c)
    return sorted((i, *sizes[n], len(linked[n]), sum(counts[p] == highest[p[0]] for p in linked[n]), sum(counts[p] for p in linked[n]), grouped[n])
                  for n, (i, _) in enumerate(docs))


def corpus():
    rng = random.Random(4)
    words = ["the", "The", "über", "naïve", "日本語", "😀", "don't", "1234", "x_y", "  ", "\n\n", "\t", "…", "café", "Straße", "<s>", "</s>", "<|endoftext|>", "á"]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 25)))) for k in range(60)]
    docs += [(100 + k, "the very same text again") for k in range(25)] + [(200, None), (201, ""), (202, " "), (203, "▁ is no space"), (204, "nul \x00 and ­"), (205, "ﬁ ①"), (5, "repeated id")]
    return docs


@pytest.mark.parametrize("hot", [0, 30, alignment.HOT])
def test_same_as_brute_force(spark, tok, hot):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = alignment.align(frame, A, B, hot=hot).select(*NAMES)
    assert sorted(tuple(r) for r in got.collect()) == brute(tok, docs)


def test_many_copies_are_counted_once_and_weighted(spark, tok, monkeypatch):
    monkeypatch.setattr(alignment, "LEAST_COPIES", 3)
    docs = corpus()
    got = alignment.align(spark.createDataFrame(docs, "doc_id long, text string"), A, B).select(*NAMES)
    assert sorted(tuple(r) for r in got.collect()) == brute(tok, docs)


def test_parts_have_the_tokens_of_the_whole(tok):
    rng = random.Random(1)
    words = ["plain", "words", "it's", "'s", "über", "x  y", "日本", "a", "I", "\n", "Ü b", "9 lives", "end.", "²", "_", "a\u0301", "(b)", "\xa0", "▁", "Ⅷ", "\x1c"]
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(300))
        own_a, own_b = zip(*(tok.encoded([p])[:2] for p in alignment.parts(text)))
        whole_b = tok.b.encode(text)
        if "▁" not in text:
            assert sum(own_a, []) == tok.a.encode(" " + text, add_special_tokens=False).ids and sum(own_b, []) == whole_b
        assert " ".join(alignment.parts(text)) == text
    assert tok.separable and len(alignment.parts("some words of a text")) == 5


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(none, A, B).collect() == []
    nothing = spark.createDataFrame([(1, None), (None, ""), (1, None)], "doc_id long, text string")
    assert sorted(map(str, alignment.align(nothing, A, B).select("doc_id", "n_links", "groups_sha256").collect())) == sorted(
        ["Row(doc_id=1, n_links=0, groups_sha256='')"] * 2 + ["Row(doc_id=None, n_links=0, groups_sha256='')"])
    clashing = spark.createDataFrame([(1, "some words", "k", 3, 4)], "doc_id long, text string, key string, copies int, pair int")
    assert alignment.align(clashing, A, B).first().n_links > 0


def test_long_text(spark, tok):
    text = "some words of a rather long document, " * 8000
    got = alignment.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).first()
    assert got.n_a == len(tok.a.encode(" " + text, add_special_tokens=False).ids) and got.n_b == len(tok.b.encode(text))
