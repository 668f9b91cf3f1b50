"""Phrase mining against a direct count, with every prefix depth in use."""

import random
import re
from collections import Counter

import pytest
from conftest import SCHEMA

from tabforge.llm import phrase_mining as M

UPPER = {i: i + 32 for i in range(65, 91)}


def direct(rows, max_words=3, min_count=10, share=50, top=2000):
    f, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            w = re.findall("[^ \t]+", piece)
            sizes[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {p: a for p, a in f.items() if len(p[1]) >= 2 and a >= min_count}
    gone = set()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * a >= share * f[lang, w[i:i + k]]:
                    gone.add((lang, w[i:i + k]))
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) in gone:
            continue
        score, k = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i, p.decode(), -a, left, right, sizes[lang], -s)
            for lang, c in out.items() for i, (s, a, p, left, right) in enumerate(sorted(c)[:top], 1)}


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang) + ("s", 1, "", "", 1, 2, "", "", "", "") for i, (lang, t) in enumerate(rows)], SCHEMA).repartition(4)


def corpus(seed=3, docs=120):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "City", "a", "é", "über", "it's", "x y", "Z"] + [f"r{i}" for i in range(300)]
    rows = []
    for i in range(docs):
        w = [rng.choice(words[:11] if rng.random() < 0.8 else words) for _ in range(rng.randrange(0, 120))]
        text = "".join(x + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for x in w)
        rows.append((rng.choice(["en", "en", "de", None]), text + "the of the of new YORK city the the the "))
    return rows + [("en", None), ("fr", ""), ("en", "one"), ("de", rows[0][1]), ("en", rows[1][1]), ("en", rows[1][1])]


@pytest.mark.parametrize("budget", [1 << 20, 400, 16])
def test_equals_direct(spark, budget):
    """A small budget makes words, then pairs, heavy; counts stay the same."""
    rows = corpus()
    got = {tuple(r) for r in M.collocations(table(spark, rows), budget=budget).collect()}
    assert got == direct(rows) and len(got) > 50


@pytest.mark.parametrize("args", [{"max_words": 2}, {"max_words": 4, "min_count": 5, "share": 90}, {"top": 7, "min_count": 12}])
def test_other_parameters(spark, args):
    rows = corpus(5, 60)
    got = {tuple(r) for r in M.collocations(table(spark, rows), budget=300, **args).collect()}
    assert got == direct(rows, **args)


def test_chunks_lose_no_word_and_join_none():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab .\n,") for _ in range(rng.randrange(0, 400))).encode() for _ in range(30)] + [b"x" * 500, b"y " * 300 + b"." + b"z " * 100]
    for size in (1, 7, 50, 10_000):
        pieces = Counter(p.strip(b" ") for c in M.chunks(texts, size) for p in re.split(rb"[.,;:!?\n-\r]", c))
        want = Counter(p.strip(b" ") for t in texts for p in re.split(rb"[.,;:!?\n-\r]", t))
        del pieces[b""], want[b""]
        assert pieces == want


def test_empty_and_edges(spark, edge, no_docs):
    assert M.collocations(no_docs).count() == 0
    rows = [(r["lang"], r["text"]) for r in edge.collect()]
    assert {tuple(r) for r in M.collocations(edge, min_count=3).collect()} == direct(rows, min_count=3)


def test_each_key_hashes_anew():
    words = M.words_of(b"alpha beta gamma")[1]
    assert len({int(h) for key in range(4) for h in M.word_hash(words, key)}) == 12
