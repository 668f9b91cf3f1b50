"""Language ID and language-model scores."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import langid, maxent_lm

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("held", langid.held_out(F.col("doc_id")))
    model = langid.train(docs.where(~F.col("held")), per_language=100)
    out = langid.predict(docs.where("held").select("doc_id", "text"), model)
    truth = {r[0]: r[1] for r in docs.where("held").select("doc_id", "lang").collect()}
    rows = out.select("row.doc_id", "lang_pred", "score").collect()
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_undetermined_and_clashing_columns(spark, edge, no_docs):
    model = langid.train(edge)
    assert model.langs == ["de", "en", "fr"]
    rows = {(r["row"]["doc_id"], r["row"]["text"]): r for r in langid.predict(edge, model).collect()}
    for (_, text), r in rows.items():
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model.langs and 1 / 3 <= r["score"] <= 1
    assert langid.predict(no_docs, model).count() == 0
    nothing = langid.train(no_docs)
    assert nothing.langs == [] and {r["lang_pred"] for r in langid.predict(edge, nothing).collect()} == {"und"}


def test_a_language_of_copies_is_sampled_by_its_texts(spark):
    """Copies of one text, or texts without a letter, make up nearly all rows of a language."""
    real = [(f"der Hund {i} und die Katze n{i * 7919:x}x", "de") for i in range(200)]
    other = [(f"the dog {i} and the cat n{i * 7919:x}x", "en") for i in range(1000)]
    few = [(f"le chien {i} et le chat n{i * 7919:x}x", "fr") for i in range(55)]
    rows = spark.createDataFrame(real + other + few, "_text string, _lang string")
    copies = spark.range(20_000).select(F.lit("das gleiche Blatt").alias("_text"), F.lit("de").alias("_lang"))
    bare = spark.range(20_000).select(F.col("id").cast("string").alias("_text"), F.lit("en").alias("_lang"))
    both = rows.union(copies).union(bare)
    lettered = langid.sample(both, 60).where(F.col("_text").rlike("[a-z]"))
    drawn = {r["_lang"]: r["count"] for r in lettered.groupBy("_lang").count().collect()}
    assert 35 <= drawn["de"] <= 95 and 35 <= drawn["en"] <= 95 and drawn["fr"] == 55
    model = langid.train(both, text_col="_text", lang_col="_lang", per_language=60)
    assert model.langs == ["de", "en", "fr"]


def test_prediction_reads_the_text_only(spark, edge):
    model = langid.train(edge)
    pick = lambda df: {r["row"]["text"]: (r["lang_pred"], r["score"]) for r in langid.predict(df, model).collect()}
    assert pick(edge) == pick(edge.withColumn("lang", F.lit("en")).withColumn("source", F.lit("q")).repartition(1))


def test_the_text_travels_once(edge):
    rows = langid.predict(edge, langid.train(edge))
    plan = rows._jdf.queryExecution().analyzed().toString()
    sent = plan.split("MapInArrow")[1].split("\n")[1]
    assert "struct(" in sent and " AS _text#" not in sent.split("AS row#")[1]


def test_grams_against_plain_python():
    g = langid.Grams()
    texts = ["Ab, c", None, "", "é1é", "\U00010400x", "  "]
    orders, total, has = g(texts)
    assert has.tolist() == [True, False, False, True, True, False]
    cleaned = [" ab c ", " ", " ", " é é ", f" {chr(0x10428)}x ", " "]
    assert total.tolist() == [sum(max(0, len(c) - n + 1) for n in (1, 2, 3)) for c in cleaned]
    f, d = orders[1]
    assert f[d == 3].tolist()[0] == f[d == 3].tolist()[2]            # " é" twice


def test_ftrl_penalties_and_temperature():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 20))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(int)
    onehot = np.eye(2)[y]
    loose, strict = (langid.Ftrl(2, 20, 0.5, 1.0, l1, 0.0) for l1 in (0.0, 8.0))
    for lo in range(0, 400, 16):
        for m in (loose, strict):
            m.update(np.arange(20), x[lo:lo + 16], onehot[lo:lo + 16])
    assert (strict.weights() == 0).sum() > (loose.weights() == 0).sum()
    assert strict.weights()[1, 0] > 0 and (langid.softmax(x @ strict.weights().T).argmax(1) == y).mean() > 0.85
    logits = x @ loose.weights().T
    t = langid.best_temperature(logits * 3, y)
    assert t == pytest.approx(3 * langid.best_temperature(logits, y), rel=0.02)


def tokens(text):
    return (text or "").encode().lower().split() + [0]


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 1


def check_scores(docs, head=None):
    rows = docs.select("doc_id", "text").collect()
    c = Counter(w for r in rows if not held(r["doc_id"]) for w in tokens(r["text"]))
    n, v = sum(c.values()), len(c)
    got = maxent_lm.score_texts(docs, langid.held_out(F.col("doc_id"), 5, 1)).collect()
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], held(r["doc_id"]), len(tokens(r["text"])), sum(c[w] > 0 for w in tokens(r["text"])), n)
                  for r in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == want
    base = sorted(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(r["text"])) for r in rows)
    assert np.allclose(sorted(r["base_score"] for r in got), base, rtol=1e-9)
    assert all(r["score"] <= 1e-9 and math.isfinite(r["score"]) for r in got)
    return got


def test_lm_edge(edge, no_docs, monkeypatch):
    check_scores(edge)
    assert maxent_lm.score_texts(no_docs, F.lit(True)).count() == 0
    out = maxent_lm.score_texts(edge, F.lit(True)).collect()             # nothing to learn from
    assert all(r["base_score"] == pytest.approx(0) and r["score"] == pytest.approx(0) and r["train_tokens"] == 0 for r in out)


def test_lm_words_beyond_the_broadcast(edge, monkeypatch):
    monkeypatch.setattr(maxent_lm, "HEAD", 20)
    check_scores(edge)


def test_lm_beats_the_unigram_on_held_out_texts(spark):
    out = [r for r in check_scores(spark.read.parquet(f"{SF}/documents.parquet")) if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_lm_beats_an_interpolated_bigram_on_held_out_texts(spark, monkeypatch):
    """Trained in six tasks, at the size from which the model is ahead (three million tokens)."""
    monkeypatch.setattr(maxent_lm, "TASK_TOKENS", 140_000)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").repartition(6)
    rows = {r["doc_id"]: tokens(r["text"]) for r in docs.collect()}
    one, two, before = Counter(), Counter(), Counter()
    pairs = lambda t: zip([None, *t], t)
    for i, t in rows.items():
        if not held(i):
            one.update(t)
            two.update(pairs(t))
            before.update([None, *t[:-1]])
    n, v = sum(one.values()), len(one)
    got = {r["doc_id"]: r["score"] for r in maxent_lm.score_texts(docs, langid.held_out(F.col("doc_id"), 5, 1)).collect() if r["held_out"]}
    bigram = Counter()
    for i in got:
        for p, w in pairs(rows[i]):
            base, seen, both = (one[w] + 0.5) / (n + 0.5 * (v + 1)), before[p], two[p, w]
            for strength in (50, 500, 5000):
                bigram[strength] += math.log10((both + strength * base) / (seen + strength))
    count = sum(len(rows[i]) for i in got)
    bits = lambda x: x / count / math.log10(2)
    assert bits(sum(got.values())) > bits(max(bigram.values())), {k: bits(x) for k, x in bigram.items()}


def sample_counts(n=900, bits=3, seed=1):
    """Frequent words, some rare ones, and their counts."""
    rng = np.random.default_rng(seed)
    h = np.sort(rng.integers(1, 2**64 - 1, n + 60, dtype=np.uint64))
    c = rng.integers(1, 50, n + 60)
    rare = np.zeros(len(h), bool)
    rare[rng.choice(len(h), 60, replace=False)] = True
    mass = np.bincount(maxent_lm.classes(h[rare], bits), c[rare] + 0.5, minlength=1 << bits)
    counts = maxent_lm.build(int(c.sum()), len(h), h[~rare], c[~rare], bits, mass, rng.integers(0, 9, n))
    return counts, h, c, rare


def full_scores(counts, c_of, model, h, first):
    """Natural log probability of each token, rare and unknown words included."""
    word, out, inner = model.score(h, first)
    for i in np.flatnonzero(word < 0):
        c = c_of.get(int(h[i]))
        if c is None:
            out[i] += math.log(0.5 / counts.rare)
        else:
            cls = maxent_lm.classes(h[i:i + 1], counts.rare_bits)[0]
            out[i] += math.log((counts.rare - 0.5) / counts.rare) + inner[i] + math.log((c + 0.5) / counts.rare_mass[cls])
    return out


def test_model_sums_to_one():
    """Given any context, the probabilities of all words and the unknown word add up to one."""
    counts, h, c, _ = sample_counts()
    weights = np.random.default_rng(2).normal(0, 0.5, 1 << 16).astype(np.float32)
    model, c_of = maxent_lm.MaxEnt(counts, weights), dict(zip(h.tolist(), c.tolist()))
    total = 0.0
    for w in [*h, np.uint64(5)]:
        total += math.exp(full_scores(counts, c_of, model, np.array([h[3], h[7], w]), np.zeros(3, np.int64))[2])
    assert total == pytest.approx(1, abs=1e-4)
    flat = full_scores(counts, c_of, maxent_lm.MaxEnt(counts, np.zeros(1 << 16, np.float32)), h, np.zeros(len(h), np.int64))
    assert np.allclose(flat, np.log((c + 0.5) / counts.total), atol=1e-5)


class Direct:
    """The same model one token and one split at a time, in plain Python numbers."""

    def __init__(self, counts, weights):
        self.counts, self.w, self.state = counts, [float(x) for x in weights], [0.0] * len(weights)
        self.place = {int(h): i for i, h in enumerate(counts.words)}

    def mix(self, x):
        return int(maxent_lm.mix64(np.array([x & (2**64 - 1)], np.uint64))[0])

    def features(self, text, i):
        p, q = (text[i - k] if i >= k else k for k in (1, 2))
        r = next((w for w in reversed(text[:i]) if w in self.place and self.counts.anchor[self.place[w]]), 3)
        return [self.mix(x) for x in (p * 3, self.mix(p * 5 + self.mix(q)), q * 7 + 11, r * 13 + 17)]

    def splits(self, text, i):
        """(places of the weights, log-odds, right side taken, inside the rare words) of the token's splits."""
        w, n = text[i], len(self.counts.words)
        bits = self.counts.rare_bits
        ways = [self.place[w]] if w in self.place else [n, n + 1 + (w >> (64 - bits) if bits else 0)]
        quarter = len(self.w) // 4
        for leaf in ways:
            for k in range(self.counts.start[leaf], self.counts.start[leaf + 1]):
                split = int(self.counts.split[k])
                places = []
                for part, f in enumerate(self.features(text, i)):
                    places.append(part * quarter + ((f ^ self.mix(split)) * quarter >> 64))
                yield places, float(self.counts.bias[split]), bool(self.counts.right[k]), leaf > n

    def score(self, text, i):
        out = [0.0, 0.0]
        for places, bias, right, inside in self.splits(text, i):
            x = bias + sum(self.w[k] for k in places)
            out[inside] -= math.log1p(math.exp(-x if right else x))
        return out

    def step(self, texts, rate):
        """One update over all tokens of ``texts``."""
        moves = []
        for text in texts:
            for i in range(len(text)):
                for places, bias, right, _ in self.splits(text, i):
                    g = 1 / (1 + math.exp(-bias - sum(self.w[k] for k in places))) - right
                    moves += [(k, g) for k in places if abs(g) > maxent_lm.LEAST]
        for k, g in moves:
            self.state[k] += g * g
        for k, g in moves:
            self.w[k] -= rate * g / math.sqrt(self.state[k] + 1)


def test_training_and_scores_against_a_direct_model():
    counts, h, _, rare = sample_counts(n=300)
    rng = np.random.default_rng(4)
    texts = [rng.choice(np.concatenate([h, np.array([7], np.uint64)]), m).tolist() for m in (40, 1, 0, 90, 3)]
    flat = np.array([w for t in texts for w in t], np.uint64)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    start = rng.normal(0, 0.3, 1 << 10).astype(np.float32)
    model, direct = maxent_lm.MaxEnt(counts, start.copy()), Direct(counts, start)
    state = np.zeros_like(start)
    for _ in range(3):
        model.train(flat, maxent_lm._starts(off), state, 0.2)
        direct.step(texts, 0.2)
    assert np.allclose(model.w, direct.w, atol=1e-4) and np.allclose(state, direct.state, rtol=1e-3, atol=1e-4)
    assert np.abs(model.w - start).max() > 0.05
    word, out, inner = model.score(flat, maxent_lm._starts(off))
    want = np.array([direct.score(t, i) for t in texts for i in range(len(t))])
    assert np.allclose(out, want[:, 0], atol=1e-3) and np.allclose(inner, want[:, 1], atol=1e-3)
    assert (word < 0).sum() == sum(w in set(h[rare].tolist()) or w == 7 for w in flat.tolist())


def test_half_floats_as_floats():
    every = np.arange(1 << 16).astype(np.uint16).view(np.float16)
    every = every[np.isfinite(every)]
    got = maxent_lm.wide(every)
    assert got.dtype == np.float32 and (got == every.astype(np.float32)).all()


def test_scores_from_half_floats_equal_those_from_floats(monkeypatch):
    """Weights are read as half floats, some blocks together; the logits are sums of floats."""
    monkeypatch.setattr(maxent_lm, "BLOCK", 16)
    monkeypatch.setattr(maxent_lm, "SCORED", 3)
    counts, h, _, _ = sample_counts(n=300)
    rng = np.random.default_rng(6)
    texts = [rng.choice(np.concatenate([h, np.array([7], np.uint64)]), m).tolist() for m in (50, 0, 1, 70)]
    flat = np.array([w for t in texts for w in t], np.uint64)
    first = maxent_lm._starts(np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    half = rng.normal(0, 0.3, 1 << 16).astype(np.float16)
    got, same = (maxent_lm.MaxEnt(counts, w).score(flat, first) for w in (half, half.astype(np.float32)))
    assert all((a == b).all() for a, b in zip(got, same))
    direct = Direct(counts, half)
    want = np.array([direct.score(t, i) for t in texts for i in range(len(t))])
    assert np.allclose(got[1], want[:, 0], atol=1e-5) and np.allclose(got[2], want[:, 1], atol=1e-5)


def test_lookup_of_words_that_share_leading_bits():
    rng = np.random.default_rng(8)
    top = np.uint64(2**64 - 1)
    words = np.unique(np.concatenate([rng.integers(0, 2**64 - 1, 500, dtype=np.uint64), np.arange(9, dtype=np.uint64), top - np.arange(7, dtype=np.uint64)]))
    counts = maxent_lm.build(len(words), len(words), words, np.ones(len(words), np.int64), 0, np.zeros(1))
    asked = np.concatenate([words, words + np.uint64(1), words - np.uint64(1), rng.integers(0, 2**64 - 1, 500, dtype=np.uint64)])
    place = {int(w): i for i, w in enumerate(words)}
    assert maxent_lm.lookup(counts, asked).tolist() == [place.get(int(w), -1) for w in asked]
    below = maxent_lm.build(3, 3, words[:3], np.ones(3, np.int64), 0, np.zeros(1))
    assert maxent_lm.lookup(below, asked).tolist() == [-1 if place.get(int(w), 9) > 2 else place[int(w)] for w in asked]


@pytest.mark.parametrize("head", [1 << 17, 20])
def test_scores_of_a_table_against_a_direct_model(edge, monkeypatch, head):
    """Whole score_texts with given weights: rare words are joined, unknown ones share half a count."""
    monkeypatch.setattr(maxent_lm, "HEAD", head)
    weights = np.random.default_rng(3).normal(0, 0.3, 1 << 10).astype(np.float16)
    seen = []
    monkeypatch.setattr(maxent_lm, "train", lambda texts, counts, rounds, rate: seen.append(counts.value) or weights)
    docs = edge.dropDuplicates(["doc_id", "text"])
    got = maxent_lm.score_texts(docs, langid.held_out(F.col("doc_id"), 5, 1)).collect()
    counts, = seen
    hashes = lambda t: maxent_lm.stream(maxent_lm.pa.array([t], maxent_lm.pa.string()))[0].tolist()
    rows = docs.select("doc_id", "text").collect()
    c = Counter(w for r in rows if not held(r["doc_id"]) for w in hashes(r["text"]))
    direct, want = Direct(counts, weights), []
    for r in rows:
        text, total = hashes(r["text"]), 0.0
        for i, w in enumerate(text):
            outer, inside = direct.score(text, i)
            total += outer
            if w not in direct.place:
                cls = w >> (64 - counts.rare_bits) if counts.rare_bits else 0
                total += (inside + math.log((c[w] + 0.5) / counts.rare_mass[cls]) + math.log((counts.rare - 0.5) / counts.rare)
                          if c[w] else math.log(0.5 / counts.rare))
        want.append(total / math.log(10))
    assert np.allclose(sorted(r["score"] for r in got), sorted(want), rtol=1e-4, atol=1e-4)


def test_words_of_like_contexts_share_a_class():
    rng = np.random.default_rng(0)
    marks = rng.choice([-1.0, 1.0], (4, maxent_lm.DIMS))
    kind, mass = rng.integers(0, 4, 400), rng.integers(20, 400, 400).astype(float)
    of = maxent_lm.group(marks[kind] * mass[:, None] + rng.normal(0, 1, (400, maxent_lm.DIMS)) * np.sqrt(mass)[:, None], mass, 4)
    assert len({(a, b) for a, b in zip(of.tolist(), kind.tolist())}) == 4
    assert maxent_lm.group(np.zeros((5, maxent_lm.DIMS)), np.ones(5), 4).tolist() == [0] * 5
    assert len(maxent_lm.group(np.zeros((0, maxent_lm.DIMS)), np.zeros(0), 4)) == 0
