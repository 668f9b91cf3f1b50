"""Licence scan, decontamination and nearest neighbours against brute force."""

import itertools
import random
import re
import string

import numpy as np

from tabforge.llm import decontaminate as D
from tabforge.llm import license_scan as L
from tabforge.llm import multi_index as MI

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- licences

def pairs(text):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i:i + 2]) for i in range(max(1, len(w) - 1))} if w else set()


def licence_docs():
    rng = random.Random(5)
    filler = "the of is under this any work to in software license and version public".split()
    rows, want = [], set()
    notices = [(n, t) for n, ts in L.TEMPLATES.items() for t in ts]
    for i, (name, text) in enumerate(notices * 3):
        before = " ".join(rng.choice(filler) + str(rng.randrange(9)) for _ in range(rng.randrange(0, 60)))
        rows.append((i, f"{before}\n{text.upper() if i % 2 else text} {before}"))
        want.add((i, name))
    n = len(rows)
    # one word in a long notice changed: four fifths of its shingles are still there; half a notice is not enough
    long = L.TEMPLATES["MIT"][1].split()
    rows += [(n, " ".join(long[:20] + ["OTHER"] + long[21:])), (n + 1, " ".join(long[:len(long) // 2])), (n + 2, None), (n + 3, ""),
             (n + 4, "| |"), (n + 5, "Released under the BSD License."), (n + 6, " ".join(rng.choice(filler) for _ in range(30_000))),
             (None, "Released under the MIT License."), (n + 7, "x " * 20_000 + "released under the MIT license")]
    want |= {(n, "MIT"), (-1, "MIT"), (n + 7, "MIT")}
    return rows, want


def test_licences(spark, no_docs):
    rows, want = licence_docs()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, w string, at int").repartition(3)
    out = L.scan(df).collect()
    got = {(-1 if r["doc_id"] is None else r["doc_id"], r["licence"]) for r in out}
    assert want <= got
    texts = {-1 if d is None else d: t for d, t in rows}
    for d, name in got - want:                       # a text may hold another notice's words as well
        assert any(len(pairs(t) & pairs(texts[d])) >= 0.8 * len(pairs(t)) for t in L.TEMPLATES[name]), (d, name)
    assert all(r["containment"] >= 0.8 for r in out)
    assert L.scan(no_docs).count() == 0


def test_licences_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {(r["doc_id"], r["licence"]) for r in L.scan(docs).collect()}
    want = set()
    for r in docs.select("doc_id", "text").collect():
        flat = " ".join(re.findall(r"[^\W_]+", (r["text"] or "").lower()))
        want |= {(r["doc_id"], n) for n, ts in L.TEMPLATES.items() for t in ts if " ".join(re.findall(r"[^\W_]+", t.lower())) in flat}
    assert got == want and want


def test_altered_notices_against_brute_force(spark):
    """Words replaced, dropped and put in: every copy that holds four fifths of a notice's shingles is found, and no other."""
    rng = random.Random(11)
    rows, want = [], set()
    for i, (name, text) in enumerate([(n, t) for n, ts in L.TEMPLATES.items() for t in ts] * 12):
        w = text.split()
        for _ in range(rng.randrange(1, 2 + len(w) // 12)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([["other"], [], [w[at], "put", "in"]])
        around = " ".join(f"z{rng.randrange(50)}" for _ in range(rng.randrange(40)))
        rows.append((i, f"{around} {' '.join(w)} {around}"))
        want |= {(i, n) for n, ts in L.TEMPLATES.items() for t in ts if len(pairs(t) & pairs(rows[-1][1])) >= 0.8 * len(pairs(t))}
    got = {(r["doc_id"], r["licence"]) for r in L.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == want and len(want) > 40 and len({d for d, _ in want}) < len(rows)


def test_a_library_of_thousands_of_pieces(spark, monkeypatch):
    """Forty licences of 500 words, more than 5,000 pieces; also with a table of bits that is nearly full."""
    rng = random.Random(12)
    library = {f"licence {i}": [" ".join(f"w{rng.randrange(3000)}" for _ in range(510))] for i in range(41)}
    rows = [(i, f"before it {t[0]} after it") for i, t in enumerate(library.values())]
    rows += [(100 + i, " ".join(t[0].split()[:200])) for i, t in enumerate(library.values())]      # less than half of one
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {(i, n) for i, n in enumerate(library)}
    assert {(r["doc_id"], r["licence"]) for r in L.scan(docs, templates=library).collect()} == want
    monkeypatch.setattr(L, "MAX_BITS", 14)
    assert {(r["doc_id"], r["licence"]) for r in L.scan(docs.where("doc_id % 10 = 0"), templates=library).collect()} == {x for x in want if x[0] % 10 == 0}


# ---------------------------------------------------------------- decontamination

def words(t):
    return [w for w in ((x.decode().strip(string.punctuation)) for x in (t or "").encode().lower().split()) if w]


def shares_run(a, b):
    """13 tokens or more on one diagonal, four fifths of them equal, with a window that one mask accepts; short items whole."""
    a, b = words(a), words(b)
    if len(b) < D.SPAN:
        return len(b) >= D.SHORTEST and any(a[i:i + len(b)] == b for i in range(len(a) - len(b) + 1))
    for shift in range(-len(b), len(a)):
        same = [0 <= i + shift < len(a) and a[i + shift] == w for i, w in enumerate(b)]
        for i in range(len(b) - D.SPAN + 1):
            if 0 <= i + shift and i + shift + D.SPAN <= len(a) and any(all(same[i + j] for j in m) for m in D.MASKS) \
                    and sum(same[i:i + D.SPAN]) >= 0.8 * D.SPAN:
                return True
    return False


def leak_rows():
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(400))
    items = [(i, " ".join(word() for _ in range(rng.randrange(13, 40)))) for i in range(12)]
    items += [(20, "short item of six words here"), (21, "too short"), (22, None), (23, "")]
    rows = []
    for d in range(60):
        body = [word() for _ in range(rng.randrange(0, 80))]
        kind = d % 6
        item = items[d % 12][1].split()
        if kind == 1:
            body[5:5] = item
        elif kind == 2:                               # substitutions, far enough apart
            body[3:3] = [("changed" if i % 9 == 4 else w.upper() + ",") for i, w in enumerate(item)]
        elif kind == 3:
            body[0:0] = item[:9]                      # less than a span
        elif kind == 4:
            body += ["(short"] + "item of six words here.".split()
        rows.append((d, " ".join(body)))
    return items, rows + [(70, None), (71, ""), (None, items[0][1]), (72, items[1][1]), (72, items[1][1]), (73, "pad " * 20_000 + items[2][1])]


def test_decontamination(spark, edge, no_docs):
    items, rows = leak_rows()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, regions string, seed int").repartition(3)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["contaminated"], tuple(r["item_ids"])) for r in D.contaminated(docs, bench).collect())
    # brute force on the passages' neighbourhood; the very long text holds item 2
    want = []
    for d, t in rows:
        hit = tuple(sorted(str(i) for i, x in items if x and shares_run(t if d != 73 else " ".join(t.split()[-60:]), x)))
        want.append((-1 if d is None else d, bool(hit), hit))
    assert got == sorted(want)
    assert sum(c for _, c, _ in got) > 30
    assert not any(r["contaminated"] for r in D.contaminated(edge, bench.limit(0)).collect())
    assert D.contaminated(no_docs, bench).count() == 0


def test_each_substitution_leaves_a_mask():
    assert all(any(p not in m for m in D.MASKS) for p in range(D.SPAN))
    h = np.arange(1, 14, dtype=np.uint64) * np.uint64(7919)
    for p in range(13):
        other = h.copy()
        other[p] += np.uint64(1)
        assert sum(int(a[1][0] == b[1][0]) for a, b in zip(D.spaced_seeds(h), D.spaced_seeds(other))) == 1


def test_every_verified_run_leaves_a_mask():
    """All places of the substitutions in all runs of 13 to 25 tokens, four fifths equal; a longer run holds one of them."""
    drops = [(span, [sum(1 << j for j in m) for m in masks]) for span, _, masks in D.COVER]
    for length in range(D.SPAN, 26):
        for places in itertools.combinations(range(length), length // 5):
            other = sum(1 << p for p in places)
            assert any(not (other >> i) & m for span, masks in drops for i in range(length - span + 1) for m in masks), (length, places)


def leaks(a, b):
    """A run of 13 tokens or more on one diagonal, four fifths of them equal; judged by equal tokens alone."""
    a, b = words(a), words(b)
    for shift in range(-len(b), len(a)):
        same = np.array([0 <= i + shift < len(a) and a[i + shift] == w for i, w in enumerate(b)], int)
        lo, hi = max(0, -shift), min(len(b), len(a) - shift)
        total = np.concatenate([[0], np.cumsum(same[lo:hi])])
        if any(5 * (total[j] - total[i]) >= 4 * (j - i) for i in range(len(total)) for j in range(i + D.SPAN, len(total))):
            return True
    return False


def test_leaks_with_random_substitutions(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(400))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((13, 13, 14, 15, 15, 16, 18, 20, 20, 25, 30))]
    rows = []
    for d in range(330):
        item = items[d % len(items)][1].split()
        for p in rng.sample(range(len(item)), len(item) // 5 + (d % 7 == 6)):
            item[p] = "changed"
        rows.append((d, " ".join([word() for _ in range(d % 30)] + item + [word() for _ in range(d % 13)])))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], i) for r in D.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), bench).collect()
           for i in r["item_ids"]}
    want = {(d, str(i)) for d, t in rows for i, x in items if leaks(t, x)}
    assert got == want and len(want) >= 280


def test_overlap_segments():
    rng = np.random.default_rng(6)
    for _ in range(200):
        b = rng.integers(0, 9, 24).astype(np.uint64)
        a = np.concatenate([rng.integers(0, 9, 4), np.where(rng.random(24) < 0.25, 99, b)]).astype(np.uint64)
        same = a[4:] == b
        best = max((int(np.where(same[i:j], 1, -4).sum()) for i in range(25) for j in range(i + 13, 25)))
        length, equal = D.overlap(a, b, 4)
        assert (length >= 13 and equal - 4 * (length - equal) == best) if best >= 0 else (length, equal) == (0, 0)
    assert D.overlap(a, a, 50) == (0, 0)


# ---------------------------------------------------------------- nearest neighbours

def truth(rows, every=100, k=10):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    top = max({len(v) for _, v in good}, key=lambda s: (sum(len(v) == s for _, v in good), -s))
    good = [(i, v) for i, v in good if len(v) == top]
    out = []
    for n, (i, v) in enumerate(good):
        if i % every == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for m, (j, w) in enumerate(good) if m != n)[:k]
            out.append((i, [j for _, j in near], [s for s, _ in near]))
    return out


def test_neighbours_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(1, 300)]
    same = rows[4][1]
    rows += [(1000 + i, same) for i in range(40)] + [(1100, same), (1200, same), (1200, same)]
    rows += [(1300, None), (1400, [0.0] * 8), (1500, [float("nan")] * 8), (1600, [None] + [1.0] * 7), (1700, [1.0]), (None, same),
             (1800, [float("inf")] * 8), (1900, [])]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id bigint, embedding array<float>, n int, cell string").repartition(4)
    got = {}
    for r in MI.neighbours(df, share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {}
    for i, ids, scores in truth(rows):
        want.setdefault(i, []).append((ids, scores))
    assert set(got) == set(want)
    for i, answers in want.items():
        assert len(got[i]) == 10 * len(answers)
        assert sorted((v, round(s, 9)) for _, v, s in got[i]) == sorted((v, round(s, 9)) for ids, scores in answers for v, s in zip(ids, scores))


def test_neighbours_few_and_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert MI.neighbours(spark.createDataFrame([], schema)).count() == 0
    assert MI.neighbours(spark.createDataFrame([(100, [1.0, 2.0])], schema)).count() == 0
    out = MI.neighbours(spark.createDataFrame([(100, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [4.0, 6.0])], schema)).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in out) == [(1, 1, 0.0), (2, 2, 5.0)]


def test_neighbours_recall(spark):
    """At the production share, on the table without any structure."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r[0], r[1]) for r in df.select("vec_id", "embedding").collect()]
    want = {i: set(ids) for i, ids, _ in truth(rows)}
    got = {}
    for r in MI.neighbours(df).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len(want[i] & got[i]) for i in want) >= 0.9 * sum(map(len, want.values()))


def test_walk_visits_in_order():
    rng = np.random.default_rng(0)
    d1, d2 = rng.random(5), rng.random(7)
    cells = MI.walk(d1, d2, np.ones(35, np.int64), 35)
    sums = [d1[c // 7] + d2[c % 7] for c in cells]
    assert len(set(cells)) == 35 and sums == sorted(sums)
    assert len(MI.walk(d1, d2, np.full(35, 4), 10)) == 3
