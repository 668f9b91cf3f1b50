"""Tokenizer alignment against a direct version that encodes every whole text."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SCHEMA

from tabforge.llm import lockstep_align as L

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = ["", " ", "  ", "\n", "a", "a  b ", " x", "tab\there\n\nand  there ", "a▁b", "nul\x00 byte", "<s> <0x41> </s> <|endoftext|> <unk>",
       "été est là ", "“quoted” text", "中文字符 没有 空格", "wide　space nb line", "😀😀 🏳️‍🌈 x", "ﬁ① İstanbul", "don't we'll it's",
       "1234567 12,5 %%% ### ...", "trailing \n", "a" * 3000, " " * 700, "word\x85next x\x1cy", "‑ – — ​ z"]


def tokens(text):
    a, b = L.ByteSide(A), L.PieceSide(B)
    if not text:
        return [], []
    ids_a = a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.model.encode(text)
    whole = (" " + text).encode()
    if b"".join(a.names[i] for i in ids_a) != whole or b"".join(b.names[i] for i in ids_b) != whole:
        return [], []
    return [(i, a.names[i]) for i in ids_a], [(i, b.names[i]) for i in ids_b]


def direct(texts):
    """Rows as ``align`` gives them, one text at a time."""
    import functools
    L.ByteSide, L.PieceSide = functools.cache(L.ByteSide), functools.cache(L.PieceSide)
    docs, count = [], Counter()
    for t in texts:
        ta, tb = tokens(t)
        ends_a, ends_b = np.cumsum([len(x) for _, x in ta]), np.cumsum([len(x) for _, x in tb])
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, lo = [], 0
        for c in cuts:
            groups.append(([i for (i, _), e in zip(ta, ends_a) if lo < e <= c], [i for (i, _), e in zip(tb, ends_b) if lo < e <= c]))
            lo = c
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        count.update(set(links))
        docs.append((len(ta), len(tb), groups, links))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(count[x] == top[x[0]] for x in links), sum(count[x] for x in links), text))
    return out


def rows_of(frame):
    return sorted((tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")) for r in frame.collect()))


def test_equals_direct_on_odd_texts(spark, edge):
    texts = [r["text"] if len(r["text"] or "") < 20_000 else r["text"][:20_000] for r in edge.collect()] + ODD + ODD[5:9]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) + ("",) * 2 + (1, 2) + ("",) * 4 for i, t in enumerate(texts)], SCHEMA).repartition(3)
    assert rows_of(L.align(docs, A, B)) == sorted(direct(texts))


def test_small_blocks_runs_and_lanes_change_nothing(spark, monkeypatch):
    texts = [t * 3 for t in ODD] + ["some shared words here and there"] * 5
    want = direct(texts)
    monkeypatch.setattr(L, "RUN_UNITS", 7)
    monkeypatch.setattr(L, "LANE_UNITS", 2)
    monkeypatch.setattr(L, "WIDE", 2)
    monkeypatch.setattr(L, "SHORT", 50)
    docs = L.Aligner(A, B)([t.encode() for t in texts], keep_text=True)
    for d, w in zip(docs, want):
        assert (d.n_a, d.n_b, d.n_groups, d.n_links) == w[:4]
        assert b"".join(d.text).decode() == w[6] and d.sha.hexdigest() == hashlib.sha256(w[6].encode()).hexdigest()
        assert int(d.distinct()[1].sum()) == w[3]


def test_query_digest_and_empty_table(spark, no_docs, monkeypatch, tmp_path):
    assert L.align(no_docs, A, B, digest=True).count() == 0
    texts = ["one two three", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in L.align(docs, A, B, digest=True).collect()}
    assert got[0]["groups"] == hashlib.sha256(direct(texts)[0][6].encode()).hexdigest()
    assert got[1]["groups"] == got[2]["groups"] == "" and got[1]["n_links"] == 0


def test_steps_are_bounded_by_the_longest_lane():
    la, lb = np.array([1, 2, 3, 6]), np.array([3, 1, 2, 6])
    a, b = L.lockstep(la, lb, np.array([0, 3, 4]), np.array([0, 3, 4]))
    assert a.tolist() == [2, 3, 4] and b.tolist() == [1, 3, 4]


@pytest.mark.parametrize("bad", ["é", "a\x85", "a ", "”"])
def test_units_are_not_cut_behind_doubtful_characters(bad):
    raw = np.frombuffer((" " + bad + " x").encode(), np.uint8)
    assert len(L.unit_starts(raw, np.array([0]))) == (2 if bad == "é" else 1)
