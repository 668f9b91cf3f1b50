"""Language-model scores: exact unigram counts and a hashed maximum-entropy model.

Counts of all training tokens are exact and stay a table; the most frequent words
(2^17 at most) are broadcast, the others are joined.  The model factors a token into
nested classes.  The frequent words are put into 64 classes by what stands before them
in the whole training text; the classes, the words of each class, and one more class
for all rare words are Huffman trees over counts, and the rare words are split further
by bits of their hash into up to 2^16 classes.  Each split is a softmax over its two
sides given the context, so every frequent word gets its whole probability from the
context, a rare one its class, and inside it its unigram share.  A split's logit is its
exact unigram log-odds plus one weight for each context feature: the previous word, the
two previous, the word two back, and the nearest earlier word of the text among the 256
most frequent ones, whatever it skips.  Weights are hashed by (feature, split) into a
vector, a quarter of it for each kind of feature, that grows with the training tokens
up to 2^23 entries; with zero weights the model is the unigram exactly.  They are
trained in rounds: every round takes another part of the training documents, each task
makes gradient updates (Adagrad) from the shared weights over its documents, and a
weight moves by the mean of the tasks' moves, weighted by the squared gradients each
task saw there.  Scores come from whole texts in numpy batches of the splits that occur.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import column, materialize, mix64, small_batches, word_hashes

END = np.uint64(0x5E4D0F7E4D0F7E4D)      # the hash of the end token
HEAD = 1 << 17                           # words that are broadcast
RARE_BITS = 16                           # at most so many bits of a rare word's hash name its class
RARE_WORDS = 4                           # rare words of a class, on average, below that bound
MIN_BITS, MAX_BITS = 16, 23              # size of the weight vector
FEATURES = 4
ANCHORS = 256                            # most frequent words, of which the nearest is a feature
CLASSES = 64                             # classes of the frequent words, by what stands before them
DIMS = 16                                # numbers of a word's profile
LEAST = 0.05                             # a split that errs by less is not moved
BLOCK = 1024                             # tokens of a gradient update
SCORED = 64                              # blocks that are scored together
MARK = np.int32(2**31 - 1)               # of a split on a way; the sign bit is its side
CHUNK = 4096                             # weights of a row that travels
TASK_TOKENS = 4_000_000                  # tokens a training task sees in a round


@dataclass
class Counts:
    """Totals of the training tokens, their most frequent words (sorted by hash) and the splits of the classes."""

    tokens: int                          # N
    distinct: int                        # V
    words: np.ndarray                    # uint64 hashes
    counts: np.ndarray
    rare: float                          # sum of (c + 0.5) of the other words and of the unknown one
    rare_bits: int                       # bits of the hash that name a rare word's class
    rare_mass: np.ndarray                # sum of (c + 0.5) by class of rare words
    split: np.ndarray                    # splits on the way to each leaf, one leaf after the other
    right: np.ndarray                    # which side the way takes there
    start: np.ndarray                    # where a leaf's way starts; leaves: words, all rare ones, classes of rare ones
    bias: np.ndarray                     # log-odds of the right side of each split
    anchor: np.ndarray                   # is a broadcast word one of the most frequent?
    first: np.ndarray                    # first word whose hash has at least these leading bits

    @property
    def total(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)


def stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of all texts, an end after each; offsets by text)."""
    h, off = word_hashes(texts)
    n = np.diff(off)
    out = np.full(len(h) + len(n), END, np.uint64)
    ends = np.cumsum(n + 1) - 1
    words = np.ones(len(out), bool)
    words[ends] = False
    out[words] = h
    return out, np.concatenate([[0], ends + 1])


def _token_counts(batches):
    held_h, held_c, size = [], [], 0

    def merged():
        h, at = np.unique(np.concatenate(held_h), return_inverse=True)
        return h, np.bincount(at, np.concatenate(held_c)).astype(np.int64)

    for b in small_batches(batches):
        h, c = np.unique(stream(column(b, "_text"))[0], return_counts=True)
        held_h.append(h)
        held_c.append(c)
        size += len(h)
        if size > 1 << 20:
            h, c = merged()
            if len(h) > 1 << 19:                          # bounded memory: hand on what is counted so far
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])
                held_h, held_c, size = [], [], 0
            else:
                held_h, held_c, size = [h], [c], len(h)
    if held_h:
        h, c = merged()
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])


def huffman(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(splits and sides on the ways to the leaves, starts of the ways, log-odds of the splits); at least one leaf."""
    n = len(mass)
    parent, side, bias = np.full(2 * n - 1, -1), np.zeros(2 * n - 1, bool), np.zeros(n - 1)
    heap = [(m, i) for i, m in enumerate(mass.tolist())]
    heapq.heapify(heap)
    for new in range(n, 2 * n - 1):
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        parent[i] = parent[j] = new
        side[j] = True
        bias[new - n] = math.log(b) - math.log(a)
        heapq.heappush(heap, (a + b, new))
    ways, at, steps = np.arange(n), np.arange(n), []
    while len(at):
        up = parent[at] >= 0
        ways, at = ways[up], at[up]
        steps.append((ways, parent[at] - n, side[at]))
        at = parent[at]
    leaf, split, right = (np.concatenate(x) for x in zip(*steps))
    order = leaf.argsort(kind="stable")
    return split[order], right[order], np.concatenate([[0], np.bincount(leaf, minlength=n).cumsum()]), bias


def group(profile: np.ndarray, mass: np.ndarray, k: int) -> np.ndarray:
    """Group of each word: the widest group is cut in two along its main direction, until there are ``k``.

    ``profile``: one row for each word, sums over its occurrences of what stands before it; ``mass``: their number.
    """
    x = profile / np.maximum(mass, 1)[:, None]
    out = np.zeros(len(x), np.int64)

    def cut(rows):
        """(spread that the cut removes, its right side)."""
        m, v = mass[rows], x[rows]
        mean = m @ v / max(m.sum(), 1e-9)
        v = v - mean
        along = v @ np.linalg.eigh((v * m[:, None]).T @ v)[1][:, -1]
        along *= 1 if along[m.argmax()] >= 0 else -1           # the direction's sign does not hang on the library
        side, spread = along > 0, 0.0
        for _ in range(8):
            left, right = m[~side].sum(), m[side].sum()
            if min(left, right) <= 0:
                return 0.0, side
            a, b = (m * along)[~side].sum() / left, (m * along)[side].sum() / right
            side, spread = along > (a + b) / 2, left * right / (left + right) * (b - a) ** 2
        return spread, side

    cuts = {0: cut(np.arange(len(x)))} if len(x) else {}
    for new in range(1, k):
        widest = max(cuts, key=lambda g: cuts[g][0], default=None)
        if widest is None or cuts[widest][0] <= 0:
            break
        rows = np.flatnonzero(out == widest)
        out[rows[cuts[widest][1]]] = new
        for g in (widest, new):
            cuts[g] = cut(np.flatnonzero(out == g))
    return out


def nested(mass: np.ndarray, of: np.ndarray, rare: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ways as of ``huffman`` to the words and, last, to all rare ones: first to a word's class ``of``, then to the word."""
    names, of = np.unique(of, return_inverse=True)
    s, r, at, bias = huffman(np.concatenate([np.bincount(of, mass, minlength=len(names)), [rare]]))
    n = len(mass)
    leaves = [(np.full(at[-1] - at[-2], n), s[at[-2]:], r[at[-2]:])]
    splits = len(bias)
    biases = [bias]
    for g in range(len(names)):
        members = np.flatnonzero(of == g)
        si, ri, ai, bi = huffman(mass[members])
        top = slice(at[g], at[g + 1])
        t = at[g + 1] - at[g]
        leaves.append((np.repeat(members, t), np.tile(s[top], len(members)), np.tile(r[top], len(members))))
        leaves.append((np.repeat(members, np.diff(ai)), si + splits, ri))
        biases.append(bi)
        splits += len(bi)
    leaf, split, right = (np.concatenate(x) for x in zip(*leaves))
    order = leaf.argsort(kind="stable")
    return split[order], right[order], np.concatenate([[0], np.bincount(leaf, minlength=n + 1).cumsum()]), np.concatenate(biases)


def halvings(mass: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same for 2^bits leaves that are split by the bits of their number."""
    leaf = np.arange(1 << bits)
    split = [(1 << d) - 1 + (leaf >> (bits - d)) for d in range(bits)]
    right = [(leaf >> (bits - 1 - d) & 1).astype(bool) for d in range(bits)]
    bias = []
    for d in range(bits):
        halves = mass.reshape(2 << d, -1).sum(1)
        bias.append(np.log(np.maximum(halves[1::2], 1e-9)) - np.log(np.maximum(halves[::2], 1e-9)))
    flat = lambda x, t: np.stack(x, 1).ravel() if bits else np.zeros(0, t)
    return flat(split, np.int64), flat(right, bool), np.arange(len(leaf) + 1) * bits, np.concatenate([*bias, np.zeros(0)])


def classes(h: np.ndarray, bits: int) -> np.ndarray:
    """Class of rare words: the first bits of their hash."""
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def build(tokens: int, distinct: int, h: np.ndarray, c: np.ndarray, bits: int, rare_mass: np.ndarray,
          of: np.ndarray | None = None) -> Counts:
    """Splits over the frequent words ``h`` (sorted) with counts ``c``, in classes ``of``, and the classes of the rare ones."""
    rare = (tokens - int(c.sum())) + 0.5 * (distinct - len(h) + 1)
    anchor = np.zeros(len(h), bool)
    anchor[np.argsort(-c, kind="stable")[:ANCHORS]] = True
    s1, r1, at1, b1 = nested(c + 0.5, np.zeros(len(c), np.int64) if of is None else of, rare)
    s2, r2, at2, b2 = halvings(rare_mass, bits)
    lead = len(h).bit_length() + 1
    first = np.searchsorted(h, np.arange(1 << lead, dtype=np.uint64) << np.uint64(64 - lead)).astype(np.int32)
    return Counts(tokens, distinct, h, c, rare, bits, rare_mass, np.concatenate([s1, s2 + len(b1)]).astype(np.int32),
                  np.concatenate([r1, r2]), np.concatenate([at1, at2[1:] + at1[-1]]).astype(np.int64),
                  np.concatenate([b1, b2]).astype(np.float32), anchor, first)


def summarise(table: DataFrame) -> Counts:
    """Totals, broadcast words and classes of the table of counts (h, c)."""
    t = table.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = table.orderBy(F.desc("c"), "h").limit(HEAD).toArrow()
    h = top["h"].to_numpy().view(np.uint64)
    c = top["c"].to_numpy().astype(np.int64)
    others = t["v"] - len(h)
    bits = int(np.clip(math.ceil(math.log2(max(1, others / RARE_WORDS))), 0, RARE_BITS))
    mass = np.zeros(1 << bits)
    if others:
        cls = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0)
        for r in table.groupBy(cls.alias("k")).agg((F.sum("c") + F.count("*") * F.lit(0.5)).alias("m")).collect():   # 2^16 rows at most
            mass[r["k"]] = r["m"]
        mass = np.maximum(mass - np.bincount(classes(h, bits), c + 0.5, minlength=1 << bits), 0)
    order = h.argsort()
    return build(int(t["n"] or 0), t["v"], h[order], c[order], bits, mass)


def classify(counts: Counts, texts: DataFrame) -> Counts:
    """The same counts with the broadcast words in classes, by profiles of all ``texts`` (_text)."""
    if not len(counts.words):
        return counts
    shared = texts.sparkSession.sparkContext.broadcast(counts)
    got = (texts.select("_text").mapInArrow(_profiler(shared), "chunk bigint, x array<double>")
           .repartition("chunk").mapInArrow(_adder, "chunk bigint, x array<double>").toArrow())              # 16 numbers a broadcast word
    shared.destroy()
    x = np.zeros((len(counts.words), DIMS))
    for i, v in zip(got["chunk"].to_pylist(), got["x"].to_numpy()):
        x[i * CHUNK:(i + 1) * CHUNK] = v.reshape(-1, DIMS)
    of = group(x, counts.counts.astype(np.float64), CLASSES)
    return build(counts.tokens, counts.distinct, counts.words, counts.counts, counts.rare_bits, counts.rare_mass, of)


def lookup(counts: Counts, h: np.ndarray) -> np.ndarray:
    """Place of each hash among the broadcast words, -1 for others."""
    words = counts.words
    if not len(words):
        return np.full(len(h), -1)
    at = counts.first.take((h >> np.uint64(65 - len(counts.first).bit_length())).astype(np.int64)).astype(np.int64)
    behind = np.flatnonzero(words.take(at, mode="clip") < h)
    while len(behind):                                             # as often as words share their leading bits
        at[behind] += 1
        behind = behind[(at[behind] < len(words)) & (words.take(at[behind], mode="clip") < h[behind])]
    return np.where(words.take(at, mode="clip") == h, at, -1)


def weight_bits(tokens: int) -> int:
    """Four weights for each training token, within bounds."""
    return int(np.clip(math.ceil(math.log2(max(1, 4 * tokens))), MIN_BITS, MAX_BITS))


def nearest_before(word: np.ndarray, anchor: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Place of the nearest earlier word of the text that is an anchor, -1 without one."""
    at = np.maximum.accumulate(np.where((word >= 0) & np.append(anchor, False)[word], np.arange(len(word)), -1))
    at = np.concatenate([[-1], at])[:len(word)]
    return np.where(at >= first, at, -1)


def profile(counts: Counts, h: np.ndarray, first: np.ndarray, sums: np.ndarray) -> None:
    """Add to each broadcast word's row a fixed random vector of the nearest anchor before each occurrence."""
    word = lookup(counts, h)
    near = nearest_before(word, counts.anchor, first)
    ok = (word >= 0) & (near >= 0)
    place = np.zeros(len(counts.words), np.int64)
    anchors = np.flatnonzero(counts.anchor)
    place[anchors] = np.arange(len(anchors))
    pair, n = np.unique(word[ok] * ANCHORS + place[word[near[ok]]], return_counts=True)
    signs = np.random.default_rng(5).choice(np.array([-1.0, 1.0], np.float32), (ANCHORS, DIMS))
    mark = signs[pair % ANCHORS] * n[:, None].astype(np.float32)
    for d in range(DIMS):
        sums[:, d] += np.bincount(pair // ANCHORS, mark[:, d], minlength=len(sums))


def wide(x: np.ndarray) -> np.ndarray:
    """Finite half floats as floats, by their bits (several times faster than a cast); others as they are."""
    if x.dtype != np.float16:
        return x
    bits = x.view(np.int16).astype(np.int32) << np.int32(13)
    bits &= np.int32(-0x70002000)                                  # the sign, 15 bits of exponent and fraction
    out = bits.view(np.float32)
    out *= np.float32(2.0**112)                                    # the exponents' bias
    return out


class MaxEnt:
    """The splits' logits for tokens in context; ``weights``: one for each hashed (feature, split)."""

    def __init__(self, counts: Counts, weights: np.ndarray) -> None:
        self.counts = counts
        self.w = weights
        self.shift = np.uint64(64 - int(math.log2(len(weights) // FEATURES)))
        mark = (mix64(np.arange(len(counts.bias), dtype=np.uint64)) >> self.shift).astype(np.int32)
        way = np.empty((len(counts.split), 2), np.int32)           # what the splits on the ways need, read at once
        for i in range(0, len(way), 1 << 18):                      # in parts, for the memory of a worker
            s = slice(i, i + (1 << 18))
            split = counts.split[s]
            way[s, 0] = mark[split] | counts.right[s] * ~MARK
            way[s, 1] = counts.bias[split].view(np.int32)
        self.way = way.view(np.int64).ravel()

    def features(self, h: np.ndarray, first: np.ndarray, word: np.ndarray) -> np.ndarray:
        """FEATURES x n hashed context features, each in its part of the weights; ``first``: place of each token's text start in ``h``."""
        at = np.arange(len(h))
        near = nearest_before(word, self.counts.anchor, first)

        def back(k):
            return np.where(at - k >= first, h[np.maximum(at - k, 0)], np.uint64(k))

        p, q = back(1), back(2)
        r = np.where(near >= 0, h[near], np.uint64(3))
        raw = (p * np.uint64(3), mix64(p * np.uint64(5) + mix64(q)), q * np.uint64(7) + np.uint64(11), r * np.uint64(13) + np.uint64(17))
        part = len(self.w) // FEATURES
        return np.stack([(mix64(x) >> self.shift).astype(np.int64) + i * part for i, x in enumerate(raw)])

    def blocks(self, h: np.ndarray, first: np.ndarray, size: int):
        """(first token, place among the broadcast words, features) of ``size`` tokens at a time."""
        at = lookup(self.counts, h)
        f = self.features(h, first, at)
        for lo in range(0, len(h), size):
            yield lo, at[lo:lo + size], f[:, lo:lo + size]

    def visits(self, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token, leaf) of the ways that tokens take: to the word or all rare ones, then to the class of a rare one."""
        n = len(self.counts.words)
        rare = np.flatnonzero(at < 0)
        return (np.concatenate([np.arange(len(at)), rare]),
                np.concatenate([np.where(at >= 0, at, n), n + 1 + classes(h[rare], self.counts.rare_bits)]))

    def ways(self, token: np.ndarray, leaf: np.ndarray, f: np.ndarray):
        """(splits on each visit's way, sign bit where the right side is taken, weights' places, log-odds) of the splits, way after way."""
        lo = self.counts.start.take(leaf)
        n = self.counts.start.take(leaf + 1) - lo
        at = np.repeat(lo - (n.cumsum() - n), n)
        at += np.arange(len(at))
        way = self.way.take(at).view(np.int32)
        places = np.repeat(f.take(token, axis=1), n, axis=1)
        places ^= (way[::2] & MARK).astype(np.int64)
        return n, way[::2] & ~MARK, places, way[1::2].view(np.float32)

    def score(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place among the broadcast words, natural log of the leaf, for a rare word also that of its class) of each token.

        Some blocks are scored together, one kind of feature after the other: its quarter of the weights stays in the cache.
        """
        word, out, inner = np.full(len(h), -1), np.zeros(len(h)), np.zeros(len(h))
        blocks = self.blocks(h, first, BLOCK)
        while some := list(islice(blocks, SCORED)):
            visits = [self.visits(at, h[lo:lo + BLOCK]) for lo, at, _ in some]
            ways = [self.ways(token, leaf, f) for (token, leaf), (_, _, f) in zip(visits, some)]
            logits = [wide(self.w.take(places[0])) for _, _, places, _ in ways]
            for i in range(1, FEATURES):
                for x, (_, _, places, _) in zip(logits, ways):
                    x += wide(self.w.take(places[i]))
            for (lo, at, _), (token, _), (n, side, _, bias), x in zip(some, visits, ways, logits):
                x += bias
                x.view(np.int32)[:] ^= side                        # the logit of the other side
                e = np.exp(np.clip(x, -60, 60, out=x), out=x).astype(np.float64)
                lp = -np.bincount(np.repeat(np.arange(len(n)), n), np.log(1 + e), minlength=len(n))
                word[lo:lo + len(at)] = at
                out[lo:lo + len(at)] = lp[:len(at)]
                inner[lo + token[len(at):]] = lp[len(at):]
        return word, out, inner

    def train(self, h: np.ndarray, first: np.ndarray, state: np.ndarray, rate: float) -> None:
        """Gradient updates over tokens, one per block; ``state``: sums of squared gradients."""
        for lo, at, f in self.blocks(h, first, BLOCK):
            _, side, places, bias = self.ways(*self.visits(at, h[lo:lo + BLOCK]), f)
            x = self.w[places[0]]
            for p in places[1:]:
                x += self.w[p]
            x += bias
            grad = 1 / (1 + np.exp(-np.clip(x, -60, 60))) - (side < 0)
            wrong = np.flatnonzero(np.abs(grad) > LEAST)
            grad = grad[wrong]
            square, step = grad * grad, np.float32(-rate) * grad
            for p in places.take(wrong, axis=1)[::-1]:             # each kind of feature has weights of its own; the last read are in the cache
                np.add.at(state, p, square)
                np.add.at(self.w, p, step / np.sqrt(state[p] + np.float32(1)))


def _starts(off: np.ndarray) -> np.ndarray:
    return np.repeat(off[:-1], np.diff(off))


def _profiler(counts):
    def run(batches):
        sums = np.zeros((len(counts.value.words), DIMS), order="F")
        for b in small_batches(batches, rows=256, bytes_=1 << 20):
            h, off = stream(column(b, "_text"))
            profile(counts.value, h, _starts(off), sums)
        for i in range(0, len(sums), CHUNK):
            x = sums[i:i + CHUNK]
            if x.any():
                yield pa.RecordBatch.from_arrays([pa.array([i // CHUNK]), pa.array([x.ravel()], pa.list_(pa.float64()))], ["chunk", "x"])
    return run


def _adder(batches):
    """Sums of the tasks' rows; a chunk's rows lie together."""
    sums = {}
    for b in batches:
        for i, x in zip(column(b, "chunk").to_pylist(), column(b, "x").to_numpy(zero_copy_only=False)):
            sums[i] = sums.get(i, 0) + np.asarray(x)
    for i, x in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([x], pa.list_(pa.float64()))], ["chunk", "x"])


def _trainer(counts, weights, rate: float):
    def run(batches):
        start = weights.value
        pairs = np.zeros((len(start), 2), np.float32)             # a weight and its squared gradients lie together
        pairs[:, 0] = start
        model, state, seen = MaxEnt(counts.value, pairs[:, 0]), pairs[:, 1], False
        for b in small_batches(batches, rows=256, bytes_=1 << 20):
            h, off = stream(column(b, "_text"))
            model.train(h, _starts(off), state, rate)
            seen = True
        if not seen:
            return
        for i in range(0, len(start), CHUNK):
            s = slice(i, i + CHUNK)
            if state[s].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // CHUNK]), *(pa.array([x.astype(np.float16).tobytes()]) for x in (np.sqrt(state[s]), model.w[s] - start[s]))],
                    ["chunk", "seen", "move"])
    return run


def _averager(batches):
    """Mean move of each weight, weighted by the squared gradients that the tasks saw there; a chunk's rows lie together."""
    sums, seen = {}, {}
    for b in batches:
        for i, *halves in zip(*(column(b, c).to_pylist() for c in ("chunk", "seen", "move"))):
            g, m = (np.frombuffer(x, np.float16).astype(np.float64) for x in halves)
            sums[i] = sums.get(i, 0) + m * g * g
            seen[i] = seen.get(i, 0) + g * g
    for i, x in sums.items():
        move = (x / np.maximum(seen[i], 1e-30)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([move], pa.list_(pa.float32()))], ["chunk", "move"])


def train(texts: DataFrame, counts, rounds: int, rate: float) -> np.ndarray:
    """Weights after ``rounds`` passes, each over another part of ``texts`` (_text, _part).

    Tasks grow with the tokens; each sends at most 32 MB, its moves and the squared gradients as half floats.
    """
    sc = texts.sparkSession.sparkContext
    weights = np.zeros(1 << weight_bits(counts.value.tokens), np.float32)
    tasks = math.ceil(counts.value.tokens / rounds / TASK_TOKENS) or 1
    for r in range(rounds):
        part = texts.where(F.col("_part") == r).select("_text").coalesce(tasks)
        shared = sc.broadcast(weights.astype(np.float16))
        rows = (part.mapInArrow(_trainer(counts, shared, rate), "chunk bigint, seen binary, move binary")
                .repartition("chunk").mapInArrow(_averager, "chunk bigint, move array<float>").toArrow())    # 2^23 weights at most
        weights = weights.copy()
        for i, m in zip(rows["chunk"].to_pylist(), rows["move"].to_numpy()):
            weights[i * CHUNK:(i + 1) * CHUNK] += m
        shared.destroy()
    return weights


def _scorer(counts, weights):
    def run(batches):
        c = counts.value
        model = MaxEnt(c, weights.value.copy())
        per = math.log10(c.total) if c.total else 0.0
        for b in small_batches(batches, rows=256, bytes_=1 << 20):
            h, off = stream(column(b, "_text"))
            at, lp, inner = model.score(h, _starts(off))
            known = at >= 0
            base = np.where(known, np.log10((c.counts[at] if len(c.counts) else 0) + 0.5), 0.0) - per
            sums = [np.add.reduceat(x, off[:-1]) if len(h) else x for x in (base, lp / math.log(10), known.astype(np.int64))]
            tails, times, ways = [], [], []
            for i in range(b.num_rows):
                rare = ~known[off[i]:off[i + 1]]
                t, inv, n = np.unique(h[off[i]:off[i + 1]][rare], return_inverse=True, return_counts=True)
                tails.append(t.view(np.int64))
                times.append(n)
                ways.append(np.bincount(inv, inner[off[i]:off[i + 1]][rare], minlength=len(t)) / math.log(10))
            yield pa.RecordBatch.from_arrays(
                [column(b, "n"), column(b, "id"), column(b, "held_out"), pa.array(np.diff(off)), pa.array(sums[2]), pa.array(sums[0]),
                 pa.array(sums[1]), pa.array(tails, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64())),
                 pa.array(ways, pa.list_(pa.float64()))],
                ["n", "id", "held_out", "n_tokens", "known", "base", "score", "tail", "times", "ways"])
    return run


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = 4,
                rate: float = 0.2) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased and one end per text
    (a null or empty text is one end).  Rows for which ``held_out`` is false are
    learned from, whole; rows with null in it count as held out.  base_score is the
    sum of log10((c + 0.5) / (N + 0.5 (V + 1))); score the model's log10 probability.
    Without training rows N and V are 0 and both scores give every token probability 1.
    Repeated rows are scored, and learned from, each by itself; other columns are ignored.
    A very long text is scored whole, in blocks of 1,024 tokens; a few numbers for each of its tokens are held at a time.
    Equal counts are ordered by hash, so ties among words do not hang on the partitions; the trained
    weights do, as each task trains on its own documents.
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.monotonically_increasing_id().alias("n"), F.col(id_col).alias("id"),
                       F.coalesce(held_out, F.lit(True)).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    id_type = rows.schema["id"].dataType.simpleString()
    learn = rows.where("NOT held_out")
    table = materialize(learn.select("_text").mapInArrow(_token_counts, "h bigint, c bigint")
                        .groupBy("h").agg(F.sum("c").alias("c")), "lm-counts")
    summary = classify(summarise(table), learn)
    counts = sc.broadcast(summary)
    parts = learn.select("_text", F.pmod(F.xxhash64("id", "_text", F.lit(3)), F.lit(rounds)).alias("_part"))
    weights = sc.broadcast(train(parts, counts, rounds, rate).astype(np.float16))
    scored = materialize(rows.mapInArrow(_scorer(counts, weights), f"n bigint, id {id_type}, held_out boolean, n_tokens bigint, known bigint, "
                                         "base double, score double, tail array<bigint>, times array<bigint>, ways array<double>"), "lm-scored")
    rare = F.coalesce("mass", F.lit(1.0))
    share = F.when(F.col("c").isNull(), F.lit(_log10(0.5) - _log10(summary.rare)) * F.col("times")).otherwise(
        F.col("ways") + F.col("times") * (F.log10(F.col("c") + 0.5) - F.log10(rare) + F.lit(_log10(summary.rare - 0.5) - _log10(summary.rare))))
    bits = summary.rare_bits
    cls = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("bigint")
    masses = docs.sparkSession.createDataFrame(
        pa.table({"k": pa.array(np.arange(1 << bits)), "mass": pa.array(summary.rare_mass)}))          # 2^16 rows at most
    words = table.join(F.broadcast(masses), cls == F.col("k"), "left").select("h", "c", "mass")
    tail = (scored.select("n", F.explode(F.arrays_zip("tail", "times", "ways")).alias("t"))
            .select("n", F.col("t.tail").alias("h"), "t.times", "t.ways")
            .join(words, "h", "left").groupBy("n").agg(
                F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_log"), F.sum(share).alias("tail_score"),
                F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known")))
    out = scored.drop("tail", "times", "ways").join(tail, "n", "left")
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(summary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_log", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"))


def _log10(x: float) -> float:
    return math.log10(x) if x > 0 else 0.0
