"""Toxicity by the nearest labelled texts: exact TF-IDF cosine over a block-max inverted index.

Words whose labelled texts mostly have label 1, more often than chance allows (likelihood
ratio, corrected for the number of words tested), are the terms; their document frequencies are counted over
all documents.  Labelled texts with such a term are the examples.  Postings are cut into
blocks of examples; a query adds up the blocks' greatest weights to bounds, visits blocks
in the order of their bounds and stops when no bound reaches the k-th cosine found, so the
result is that of a full scan.  The neighbours' votes, weighted by nearness, are
calibrated on the examples themselves, each without its own vote.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import ascii_words, bits_of, column, materialize, small_batches

EXAMPLES = 8192        # labelled texts in the index at most (those of the least hash)
MAX_TERMS = 1 << 15    # terms at most (those of the greatest likelihood ratio)
LEVEL = 0.05           # chance that any word of no use becomes a term
SHARE = 0.5            # texts of label 1 among a term's labelled texts at least
K = 15                 # neighbours that vote
BLOCK = 64             # examples of a block
PRIOR = 0.25           # weight of the base rate beside the neighbours' votes
_EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text, term, occurrences; sorted by text and term) and the distinct terms of a batch.

    Terms are words between ASCII white space, lower-cased, without marks at their ends.
    """
    codes, words, offsets = ascii_words(texts, lower=False)
    if not len(codes):
        return (*(np.empty(0, np.int64) for _ in range(3)), pa.array([], pa.large_string()))
    coded = pc.replace_substring_regex(pc.utf8_lower(words), _EDGES, "").dictionary_encode()
    term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    size = len(coded.dictionary)
    key, times = np.unique(text * size + term, return_counts=True)
    empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    keep = ~empty[key % size]
    return key[keep] // size, key[keep] % size, times[keep], coded.dictionary


def likelihood_ratio(n1: np.ndarray, n0: np.ndarray, all1: int, all0: int) -> np.ndarray:
    """G statistic of a word against the label; n1, n0: texts of either label that hold it."""
    def part(seen, expected):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(seen > 0, seen * np.log(seen / expected), 0.0)
    n1, n0 = n1.astype(float), n0.astype(float)
    with_, share = n1 + n0, all1 / (all1 + all0)
    without = all1 + all0 - with_
    return 2 * (part(n1, with_ * share) + part(n0, with_ * (1 - share))
                + part(all1 - n1, without * share) + part(all0 - n0, without * (1 - share)))


def needed_ratio(tested: int) -> float:
    """G that one of ``tested`` words of no use passes with chance LEVEL (chi-square, one degree)."""
    return NormalDist().inv_cdf(1 - LEVEL / (2 * max(1, tested))) ** 2


class BlockMaxIndex:
    """Inverted index over unit vectors with the greatest weight of each term in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK) -> None:
        self.size, self.block = len(vectors), block
        blocks = max(1, -(-self.size // block))
        n = np.array([len(t) for t, _ in vectors], np.int64)
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.empty(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.empty(0)
        owner = np.repeat(np.arange(self.size), n)
        order = np.lexsort((owner, term))
        self.owner, self.weight = owner[order], weight[order]
        cell = term[order] * blocks + self.owner // block
        self.start = np.searchsorted(cell, np.arange(n_terms * blocks + 1)).reshape(-1)
        self.most = np.zeros(n_terms * blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most, self.blocks = self.most.reshape(n_terms, blocks), blocks

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """(examples, cosines; nearest first, ties to the smaller number; cosines above 0 only) and blocks visited."""
        bound = weights @ self.most[terms]
        who, cos, visited, least = np.empty(0, np.int64), np.empty(0), 0, 0.0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(who) >= k and bound[b] < least - 1e-9):
                break
            visited += 1
            score = np.zeros(self.block)
            for t, w in zip(terms, weights):
                lo, hi = self.start[t * self.blocks + b], self.start[t * self.blocks + b + 1]
                score[self.owner[lo:hi] - b * self.block] += w * self.weight[lo:hi]
            at = np.flatnonzero(score)
            who, cos = np.append(who, at + b * self.block), np.append(cos, score[at])
            if skip >= 0:
                cos, who = cos[who != skip], who[who != skip]
            best = np.lexsort((who, -cos))[:k]
            who, cos = who[best], cos[best]
            least = cos[-1] if len(cos) else 0.0
        return who, cos, visited


@dataclass
class Model:
    """Terms with weights, labelled examples, base rate and calibration.  Its size is bounded by EXAMPLES and MAX_TERMS."""

    terms: list[str]
    idf: np.ndarray
    ids: list = field(default_factory=list)
    labels: np.ndarray = field(default_factory=lambda: np.empty(0))
    index: BlockMaxIndex | None = None
    base: float = 0.0            # chance of label 1 of a text without a term
    rate: float = 0.5            # share of label 1
    slope: float = 1.0
    offset: float = 0.0

    def vectors(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Unit TF-IDF vector (terms, weights) of each whole text; empty without a term."""
        text, term, times, names = term_counts(texts)
        place = pc.index_in(names, pa.array(self.terms, names.type))
        place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = place[term] if len(term) else term
        keep = at >= 0
        text, at, times = text[keep], at[keep], times[keep]
        order = np.lexsort((at, text))
        text, at, times = text[order], at[order], times[order]
        weight = (1 + np.log(times)) * self.idf[at] if len(at) else np.empty(0)
        edge = np.searchsorted(text, np.arange(len(texts) + 1))
        return [(at[i:j], weight[i:j] / np.sqrt(np.square(weight[i:j]).sum()) if j > i else weight[i:j])
                for i, j in zip(edge[:-1], edge[1:])]

    def votes(self, vector: tuple[np.ndarray, np.ndarray], k: int = K, skip: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """(share of label 1 among the neighbours' votes, neighbours, cosines); a vote weighs its squared cosine."""
        who, cos, _ = self.index.nearest(*vector, k, skip)
        weight = np.square(cos)
        return float((weight @ self.labels[who] + PRIOR * self.rate) / (weight.sum() + PRIOR)), who, cos

    def score(self, share: float) -> float:
        """Calibrated chance of label 1."""
        return float(1 / (1 + math.exp(-np.clip(self.slope * _logit(share) + self.offset, -30, 30))))


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibrate(share: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope (0 at least) and offset of a logistic curve through (share, label), with smoothed targets."""
    if not len(share) or label.min() == label.max() and len(share) < 2:
        return 1.0, 0.0
    x, n1 = _logit(share), label.sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (len(label) - n1 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((p - target) * x).sum() + 1e-3 * (a - 1), (p - target).sum() + 1e-3 * b])
        hess = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(a)), float(b)


def _maybe_labelled(bits):
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(bits.value.has(column(b, "_b").to_numpy().view(np.uint64)))).select(["_id", "_text"])
    return run


def _label_counts(batches):
    """Per block of texts: term, texts of label 1 and of label 0 that hold it; term null: all texts."""
    for b in small_batches(batches, rows=4096, bytes_=8 << 20):
        y = column(b, "_y").to_numpy(zero_copy_only=False).astype(bool)
        text, term, _, names = term_counts(column(b, "_text"))
        n1 = np.bincount(term[y[text]], minlength=len(names)) if len(term) else np.empty(0, np.int64)
        n0 = np.bincount(term[~y[text]], minlength=len(names)) if len(term) else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names.to_pylist() + [None], pa.string()), pa.array(np.append(n1, y.sum()).astype(np.int64)),
             pa.array(np.append(n0, (~y).sum()).astype(np.int64))], ["term", "n1", "n0"])


def _frequencies(terms):
    """Texts that hold each term, and all texts (term -1), of a task."""
    def run(batches):
        model = Model(terms.value, np.ones(len(terms.value)))
        df, n = np.zeros(len(terms.value), np.int64), 0
        for b in small_batches(batches, rows=4096, bytes_=8 << 20):
            n += b.num_rows
            for t, _ in model.vectors(column(b, "_text")):
                df[t] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["i", "df"])
    return run


def _example_vectors(model):
    def run(batches):
        for b in small_batches(batches, rows=4096, bytes_=8 << 20):
            v = model.value.vectors(column(b, "_text"))
            yield pa.RecordBatch.from_arrays(
                [column(b, "_h"), column(b, "_id"), column(b, "_y"), pa.array([t for t, _ in v], pa.list_(pa.int64())),
                 pa.array([w for _, w in v], pa.list_(pa.float64()))], ["_h", "_id", "_y", "terms", "weights"])
    return run


def _left_out_votes(model):
    """Vote share of each example without itself."""
    def run(batches):
        m = model.value
        for b in batches:
            rows = [(m.votes((np.array(t), np.array(w)), skip=i)[0], y) for i, t, w, y in
                    zip(*(column(b, c).to_pylist() for c in ("i", "terms", "weights", "_y")))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([float(r[1]) for r in rows])], ["share", "y"])
    return run


def train(learn: DataFrame, labels: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          examples: int = EXAMPLES) -> Model:
    """Fit on the rows of ``learn`` that ``labels`` marks 0 or 1; ``docs`` gives the terms' document frequencies.

    All labelled texts choose the terms; a text that occurs several times counts once,
    with the label that most of its rows have (1 in a tie).  An id with several labels
    counts as 1 if any is.  ``examples`` bounds the texts in the index (least hash
    first).  Null texts and labels teach nothing.  Without labels, or without a word
    that tells them apart, the model gives every text the base rate.
    """
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    marks = labels.select(F.col(id_col).alias("_lid"), F.col(label_col).cast("int").alias("_y")).where("_y IN (0, 1)").groupBy("_lid").agg(F.max("_y").alias("_y"))
    marks = materialize(marks.where("_lid IS NOT NULL").withColumn("_b", F.xxhash64(F.col("_lid").cast("string"))), "tx-marks")
    # only texts whose id may be labelled are shuffled: a bit table of 16 MB at most leaves the others out
    wanted = sc.broadcast(bits_of(marks, "_b", marks.count()))
    src = learn.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(F.col(id_col).cast("string")).alias("_b"))
    kind = src.schema["_id"].dataType.simpleString()
    rows = (src.where("_text IS NOT NULL").mapInArrow(_maybe_labelled(wanted), f"_id {kind}, _text string")
            .join(marks.select("_lid", "_y").hint("merge"), F.col("_id") == F.col("_lid")))
    texts = materialize(rows.groupBy(F.xxhash64("_text").alias("_h"), F.length("_text").alias("_n")).agg(
        F.min("_id").alias("_id"), F.first("_text").alias("_text"), F.expr("cast(avg(_y) >= 0.5 AS int)").alias("_y")), "tx-texts")
    counts = materialize(texts.select("_text", "_y").mapInArrow(_label_counts, "term string, n1 bigint, n0 bigint")
                         .groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "tx-terms")
    total = counts.where("term IS NULL").first()
    all1, all0 = (total["n1"], total["n0"]) if total else (0, 0)
    if not all1 or not all0:
        rate = all1 / (all1 + all0) if all1 + all0 else 0.0
        return Model([], np.empty(0), base=rate, rate=rate)
    tested = counts.where("term IS NOT NULL AND n1 + n0 >= 2")
    ratio = _ratio_column(all1, all0)
    chosen = (tested.where((F.col("n1") * all0 > F.col("n0") * all1) & (F.col("n1") >= SHARE * (F.col("n1") + F.col("n0")))).withColumn("g", ratio)
              .where(F.col("g") >= needed_ratio(tested.count())).orderBy(F.col("g").desc(), "term").limit(MAX_TERMS).select("term").collect())
    terms = sorted(r["term"] for r in chosen)
    rate = all1 / (all1 + all0)
    if not terms:
        return Model([], np.empty(0), base=rate, rate=rate)
    known = sc.broadcast(terms)
    seen = {r["i"]: r["df"] for r in docs.select(F.col(text_col).alias("_text")).mapInArrow(_frequencies(known), "i bigint, df bigint")
            .groupBy("i").agg(F.sum("df").alias("df")).collect()}          # one row for each term
    df = np.array([seen.get(i, 0) for i in range(len(terms))], float)
    model = Model(terms, np.log1p(seen.get(-1, 0) / np.maximum(df, 1)), rate=rate)
    id_type = texts.schema["_id"].dataType.simpleString()
    vectors = materialize(texts.select("_h", "_id", "_text", "_y").mapInArrow(
        _example_vectors(sc.broadcast(model)), f"_h bigint, _id {id_type}, _y int, terms array<bigint>, weights array<double>"), "tx-vectors")
    blank = vectors.where("size(terms) = 0").agg(F.count("*").alias("n"), F.coalesce(F.sum("_y"), F.lit(0)).alias("n1")).first()
    model.base = (blank["n1"] + rate) / (blank["n"] + 1)
    held = vectors.where("size(terms) > 0").orderBy("_h", "_id").limit(examples).collect()
    # examples of one leading term side by side, so that blocks differ in their greatest weights
    held.sort(key=lambda r: (r["terms"][int(np.argmax(r["weights"]))], r["_h"]))
    model.ids, model.labels = [r["_id"] for r in held], np.array([r["_y"] for r in held], float)
    model.index = BlockMaxIndex([(np.array(r["terms"], np.int64), np.array(r["weights"])) for r in held], len(terms))
    own = spark.createDataFrame([(i, r["terms"], r["weights"], r["_y"]) for i, r in enumerate(held)],
                                "i bigint, terms array<bigint>, weights array<double>, _y int")
    got = own.mapInArrow(_left_out_votes(sc.broadcast(model)), "share double, y double").collect()     # ``examples`` pairs at most
    model.slope, model.offset = calibrate(np.array([r["share"] for r in got]), np.array([r["y"] for r in got]))
    return model


def _ratio_column(all1: int, all0: int):
    n1, n0 = F.col("n1"), F.col("n0")
    share, rest = all1 / (all1 + all0), F.lit(all1 + all0) - n1 - n0

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    return 2 * (part(n1, (n1 + n0) * share) + part(n0, (n1 + n0) * (1 - share))
                + part(F.lit(all1) - n1, rest * share) + part(F.lit(all0) - n0, rest * (1 - share)))


_EVIDENCE = "array<struct<id:string,label:int,cosine:double>>"


def _score(model, shown: int):
    def run(batches):
        m, held = model.value, {}
        for b in small_batches(batches, rows=4096, bytes_=8 << 20):
            scores, near, words = [], [], []
            for t, w in (m.vectors(column(b, "_text")) if m.index is not None else [((), ())] * b.num_rows):
                if not len(t):
                    scores.append(m.base)
                    near.append([])
                    words.append([])
                    continue
                key = (t.tobytes(), w.tobytes())
                if key not in held:
                    if len(held) > 20_000:
                        held.clear()
                    share, who, cos = m.votes((t, w))
                    held[key] = (m.score(share), [{"id": None if m.ids[i] is None else str(m.ids[i]), "label": int(m.labels[i]), "cosine": float(c)}
                                                  for i, c in zip(who[:shown], cos[:shown])], [m.terms[i] for i in t])
                s, n, x = held[key]
                scores.append(s)
                near.append(n)
                words.append(x)
            kind = pa.list_(pa.struct([("id", pa.string()), ("label", pa.int32()), ("cosine", pa.float64())]))
            yield pa.RecordBatch.from_arrays([column(b, "row"), pa.array(scores, pa.float64()), pa.array(near, kind),
                                              pa.array(words, pa.list_(pa.string()))], ["row", "score", "nearest", "terms"])
    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, shown: int = 3) -> DataFrame:
    """row (the columns ``keep`` of each input row), score, nearest (labelled texts), terms (of the text).

    score: calibrated chance of label 1, 0 to 1; texts without a term of the model (null and
    empty ones too) get the base rate of such texts.  Whole texts are read, however
    long; scripts without spaces are matched by whole runs only.  Equal texts get equal
    scores; an empty table gives an empty result.
    """
    names = keep if keep is not None else [c for c in docs.columns if c != text_col]
    src = docs.select(F.struct(*names).alias("row"), F.col(text_col).alias("_text"))
    kind = src.schema["row"].dataType.simpleString()
    return src.mapInArrow(_score(src.sparkSession.sparkContext.broadcast(model), shown),
                          f"row {kind}, score double, nearest {_EVIDENCE}, terms array<string>")
