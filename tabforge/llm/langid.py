"""Language identification: logistic regression on TF-IDF character n-grams.

Document frequencies are counted over every training text.  The classifier is a
sparse multinomial logistic regression over hashed n-grams of one to three
letters, fitted by follow-the-regularised-leader with elastic-net penalties on a
bounded sample of labelled texts (``per_language`` texts of each language, drawn
by hash), four fifths of it for the weights and one fifth for the temperature
that calibrates the probabilities.  Scoring reads whole texts in numpy batches.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import column, small_batches

BITS = 16
ORDERS = 3
MAX_LANGUAGES = 500  # bounds the model: 2^16 weights of four bytes each
SCALE = 50.0         # makes the mean TF-IDF weight of order one
SIZE_ERROR = 0.02    # standard error of the estimated number of texts of a language
_SPACE = 32


def _letters() -> np.ndarray:
    """Which code points below 2^16 are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


class Grams:
    """Hashed character n-grams of texts: everything but letters is one space, letters are lower-cased."""

    def __init__(self) -> None:
        self.table = _letters()

    def codes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code points with runs of non-letters as one space, text of each, whether a text has a letter)."""
        low = [f" {t.lower()} " if t else " " for t in texts]
        c = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.repeat(np.arange(len(low)), [len(x) for x in low])
        letter = self.table[np.minimum(c, 0xFFFF)]
        high = c > 0xFFFF
        if high.any():
            points, at = np.unique(c[high], return_inverse=True)
            letter[high] = np.array([chr(p).isalpha() for p in points])[at]
        has = np.bincount(doc[letter], minlength=len(low)) > 0
        c = np.where(letter, c, np.uint32(_SPACE))
        keep = letter.copy()
        keep[0] = True
        keep[1:] |= letter[:-1] | (doc[1:] != doc[:-1])
        return c[keep], doc[keep], has

    def __call__(self, texts: list[str | None]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
        """Per order (feature, text) in text order; n-grams in each text; whether a text has a letter."""
        c, doc, has = self.codes(texts)
        out, h = [], np.zeros(len(c), np.uint32)
        for n in range(1, ORDERS + 1):
            end = len(c) - n + 1
            if end <= 0:
                break
            h = (h[:end] + c[n - 1:n - 1 + end] + np.uint32(n)) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            f = ((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)).astype(np.int32)
            same = doc[:end] == doc[n - 1:]
            out.append((f[same], doc[:end][same]))
        total = np.zeros(len(texts), np.int64)
        for _, d in out:
            total += np.bincount(d, minlength=len(texts))
        return out, total, has


def _counts(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(f, return_counts=True)


def _text_batches(batches, text=lambda b: column(b, "_text")):
    """Lists of whole texts of about a million characters (one text at least); ``text``: their column of a batch."""
    for b in small_batches(batches, rows=256, bytes_=1 << 20):
        yield b, text(b).to_pylist()


def _document_frequencies(batches):
    grams, df = Grams(), np.zeros(1 << BITS, np.int64)
    n = 0
    for _, texts in _text_batches(batches):
        orders, _, has = grams(texts)
        n += int(has.sum())
        for lo in range(0, len(texts), 64):
            mark = np.zeros(64 << BITS, bool)
            for f, d in orders:
                i, j = np.searchsorted(d, [lo, lo + 64])
                mark[((d[i:j] - lo) << BITS) + f[i:j]] = True
            df += mark.reshape(64, -1).sum(0)
    full = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(full, -1)), pa.array(np.append(df[full], n))], ["f", "df"])


def _sample_features(batches):
    grams = Grams()
    for b, texts in _text_batches(batches):
        orders, total, has = grams(texts)
        fs, ns = [], []
        for i in range(len(texts)):
            f, n = _counts(np.concatenate([x[np.searchsorted(d, i):np.searchsorted(d, i + 1)] for x, d in orders]))
            fs.append(f)
            ns.append(n / max(1, total[i]))
        out = pa.RecordBatch.from_arrays([column(b, "_lang"), column(b, "_key"), pa.array(fs, pa.list_(pa.int32())),
                                          pa.array(ns, pa.list_(pa.float64()))], ["lang", "key", "f", "tf"])
        yield out.filter(pa.array(has))


class Ftrl:
    """Follow-the-regularised-leader (proximal) for multinomial logistic regression, by mini-batches."""

    def __init__(self, classes: int, features: int, alpha: float, beta: float, l1: float, l2: float) -> None:
        self.z, self.n = np.zeros((classes, features)), np.zeros((classes, features))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, f: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[:, f], self.n[:, f]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def update(self, f: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        w = self.weights(f)
        g = (softmax(x @ w.T) - y).T @ x
        n = self.n[:, f]
        self.z[:, f] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[:, f] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature in [0.05, 20] of least negative log likelihood (golden section on its logarithm)."""
    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(y)), y]
        return float(-np.log(np.maximum(p, 1e-300)).mean())
    a, b = np.log(0.05), np.log(20.0)
    r = (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _fitter(idf: np.ndarray, epochs: int, alpha: float, beta: float, l1: float, l2: float):
    def run(batches):
        rows = [x for b in batches for x in zip(column(b, "key").to_pylist(), column(b, "lang").to_pylist(),
                                                column(b, "f").to_numpy(zero_copy_only=False),
                                                column(b, "tf").to_numpy(zero_copy_only=False))]
        if not rows:
            return
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))           # the order does not hang on the partitions
        langs = sorted({r[1] for r in rows})
        bias = 1 << BITS
        data = [(np.append(f, bias), np.append(tf * idf[f] * SCALE, 1.0), langs.index(lang), key) for key, lang, f, tf in rows]
        hold = [r for r in data if r[3] % 5 == 0]
        fit = [r for r in data if r[3] % 5] or data
        model, order = Ftrl(len(langs), bias + 1, alpha, beta, l1, l2), np.arange(len(fit))
        rng = np.random.default_rng(5)
        for _ in range(epochs):
            rng.shuffle(order)
            for lo in range(0, len(order), 16):
                part = [fit[i] for i in order[lo:lo + 16]]
                f, at = np.unique(np.concatenate([r[0] for r in part]), return_inverse=True)
                x, y = np.zeros((len(part), len(f))), np.zeros((len(part), len(langs)))
                x[np.repeat(np.arange(len(part)), [len(r[0]) for r in part]), at] = np.concatenate([r[1] for r in part])
                y[np.arange(len(part)), [r[2] for r in part]] = 1
                model.update(f, x, y)
        w = model.weights()
        t = 1.0
        if hold and len(langs) > 1:
            logits = np.stack([w[:, r[0]] @ r[1] for r in hold])
            t = best_temperature(logits, np.array([r[2] for r in hold]))
        buffer = io.BytesIO()
        np.savez(buffer, w=(w[:, :bias] * idf * SCALE / t).astype(np.float32), b=w[:, bias] / t)
        yield pa.RecordBatch.from_arrays([pa.array([langs], pa.list_(pa.string())), pa.array([t]),
                                          pa.array([buffer.getvalue()], pa.binary())], ["langs", "temperature", "weights"])
    return run


@dataclass
class LanguageModel:
    """Calibrated weights: 2^16 n-gram features by language (a few MB at most for hundreds of languages)."""

    langs: list[str]
    temperature: float
    weights: np.ndarray
    bias: np.ndarray


def sample(rows: DataFrame, per_language: int) -> DataFrame:
    """(_text, _lang, _key): about ``per_language`` different texts of each language of (_text, _lang), all where there are fewer.

    Copies of a text are drawn or left together, and texts without a letter teach nothing, so
    the rate comes from the different texts with a letter; their number is estimated, and taken
    three standard errors low, so that a language of fewer texts keeps them all.
    """
    key = F.shiftrightunsigned(F.xxhash64("_text"), 2)
    sizes = (rows.where(F.col("_text").rlike("\\p{L}")).groupBy("_lang").agg(F.approx_count_distinct(key, SIZE_ERROR).alias("c"))
             .limit(MAX_LANGUAGES + 1).collect())
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the column is no language label")
    part = F.lit(None).cast("double")               # the part of a language that is drawn; no text moves for it
    for r in sizes:
        part = F.when(F.col("_lang") == r["_lang"], min(1.0, per_language / max(1.0, r["c"] * (1 - 3 * SIZE_ERROR)))).otherwise(part)
    return (rows.withColumn("_key", key).where(F.col("_key") / F.lit(float(1 << 62)) < part)
            .dropDuplicates(["_key", "_lang"]))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 1500,
          epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-4) -> LanguageModel:
    """Fit on rows with a text and a language; rows with a null in either, or without a letter, teach nothing.

    About ``per_language`` texts of each language, whole, are fitted (all of them
    where there are fewer); document frequencies come from every row.  No usable
    row gives a model without languages; more than ``MAX_LANGUAGES`` are refused.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(text_col).alias("_text"), F.col(lang_col).cast("string").alias("_lang")).where(
        "_text IS NOT NULL AND _lang IS NOT NULL")
    df = {r["f"]: r["df"] for r in rows.select("_text").mapInArrow(_document_frequencies, "f bigint, df bigint")
          .groupBy("f").agg(F.sum("df").alias("df")).collect()}      # at most 2^16 rows and a total
    n = df.pop(-1, 0)
    counts = np.zeros(1 << BITS)
    counts[list(df)] = list(df.values())
    idf = np.log((1 + n) / (1 + counts)) + 1
    drawn = sample(rows, per_language)
    fitted = (drawn.select("_text", "_lang", "_key").mapInArrow(_sample_features, "lang string, key bigint, f array<int>, tf array<double>")
              .repartition(1).mapInArrow(_fitter(idf, epochs, alpha, beta, l1, l2),
                                         "langs array<string>, temperature double, weights binary").collect())
    if not fitted:
        return LanguageModel([], 1.0, np.zeros((0, 1 << BITS), np.float32), np.zeros(0))
    with np.load(io.BytesIO(bytes(fitted[0]["weights"]))) as a:
        return LanguageModel(list(fitted[0]["langs"]), fitted[0]["temperature"], a["w"], a["b"])


def _scorer(shared, text_col):
    def run(batches):
        model, grams = shared.value, Grams()
        for b, texts in _text_batches(batches, lambda b: pc.struct_field(column(b, "row"), text_col)):
            orders, total, has = grams(texts)
            logits = np.zeros((len(model.langs), len(texts)))
            for f, d in orders:
                starts = np.flatnonzero(np.diff(d, prepend=-1))
                if len(starts):
                    for k, w in enumerate(model.weights):
                        logits[k, d[starts]] += np.add.reduceat(w[f], starts, dtype=np.float64)
            ok = has if model.langs else np.zeros(len(texts), bool)
            langs, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if ok.any():
                p = softmax((logits / np.maximum(total, 1)).T + model.bias)
                langs[ok] = np.array(model.langs, object)[p.argmax(1)][ok]
                score[ok] = p.max(1)[ok]
            yield pa.RecordBatch.from_arrays([column(b, "row"), pa.array(langs, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])
        pa.default_memory_pool().release_unused()          # the worker lives on between tasks
    return run


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score): ``row`` is a struct of all columns of ``docs``.

    ``und`` with score 0 where the text is null, empty or has no letter, or the
    model knows no language.  Only the text is read for the prediction.
    """
    from pyspark.sql import types as T
    rows = docs.select(F.struct(*docs.columns).alias("row"))           # holds the text, which travels once
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_scorer(shared, text_col), schema)


def held_out(id_col: Column, buckets: int = 4, bucket: int = 2) -> Column:
    """Whether crc32 of the id as text falls into the held-out bucket; a null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % buckets == bucket, F.lit(True))
