"""Helpers shared by the corpus operators: scratch tables, ASCII words, hashes, grouped streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import scratch_path

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)


_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage is cut, the copy is shared.

    ``rows``: rows of an Arrow batch while it is written, where rows can be long (a batch
    is held outside of the heap, once in the JVM and once in the worker).  Row groups
    are small, so that a task's writer holds little.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_ROWS)
    if rows:
        spark.conf.set(_ROWS, str(rows))
    try:
        df.write.option("parquet.block.size", 16 << 20).parquet(path)
    finally:
        spark.conf.set(_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (uint64 in, uint64 out)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _S32
    x *= _MUL
    x ^= x >> _S32
    x *= _MUL
    x ^= x >> _S32
    return x


def ascii_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts, with A-Z lower-cased if ``lower``, dictionary coded.

    Returns (code of each word, distinct words, offsets by text); null and
    white-space-only texts have no words.
    """
    texts = pc.fill_null(texts, "")
    if texts.type == pa.string():
        texts = texts.cast(pa.large_string())
    texts = texts.take(pa.array(np.arange(len(texts))))      # the ASCII kernels misread the offsets of a slice
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts) if lower else texts))
    flat, lengths = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    if flat and not pc.all(full).as_py():
        # only a text without words gives an empty piece: exactly one
        ok = full.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        flat, lengths = flat.filter(full), np.bincount(owner[ok], minlength=len(lengths))
    d = flat.dictionary_encode()
    if isinstance(d, pa.ChunkedArray):
        d = d.combine_chunks()
    return (d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary,
            np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit keyed hash of each string (the same on every worker)."""
    if not len(values):
        return np.empty(0, np.uint64)
    return mix64(pd.util.hash_array(values.to_numpy(zero_copy_only=False), categorize=False))


LONG = 2 << 20           # bytes of a text that is hashed in runs
_BLANKS = b" \t\n\x0b\x0c\r"


def text_runs(text: bytes, size: int = LONG):
    """A text in parts of about ``size`` bytes, cut at ASCII white space (a longer word stays whole)."""
    lo = 0
    while len(text) - lo > size:
        cut = max(text.rfind(bytes([c]), lo + 1, lo + size) for c in _BLANKS)
        if cut < 0:
            ends = [e for e in (text.find(bytes([c]), lo + size) for c in _BLANKS) if e >= 0]
            if not ends:
                break
            cut = min(ends)
        yield text[lo:cut]
        lo = cut
    yield text[lo:]


def shingle_sets(texts: pa.Array, width: int):
    """The set of shingle hashes (sorted) of each text; a long text is hashed in runs of bounded length."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if not (size > LONG).any():
        h, off = word_hashes(texts)
        for i in range(len(texts)):
            yield np.unique(shingle_hashes(h[off[i]:off[i + 1]], width))
        return
    for i in range(len(texts)):
        if size[i] <= LONG:
            yield from shingle_sets(texts.slice(i, 1), width)
            continue
        parts, carried = [], np.empty(0, np.uint64)
        for run in text_runs(texts[i].as_buffer().to_pybytes()):
            h = np.concatenate([carried, word_hashes(pa.array([run.decode("utf-8", "replace")]))[0]])
            if len(h) >= width:
                parts.append(np.unique(shingle_hashes(h, width)))
                carried = h[len(h) - width + 1:] if width > 1 else h[:0]
            else:
                carried = h
        yield np.unique(np.concatenate(parts)) if parts else np.unique(shingle_hashes(carried, width))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, offsets by text)."""
    codes, words, offsets = ascii_words(texts)
    h = hash_strings(words)
    return (h[codes] if len(codes) else np.empty(0, np.uint64)), offsets


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width``-word shingles of one word-hash sequence; a shorter sequence is one shingle."""
    n = len(h)
    if not n:
        return h
    w = min(width, n)
    out = np.full(n - w + 1, np.uint64(w), np.uint64)
    for j in range(w):
        out = (out ^ h[j:n - w + 1 + j]) * _MUL
        out ^= out >> np.uint64(29)
    return mix64(out + _MIX)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def small_batches(batches, rows: int = 512, bytes_: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and, unless one row is larger, about ``bytes_`` bytes."""
    for b in batches:
        if not b.num_rows:
            continue
        step = max(1, min(rows, int(b.num_rows * bytes_ / max(1, b.nbytes))))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def groups(batches, keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal ``keys`` in a stream of batches sorted by them; a run may span batches."""
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [column(b, k).to_pylist() for k in keys]
        marks = list(zip(*cols))
        start = 0
        for i in range(1, b.num_rows + 1):
            if i < b.num_rows and marks[i] == marks[start]:
                continue
            key = marks[start]
            if held and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(b.slice(start, i - start))
            start = i
    if held:
        yield held_key, pa.Table.from_batches(held)


MAX_BITS = 27            # bits of a bit table: 16 MB


class Bits:
    """A set of 64-bit hashes as a table of bits (members are always found, a stray one may be)."""

    def __init__(self, size: int, words: np.ndarray) -> None:
        self.size, self.words = size, words

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - self.size)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def bits_of(members: DataFrame, col: str, count: int) -> Bits:
    """Bits of the hashes in ``col`` (bigint), set in tasks; at most 16 MB reach the driver."""
    size = int(np.clip(np.ceil(np.log2(max(1, count) * 32)), 16, MAX_BITS))
    at = F.shiftrightunsigned(F.col(col), 64 - size)
    got = (members.groupBy(F.shiftright(at, 6).alias("w"))
           .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({col}, {64 - size}) & 63 as int))")).alias("m")).toArrow())
    words = np.zeros(1 << (size - 6), np.int64)
    words[got["w"].to_numpy()] = got["m"].to_numpy()
    return Bits(size, words.view(np.uint64))


def unsigned_crc32(col) -> F.Column:
    """crc32 of the UTF-8 bytes of a string column (a long, unsigned)."""
    return F.crc32(col.cast("binary"))
