"""Token ids in seekable zstandard files: one independent frame per piece of a document.

A file holds the frames of its documents in ascending id order, then a skippable
frame with the documents' ids and frame counts, then the seek table of the
public seekable format (compressed size, raw size and checksum of each frame).
A reader seeks to the tail, finds the documents it was asked for and decompresses
their frames only, checking each against its checksum.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import ascii_words, column, small_batches

# fixed values of the public seekable format
SEEK_MAGIC = 0x184D2A5E
FOOT_MAGIC = 0x8F92EAB1
INDEX_MAGIC = 0x184D2A50
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 1 << 20        # raw bytes of a frame at most; a longer document has several frames


class WordEncoder:
    """Whole texts to ids, encoding each distinct word between ASCII white space once.

    Right for tokenizers that drop white space, split letters from punctuation, ignore
    case and never join words across white space.  A word of letters with one mark
    behind it is looked up as its letters and the mark.  Words of letters end with an
    end-of-word id, so many of them are encoded as one text and cut behind those ids.
    Words are remembered in two generations of bounded size, so frequent ones stay.
    """

    END = "</w>"

    MARKS = ".,;:!?"

    def __init__(self, path: str, remembered: int = 600_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.limit = Tokenizer.from_file(path), remembered
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for entry, i in vocab.items() if entry.endswith(self.END)]] = True
        self.marks = self._encode(list(self.MARKS)) + [b""]
        self.mark_set = pa.array(list(self.MARKS), pa.large_string())

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as unsigned 32-bit integers."""
        out = []
        for lo in range(0, len(words), 10_000):
            out += [np.array(e.ids, "<u4").tobytes()
                    for e in self.tokenizer.encode_batch_fast(words[lo:lo + 10_000], add_special_tokens=False)]
        return out

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """``_encode`` of words of letters only: many in one text, cut behind end-of-word ids."""
        out: list[bytes] = []
        for lo in range(0, len(words), 2000):
            some = words[lo:lo + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                out += self._encode(some)                # a letter that the tokenizer does not take for one
                continue
            raw, marks = ids.tobytes(), [0, *(4 * cuts).tolist()]
            out += [raw[i:j] for i, j in zip(marks, marks[1:])]
        return out

    def _learn(self, words: list[str]) -> None:
        """Make ``known`` hold all of ``words`` (distinct)."""
        if len(self.known) > self.limit // 2:
            self.known, self.older = {}, self.known
        new = [w for w in words if w not in self.known]
        if self.older:
            self.known.update([(w, self.older[w]) for w in new if w in self.older])
            new = [w for w in new if w not in self.known]
        letters = [w.isalpha() and w.lower().isalpha() for w in new]
        some = [w for w, ok in zip(new, letters) if ok]
        self.known.update(zip(some, self._encode_letters(some)))
        some = [w for w, ok in zip(new, letters) if not ok]
        self.known.update(zip(some, self._encode(some)))

    def _parts(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(what is looked up for each word, number of the mark behind it)."""
        last = pc.utf8_slice_codeunits(words, -1)
        mark = pc.index_in(last, self.mark_set)
        base = pc.if_else(pc.is_valid(mark), pc.utf8_slice_codeunits(words, 0, -1), words)
        plain = pc.string_is_ascii(base)
        letters = pc.and_(pc.utf8_is_alpha(base), pc.or_(plain, pc.utf8_is_alpha(pc.utf8_lower(base))))
        key = pc.if_else(letters, pc.if_else(plain, pc.ascii_lower(base), base), words)
        number = pc.fill_null(pc.if_else(letters, mark, None), len(self.MARKS))
        return key, number.to_numpy(zero_copy_only=False).astype(np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text)."""
        codes, words, offsets = ascii_words(texts, lower=False)
        if not len(codes):
            return np.empty(0, "<u4"), np.zeros(len(offsets), np.int64)
        keys, mark = self._parts(words)
        coded = keys.dictionary_encode()
        known = coded.dictionary.to_pylist()
        self._learn(known)
        pieces = [self.known[w] for w in known] + self.marks
        flat, sizes = np.frombuffer(b"".join(pieces), "<u4"), np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        # each distinct word: its key's ids, then its mark's
        both = np.stack([coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(known) + mark], 1).ravel()
        ids, ends = spread(both, flat, sizes, np.arange(0, len(both) + 1, 2))
        return spread(codes, ids, np.diff(ends), offsets)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this process (a worker keeps it between tasks; its memory is bounded)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def spread(codes: np.ndarray, flat: np.ndarray, lengths: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace each code by its piece of ``flat`` (pieces of ``lengths`` in order); (all values, offsets by text)."""
    if not len(codes):
        return flat[:0], np.zeros(len(offsets), np.int64)
    first = np.cumsum(lengths) - lengths
    each = lengths[codes]
    ends = np.cumsum(each)
    at = np.arange(ends[-1]) + np.repeat(first[codes] - (ends - each), each)
    return flat[at], np.concatenate([[0], ends])[offsets]


class FrameWriter:
    """One file: ``add`` documents in order, then ``close``."""

    def __init__(self, sink, level: int = 3) -> None:
        self.sink, self.zstd = sink, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.table, self.ids = array("I"), array("q")
        self.nulls, self.frames = array("B"), array("I")

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = ids.astype("<u4", copy=False).tobytes()
        parts = range(0, max(1, len(raw)), FRAME_BYTES)
        for lo in parts:
            piece = raw[lo:lo + FRAME_BYTES]
            frame = self.zstd.compress(piece)
            self.sink.write(frame)
            self.table.extend((len(frame), len(piece), xxhash.xxh64_intdigest(piece) & 0xFFFFFFFF))
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.frames.append(len(parts))

    def close(self) -> None:
        index = (struct.pack("<Q", len(self.ids)) + np.array(self.ids, "<i8").tobytes() + np.array(self.nulls, "u1").tobytes()
                 + np.array(self.frames, "<u4").tobytes())
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self.table, "<u4").tobytes() + struct.pack("<IBI", len(self.table) // 3, CHECKSUM_FLAG, FOOT_MAGIC)
        self.sink.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class FrameReader:
    """Random access to one file; nothing but the tail and the asked-for frames is read."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        frames, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOT_MAGIC:
            raise ValueError("not a seekable file: its seek table is missing")
        self.table = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        end = int(self.starts[-1])                          # the index follows the documents' frames
        index = self._at(end + 8, struct.unpack("<II", self._at(end, 8))[1])
        (n,) = struct.unpack("<Q", index[:8])
        self.ids = np.frombuffer(index, "<i8", n, 8)
        self.nulls = np.frombuffer(index, "u1", n, 8 + 8 * n).astype(bool)
        self.frames = np.frombuffer(index, "<u4", n, 8 + 9 * n).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.frames)])
        self.zstd = zstandard.ZstdDecompressor()

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def doc_id(self, i: int) -> int | None:
        return None if self.nulls[i] else int(self.ids[i])

    def tokens(self) -> np.ndarray:
        """Ids in each document, from the seek table alone."""
        raw = np.concatenate([[0], np.cumsum(self.table[:, 1])])
        return (raw[self.first[1:]] - raw[self.first[:-1]]) // 4

    def raw(self, i: int) -> bytes:
        """The ids of document ``i`` of the file as bytes; every frame is checked."""
        out = []
        for k in range(self.first[i], self.first[i + 1]):
            packed, size, check = self.table[k]
            piece = self.zstd.decompress(self._at(int(self.starts[k]), int(packed)), max_output_size=int(size))
            if len(piece) != size or xxhash.xxh64_intdigest(piece) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} does not match its checksum")
            out.append(piece)
        return b"".join(out)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system, as the Hadoop configuration names it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _writer(folder: str, tokenizer_path: str, end_id: int | None):
    def run(batches):
        part = TaskContext.get()
        name = f"{folder}/part-{part.partitionId():06d}.zst"
        store, path = _store(name)
        own = f"{path}.{part.taskAttemptId()}.tmp"
        encode, docs, tokens = encoder(tokenizer_path), 0, 0
        batches = iter(small_batches(batches, rows=1 << 14, bytes_=16 << 20))
        first = next(batches, None)
        if first is None:
            return
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(own, compression=None) as sink:
            out = FrameWriter(sink)
            for b in _chain(first, batches):
                ids, off = encode(column(b, "_text"))
                for i, doc_id in enumerate(column(b, "_id").to_pylist()):
                    one = ids[off[i]:off[i + 1]]
                    one = np.append(one, np.uint32(end_id)) if end_id is not None else one
                    out.add(doc_id, one)
                    docs, tokens = docs + 1, tokens + len(one)
            out.close()
        if store.get_file_info(path).type != fs.FileType.NotFound:
            store.delete_file(path)                      # an earlier attempt's copy of the same bytes
        store.move(own, path)
        yield pa.RecordBatch.from_arrays([pa.array([part.partitionId()]), pa.array([name]), pa.array([docs]), pa.array([tokens])],
                                         ["part", "path", "docs", "tokens"])
    return run


def _chain(first, rest) -> Iterator:
    yield first
    yield from rest


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int | None = 1) -> list[dict]:
    """Encode every whole text and write the ids below ``folder``; returns the files in order.

    Files follow each other in ascending id order (nulls first, ties by text).  Each
    document ends with ``end_id`` unless that is None.  Null texts are empty.  An
    entry has part, path, docs, tokens and start (ids in all files before it).  Ids
    of documents are integers.  Files are written under a name of the attempt and
    renamed, so a repeated task leaves one whole file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                       F.xxhash64(text_col).alias("_h"), F.monotonically_increasing_id().alias("_n"))
    ordered = rows.repartitionByRange("_id", "_h", "_n").sortWithinPartitions("_id", "_h", "_n")
    files = ordered.select("_id", "_text").mapInArrow(
        _writer(qualified(spark, folder), tokenizer_path, end_id), "part bigint, path string, docs bigint, tokens bigint")
    out, start = [], 0
    for r in sorted(files.collect(), key=lambda r: r["part"]):        # one row per file
        out.append({**r.asDict(), "start": start})
        start += r["tokens"]
    return out


def _reader(digest: bool):
    def run(batches):
        for b in batches:
            for path, start in zip(column(b, "path").to_pylist(), column(b, "start").to_pylist()):
                store, name = _store(path)
                with store.open_input_file(name) as source:
                    file = FrameReader(source)
                    counts = file.tokens()
                    starts = start + np.cumsum(counts) - counts
                    for lo in range(0, len(counts), 512):
                        docs = range(lo, min(lo + 512, len(counts)))
                        raws = [file.raw(i) for i in docs]
                        last = (pa.array([zlib.crc32(x) for x in raws], pa.int64()) if digest
                                else pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in raws], pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([file.doc_id(i) for i in docs], pa.int64()), pa.array(starts[lo:lo + 512]),
                             pa.array(counts[lo:lo + 512]), last], ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])
    return run


def read_tokens(spark: SparkSession, files: list[dict], digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids), or ids_crc32 instead of ids, of every document in ``files``."""
    if not files:
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, " + ("ids_crc32 bigint" if digest else "ids array<int>"))
    listing = spark.createDataFrame([(f["part"], f["path"], f["start"]) for f in files], "part bigint, path string, start bigint")
    listing = listing.repartitionByRange(len(files), "part")
    return listing.select("path", "start").mapInArrow(
        _reader(digest), "doc_id bigint, start bigint, n_tokens bigint, " + ("ids_crc32 bigint" if digest else "ids array<int>"))


def fetch(path: str, doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
    """Ids of the asked-for documents of one file; frames of other documents are not read."""
    store, name = _store(path)
    with store.open_input_file(name) as source:
        file = FrameReader(source)
        wanted = set(doc_ids)
        return {int(d): np.frombuffer(file.raw(i), "<u4") for i, d in enumerate(file.ids) if not file.nulls[i] and int(d) in wanted}
