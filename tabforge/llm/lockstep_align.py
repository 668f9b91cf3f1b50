"""Alignment of two tokenizers over the same text by a lockstep merge of their token ends.

Text is cut into units at places where both tokenizers are known to end a token (before
a space or line feed behind a visible character).  Distinct units of a block are
encoded once.  The merge then works on token byte lengths: a state vector holds, for
every lane (a document, or a run of units of a long one), the current A and B token
and what is left of each.  Each step advances A, B or both in all lanes at once, emits
the cut of every lane whose tokens end together (and with it the links of the group
that the cut closes) and drops finished lanes from the vector.

Documents are worked on in blocks of about 16 MB.  A block's distinct id pairs are
counted by documents, summed over the corpus in Spark, and sent back to their block
only, so a frequent pair is one row for each block and no pair table is broadcast.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import column, groups, materialize, small_batches
from tabforge.llm.token_frames import spread

BLOCK_BYTES = 16 << 20     # text of a block
RUN_UNITS = 1 << 19        # units merged at once
LANE_UNITS = 128           # units of a lane: a longer document is several lanes
SHORT = 1 << 16            # bytes encoded by one call
WIDE = 4096                # a group of more links is counted by its distinct ids
_SPACE, _LINE = 0x20, 0x0A


class ByteSide:
    """A byte-level BPE file of the tokenizers library; special strings in a text are plain text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                     and spec.get("normalizer") is None)
        back, free = {}, 256                       # the byte-level alphabet: printable bytes stand for themselves
        for b in range(256):
            if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
                back[chr(b)] = b
            else:
                back[chr(free)], free = b, free + 1
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        names = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            names[i] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
        self.names = names

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)


class PieceSide:
    """A SentencePiece file that adds the leading space itself: units are encoded behind a guard word."""

    GUARD = "a"

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.cuts = not any(re.search("[^▁]▁|.\n|\n.", p, re.S) for p in pieces)
        self.names = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        self.guard = self.model.encode(self.GUARD)

    def encode(self, text: str) -> np.ndarray:
        """Ids of ``text``, which starts with the space that the model would add, or with a line feed."""
        if text[:1] == " " and not self.cuts:
            return np.array(self.model.encode(text[1:]), np.int32)
        ids = self.model.encode(self.GUARD + text)
        return np.array(ids[len(self.guard):], np.int32)


class Side:
    """One tokenizer with the bytes of its ids."""

    def __init__(self, inner) -> None:
        self.inner, self.cuts, self.size = inner, inner.cuts, len(inner.names)
        self.lengths = np.array([len(x) for x in inner.names], np.int32)
        self.bytes = pa.array(inner.names, pa.large_binary())
        digits = [str(i) for i in range(self.size)]
        self.digits = pa.array([d + end for d in digits for end in ",|;"], pa.large_string())

    def joined(self, ids: np.ndarray) -> bytes:
        return _data(self.bytes.take(pa.array(ids)))

    def units(self, units: pa.LargeBinaryArray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all units, ids in each, whether the ids spell the unit)."""
        n, size = len(units), pc.binary_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
        ids: list[np.ndarray] = [np.empty(0, np.int32)] * n
        count, ok = np.zeros(n, np.int64), np.zeros(n, bool)
        raw = units.to_pylist()
        together = np.flatnonzero(~alone)
        chunk = np.cumsum(size[together]) // SHORT
        parts: list[tuple[np.ndarray, np.ndarray]] = []           # (units, ids)
        single = list(np.flatnonzero(alone))
        for lo, hi in _runs(chunk):
            at = together[lo:hi]
            text = b"".join([raw[i] for i in at])
            got = self.inner.encode(text.decode("utf-8", "replace"))
            ends, marks = np.cumsum(self.lengths[got]), np.cumsum(size[at])
            places = np.searchsorted(ends, marks)
            if not len(ends) or ends[-1] != marks[-1] or (ends[places] != marks).any() or self.joined(got) != text:
                single.extend(at)
                continue
            count[at], ok[at] = np.diff(np.concatenate([[0], places + 1])), True
            parts.append((at, got))
        for i in single:
            got = self.inner.encode(raw[i].decode("utf-8", "replace"))
            count[i], ok[i] = len(got), self.joined(got) == raw[i]
            parts.append((np.array([i]), got))
        start = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), np.int32)
        for at, got in parts:
            where = np.repeat(start[at], count[at]) + _within(count[at])
            flat[where] = got
        return flat, count, ok


def _data(strings) -> bytes:
    """The bytes of all values of a fresh large string or binary array, in order."""
    if not len(strings):
        return b""
    off = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1 + strings.offset)[strings.offset:]
    return strings.buffers()[2].to_pybytes()[off[0]:off[-1]] if strings.buffers()[2] is not None else b""


def _runs(keys: np.ndarray):
    """(start, end) of runs of equal keys."""
    if len(keys):
        edge = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        yield from zip(edge[:-1], edge[1:])


def _within(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def unit_starts(data: np.ndarray, starts: np.ndarray, inside: bool = True) -> np.ndarray:
    """Offsets at which units start: texts' own ``starts`` and, if ``inside``, safe places within them."""
    if not inside or len(data) < 2:
        return starts
    cut = (data == _SPACE) | (data == _LINE)
    cut[1:] &= _visible(data)[:-1]
    cut[starts] = True
    return np.flatnonzero(cut)


def _visible(data: np.ndarray) -> np.ndarray:
    """Whether a byte ends a character that no tokenizer takes for white space (false where in doubt)."""
    p2 = np.concatenate([[0], data[:-1]]).astype(np.uint8)
    p3 = np.concatenate([[0, 0], data[:-2]]).astype(np.uint8)
    blank = (((p2 == 0xC2) & ((data == 0x85) | (data == 0xA0))) | ((p3 == 0xE1) & (p2 == 0x9A))
             | ((p3 == 0xE2) & ((p2 == 0x80) | (p2 == 0x81))) | ((p3 == 0xE3) & (p2 == 0x80)))
    return (data > _SPACE) & (data != 0x7F) & ~blank


def lockstep(la: np.ndarray, lb: np.ndarray, sa: np.ndarray, sb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of all lanes: (A tokens before the cut, B tokens before it), in order.

    ``la``, ``lb``: byte lengths of the tokens; lane k holds the A tokens
    sa[k]:sa[k + 1] and the B tokens sb[k]:sb[k + 1], of equal total length above 0.
    """
    la, lb = np.append(la, 0), np.append(lb, 0)
    i, j, end = sa[:-1].copy(), sb[:-1].copy(), sa[1:]
    left_a, left_b = la[i], lb[j]
    cuts_a, cuts_b = [], []
    while len(i):
        gap = left_a - left_b
        move_a, move_b = gap <= 0, gap >= 0
        i, j = i + move_a, j + move_b
        cut = move_a & move_b
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        done = cut & (i == end)
        left_a, left_b = np.where(move_a, la[i], gap), np.where(move_b, lb[j], -gap)
        if done.any():
            live = ~done
            i, j, end, left_a, left_b = i[live], j[live], end[live], left_a[live], left_b[live]
    if not cuts_a:
        return sa[:0], sb[:0]
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def group_links(a: np.ndarray, b: np.ndarray, a0: np.ndarray, na: np.ndarray, b0: np.ndarray, nb: np.ndarray):
    """(group, A id, B id, weight) of all token pairs of each group; a wide group gives its distinct pairs."""
    wide = na * nb > WIDE
    g = np.flatnonzero(~wide)
    size = (na * nb)[g]
    k, width = _within(size), np.repeat(nb[g], size)
    who = np.repeat(g, size)
    out = [(who, a[a0[who] + k // width], b[b0[who] + k % width], np.ones(len(k), np.int64))]
    for x in np.flatnonzero(wide):
        ua, ca = np.unique(a[a0[x]:a0[x] + na[x]], return_counts=True)
        ub, cb = np.unique(b[b0[x]:b0[x] + nb[x]], return_counts=True)
        out.append((np.full(len(ua) * len(ub), x), np.repeat(ua, len(ub)), np.tile(ub, len(ua)), np.outer(ca, cb).ravel()))
    return tuple(np.concatenate(c) for c in zip(*out))


class _Doc:
    """What is known of one text; a long one is filled in by several runs."""

    __slots__ = ("n_a", "n_b", "n_groups", "n_links", "sha", "text", "pairs", "weights")

    def __init__(self, keep_text: bool) -> None:
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.sha, self.text = hashlib.sha256(), [] if keep_text else None
        self.pairs, self.weights = [], []

    def add(self, n_a: int, n_b: int, n_groups: int, n_links: int, spelled: bytes, pairs, weights) -> None:
        piece = (b";" if self.n_groups else b"") + spelled
        self.sha.update(piece)
        if self.text is not None:
            self.text.append(piece)
        self.n_a, self.n_b = self.n_a + n_a, self.n_b + n_b
        self.n_groups, self.n_links = self.n_groups + n_groups, self.n_links + n_links
        self.pairs.append(pairs)
        self.weights.append(weights)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0], self.weights[0]
        if not self.pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        values, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
        total = np.zeros(len(values), np.int64)
        np.add.at(total, at, np.concatenate(self.weights))
        return values, total


class Aligner:
    """Both tokenizers of a process."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = Side(ByteSide(a_path)), Side(PieceSide(b_path))
        self.inside = bool(self.a.cuts and self.b.cuts)

    def __call__(self, texts: list[bytes | None], keep_text: bool = False) -> list[_Doc]:
        docs = [_Doc(keep_text) for _ in texts]
        held = [k for k, t in enumerate(texts) if t]
        if not held:
            return docs
        raw = b"".join([b" " + texts[k] for k in held])
        data = np.frombuffer(raw, np.uint8)
        size = np.array([len(texts[k]) + 1 for k in held], np.int64)
        first = np.cumsum(size) - size
        starts = unit_starts(data, first, self.inside)
        offsets = np.append(starts, len(raw)).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        codes, units = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        # only a text's last unit may end in white space; such units are encoded by themselves
        alone = np.ones(len(units), bool)
        if self.inside:
            seen = np.zeros(len(units), np.int64)
            seen[codes] = np.arange(len(codes))
            alone = ~_last_visible(data, offsets[seen + 1])
        ids_a, in_a, ok_a = self.a.units(units, alone)
        ids_b, in_b, ok_b = self.b.units(units, alone)
        bad = ~(ok_a & ok_b)
        doc_first = np.searchsorted(starts, first)
        owner = np.repeat(np.arange(len(held)), np.diff(np.append(doc_first, len(codes))))
        if bad.any():
            spoiled = np.zeros(len(held), bool)
            spoiled[owner[bad[codes]]] = True
            keep = ~spoiled[owner]
            codes, owner = codes[keep], owner[keep]
        for lo in range(0, len(codes), RUN_UNITS):
            self._run(codes[lo:lo + RUN_UNITS], owner[lo:lo + RUN_UNITS], ids_a, in_a, ids_b, in_b, [docs[k] for k in held])
        return docs

    def _run(self, codes, owner, ids_a, in_a, ids_b, in_b, docs) -> None:
        marks = np.arange(len(codes) + 1)
        a, ua = spread(codes, ids_a, in_a, marks)          # ids and token offsets by unit
        b, ub = spread(codes, ids_b, in_b, marks)
        ua, ub = ua.astype(np.int64), ub.astype(np.int64)
        edge = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])          # segments of documents
        stop = np.append(edge[1:], len(codes))
        parts = -(-(stop - edge) // LANE_UNITS)
        lanes = np.append(np.repeat(edge, parts) + _within(parts) * LANE_UNITS, len(codes))
        ca, cb = lockstep(self.a.lengths[a].astype(np.int64), self.b.lengths[b].astype(np.int64), ua[lanes], ub[lanes])
        a0, b0 = np.concatenate([[0], ca[:-1]]), np.concatenate([[0], cb[:-1]])
        na, nb = ca - a0, cb - b0
        # segment of each group, then the links
        of = np.searchsorted(ua[stop], ca)
        g, la, lb, weight = group_links(a, b, a0, na, b0, nb)
        span = self.a.size * self.b.size
        key = of[g] * span + la.astype(np.int64) * self.b.size + lb
        order = np.argsort(key)
        key = key[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        total = np.add.reduceat(weight[order], new)
        key = key[new]
        cut = np.searchsorted(key, np.arange(len(edge) + 1) * span)
        spelled, ends = self._spell(a, b, ca, cb, a0, b0, ua[stop], ub[stop])
        n_groups = np.bincount(of, minlength=len(edge))
        n_links = np.zeros(len(edge), np.int64)
        np.add.at(n_links, of, na * nb)
        begin = 0
        for s in range(len(edge)):
            docs[owner[edge[s]]].add(int(ua[stop[s]] - ua[edge[s]]), int(ub[stop[s]] - ub[edge[s]]), int(n_groups[s]), int(n_links[s]),
                                     spelled[begin:ends[s] - 1], key[cut[s]:cut[s + 1]] % span, total[cut[s]:cut[s + 1]])
            begin = ends[s]

    def _spell(self, a, b, ca, cb, a0, b0, stop_a, stop_b) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;...;`` of all groups, and where each segment ends in it."""
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[ca - 1], end_b[cb - 1] = 1, 2                       # last of its group: | and ;
        table = pa.concat_arrays([self.a.digits, self.b.digits])
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.repeat(b0, ca - a0)] = a * 3 + end_a
        codes[np.arange(len(b)) + np.repeat(ca, cb - b0)] = 3 * self.a.size + b * 3 + end_b
        strings = table.take(pa.array(codes))
        off = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1)
        return _data(strings), off[stop_a + stop_b]


def _last_visible(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character before each offset is visible."""
    at = np.arange(-3, 0)[None, :] + ends[:, None]
    three = np.where(at >= 0, data[np.maximum(at, 0)], 0).astype(np.uint8)
    return _visible(three.ravel())[2::3] if len(ends) else np.zeros(0, bool)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this process (kept between tasks; it holds the two vocabularies only)."""
    key = (a_path, b_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(a_path, b_path)
    return _ALIGNERS[key]


_DOC_FIELDS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, links binary"


def _pack(places: np.ndarray, weights: np.ndarray) -> bytes:
    """Ascending places and their weights, as differences in compressed columns."""
    body = np.diff(places, prepend=0).astype("<u4").tobytes() + weights.astype("<u8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = len(body) // 12
    return np.cumsum(np.frombuffer(body, "<u4", n).astype(np.int64)), np.frombuffer(body, "<u8", n, 4 * n).astype(np.int64)


def _align_blocks(a_path: str, b_path: str, digest: bool):
    def run(batches):
        work, part, number = aligner(a_path, b_path), TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, rows=1 << 20, bytes_=BLOCK_BYTES):
            block, number = (part << 32) + number, number + 1
            docs = work([None if t is None else t.encode("utf-8", "replace") for t in column(batch, "_text").to_pylist()], keep_text=not digest)
            found = [d.distinct() for d in docs]
            pairs, times = np.unique(np.concatenate([p for p, _ in found]), return_counts=True)
            n = len(docs)
            said = [(d.sha.hexdigest() if digest else b"".join(d.text).decode()) if d.n_a else "" for d in docs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), column(batch, "_id"),
                 *[pa.array([getattr(d, c) for d in docs], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                 pa.array(said, pa.string()),
                 pa.array([_pack(np.searchsorted(pairs, p), w) if len(p) else None for p, w in found], pa.binary())],
                ["block", "pair", "docs", "_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])
            m = len(pairs)
            if m:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, block)), pa.array(pairs), pa.array(times.astype(np.int64)), pa.nulls(m, batch.schema.field("_id").type),
                     *[pa.nulls(m, pa.int64()) for _ in range(4)], pa.nulls(m, pa.string()), pa.nulls(m, pa.binary())],
                    ["block", "pair", "docs", "_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])
    return run


def _weigh(batches):
    """Per block: its pairs' corpus counts (sorted by pair), then its documents."""
    for _, t in groups(batches, ["block"]):
        is_doc = pc.is_null(t["pair"]).combine_chunks()
        table = t.filter(pc.invert(is_doc))
        count = table["docs"].to_numpy()
        best = table["best"].to_numpy(zero_copy_only=False).astype(bool)
        docs = t.filter(is_doc).select(["_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])
        n_best, total = [], []
        for blob in docs["links"].to_pylist():
            if blob is None:
                n_best.append(0)
                total.append(0)
                continue
            at, w = _unpack(blob)
            n_best.append(int(w[best[at]].sum()))
            total.append(int((w * count[at]).sum()))
        out = (docs.drop_columns(["links"]).append_column("n_best", pa.array(n_best, pa.int64()))
               .append_column("count_sum", pa.array(total, pa.int64())))
        yield from out.combine_chunks().to_batches()


def align_blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                 digest: bool = False) -> DataFrame:
    """First half of ``align``, written: document rows, and one row for each block and id pair (docs: the
    block's documents that hold it linked)."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()
    return materialize(src.mapInArrow(_align_blocks(a_path, b_path, digest),
                                      f"block bigint, pair bigint, docs bigint, _id {id_type}, {_DOC_FIELDS}"), "la-blocks")


def pair_counts(blocks: DataFrame, b_size: int) -> DataFrame:
    """(pair, a_id, b_id, docs): how many documents of the corpus hold each id pair linked."""
    return (blocks.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("docs"))
            .select("pair", F.expr(f"cast(pair div {b_size} as int)").alias("a_id"), F.expr(f"cast(pair % {b_size} as int)").alias("b_id"), "docs"))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per input row: id, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum, groups.

    A: byte-level BPE file of the tokenizers library, given space + text; B: SentencePiece
    file, given the text.  Bytes at which tokens of both end cut the text into groups;
    links are all A-B pairs of a group.  count_sum adds up, over the links, how many
    documents hold the same id pair linked; n_best counts the links whose pair has the
    highest such count of its A id.  ``groups`` spells the groups as ``a1,a2|b1;a3|b2,b3``,
    or is that string's SHA-256 with ``digest``.  Null and empty texts, and texts that
    one of the tokenizers does not spell back byte by byte, have no tokens: zeros and ''.
    Long texts are merged in runs of bounded size (a stretch without spaces is one
    lane).  Repeated rows stay and count as documents of their own; other columns are
    ignored; an empty table gives an empty result.
    """
    from sentencepiece import SentencePieceProcessor
    blocks = align_blocks(docs, a_path, b_path, id_col, text_col, digest)
    counts = materialize(pair_counts(blocks, SentencePieceProcessor(model_file=b_path).get_piece_size()), "la-counts")
    top = counts.groupBy("a_id").agg(F.max("docs").alias("top"))                  # at most one row for each id of A
    counts = counts.join(top, "a_id").select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"))
    known = blocks.where("pair IS NOT NULL").select("block", "pair").join(counts, "pair")
    rows = blocks.where("pair IS NULL")
    fields = ["_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]
    both = rows.select("block", "pair", "docs", F.lit(None).cast("boolean").alias("best"), *fields).unionByName(
        known.select("block", "pair", "docs", "best", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in fields]))
    id_type = rows.schema["_id"].dataType.simpleString()
    out = (both.repartition("block").sortWithinPartitions("block", "pair")
           .mapInArrow(_weigh, f"_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, n_best bigint, count_sum bigint"))
    return out.select(F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
