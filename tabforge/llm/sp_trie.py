"""SentencePiece encoding by a shared-prefix forward pass over a trie of marked words, and decoding.

Text is normalised by the model and cut before each run of the space mark: no
piece continues across such a cut.  The distinct marked words of a block, but for
those remembered from earlier blocks, are sorted, which is a depth-first walk of their trie, and the forward state of each
prefix is kept on a stack, so words share the work of their common prefixes.

The state of a prefix is the last piece of its encoding.  For a BPE model a
segmentation is the model's encoding exactly when each two neighbouring pieces are
the encoding of their own concatenation, so the lattice keeps, at each prefix, the
one piece whose predecessor's state is compatible with it; following the states
back gives the word's pieces.  (Maximising summed scores, as for a unigram model,
would give other pieces than the model: scores of a BPE model are merge ranks.)
"""

from __future__ import annotations

import codecs
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.common import column, small_batches
from tabforge.llm.token_frames import spread

MARK = "▁"
_BPE = 2
BLOCK_ROWS, BLOCK_BYTES = 2048, 2 << 20     # texts encoded at a time; Python holds some tens of bytes for each of their words


def _one_by_one(error: UnicodeDecodeError):
    """Each byte that is no valid UTF-8 becomes one replacement character."""
    return "�", error.start + 1


codecs.register_error("sp_single", _one_by_one)


def _fields(data: bytes):
    """(number, value) of the fields of one protocol-buffer message; value is an int or bytes."""
    i = 0

    def varint():
        nonlocal i
        out = shift = 0
        while True:
            b = data[i]
            i += 1
            out |= (b & 0x7F) << shift
            if b < 0x80:
                return out
            shift += 7

    while i < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[i:i + n]
            i += n


def _is_bpe(path: str) -> bool:
    with open(path, "rb") as f:
        spec = next((v for k, v in _fields(f.read()) if k == 2), b"")        # trainer_spec
    return next((v for k, v in _fields(spec) if k == 3), 1) == _BPE           # model_type


class PieceModel:
    """Pieces and scores of a SentencePiece BPE model file."""

    def __init__(self, path: str, remembered: int = 2_000_000, words: int = 400_000) -> None:
        from sentencepiece import SentencePieceProcessor
        if not _is_bpe(path):
            raise ValueError(f"{path}: only BPE models are supported")
        self.sp = sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        texts = sp.id_to_piece(list(range(n)))
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.size, self.unk = n, sp.unk_id()
        self.ids = {t: i for i, t in enumerate(texts) if not special[i]}
        if any(MARK in t.lstrip(MARK) for t in self.ids):
            raise ValueError(f"{path}: a piece goes on after a space mark")
        self.score = [sp.get_score(i) for i in range(n)]
        self.text = texts
        self.longest = max(map(len, self.ids))
        self.bytes = {int(texts[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        # newlines stand alone in many vocabularies: cutting there makes more words equal
        alone = not any("\n" in t and len(t) > 1 for t in self.ids)
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if alone else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.out = [(b"" if special[i] else t.replace(MARK, " ").encode()) for i, t in enumerate(texts)]
        for b, i in self.bytes.items():
            self.out[i] = bytes([b])
        if self.unk >= 0:
            self.out[self.unk] = " ⁇ ".encode()
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.remembered, self.words = remembered, words
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _name(self, s: str) -> int:
        """Id of a piece, or past the vocabulary the code point of a lone character that is no piece; -1 otherwise."""
        i = self.ids.get(s, -1)
        return i if i >= 0 or len(s) != 1 else self.size + ord(s)

    def _spell(self, t: int) -> str:
        return self.text[t] if t < self.size else chr(t - self.size)

    def merge(self, s: str) -> list[int]:
        """The encoding of ``s`` by merging the best pair (highest score, leftmost) until none is left."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.score[k] > best):
                    best, at = self.score[k], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self._name(p) for p in parts]

    def follows(self, a: int, b: int) -> bool:
        """Whether the encoding of both pieces' text is these two pieces."""
        key = a * 0x200000 + b
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= self.remembered:
                self.pairs.clear()
            ok = self.pairs[key] = self.merge(self._spell(a) + self._spell(b)) == [a, b]
        return ok

    def starts(self, a: int) -> bool:
        ok = self.alone.get(a)
        if ok is None:
            ok = self.alone[a] = self.merge(self._spell(a)) == [a]
        return ok

    def encode_sorted(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word of a sorted list of distinct marked words."""
        out, last, before = [], [0], ""
        get, pairs, follows, longest, size = self.ids.get, self.pairs, self.follows, self.longest, self.size
        for w in words:
            shared, limit = 0, min(len(w), len(before))
            while shared < limit and w[shared] == before[shared]:
                shared += 1
            del last[shared + 1:]
            for end in range(shared + 1, len(w) + 1):
                state = -1
                # one piece at most is compatible, so the order does not matter; most pieces are short
                for start in range(end - 1, max(-1, end - longest - 1), -1):
                    t = get(w[start:end])
                    if t is None:
                        if start < end - 1:
                            continue
                        t = size + ord(w[start])
                    if start:
                        ok = pairs.get(last[start] * 0x200000 + t)
                        if ok is None:
                            ok = follows(last[start], t)
                    else:
                        ok = self.starts(t)
                    if ok:
                        state = t
                        break
                last.append(state if state >= 0 else self.merge(w[:end])[-1])
            ids, end = [], len(w)
            while end:
                t = last[end]
                ids.append(t)
                end -= len(self.text[t]) if t < size else 1
            out.append(self._emit(ids[::-1]))
            before = w
        return out

    def _emit(self, ids: list[int]) -> np.ndarray:
        if all(t < self.size for t in ids):
            return np.array(ids, np.int32)
        flat: list[int] = []
        for t in ids:
            if t < self.size:
                flat.append(t)
            elif self.bytes:
                flat += [self.bytes[b] for b in chr(t - self.size).encode()]
            elif not flat or flat[-1] != self.unk:
                flat.append(self.unk)
        return np.array(flat, np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text); a null text is empty."""
        codes, seen, offsets = [], {}, [0]
        for t in texts:
            words = self.cut.findall(self.sp.normalize(t)) if t else []
            codes += [seen.setdefault(w, len(seen)) for w in words]
            offsets.append(len(codes))
        if len(self.known) > self.words // 2:             # two generations, so that frequent words stay
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for w in seen:
            if w not in known:
                ids = older.get(w)
                if ids is None:
                    new.append(w)
                else:
                    known[w] = ids
        new.sort()
        known.update(zip(new, [x.tobytes() for x in self.encode_sorted(new)]))
        pieces = [known[w] for w in seen]
        return spread(np.array(codes, np.int64), np.frombuffer(b"".join(pieces), np.int32),
                      np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4, np.array(offsets))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the mark that the model put before the text is taken away."""
        s = b"".join([self.out[i] for i in ids]).decode("utf-8", "sp_single")
        return s[1:] if s.startswith(" ") else s


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of this process (a worker keeps it between tasks; its memory is bounded)."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _coder(path: str, back: bool):
    def run(batches):
        m = model(path)
        for b in small_batches(batches, rows=BLOCK_ROWS, bytes_=BLOCK_BYTES):
            texts = column(b, "_text").to_pylist()
            ids, off = m.encode(texts)
            cols = [column(b, "row"), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))]
            if back:
                decoded = [m.decode(ids[off[i]:off[i + 1]].tolist()) for i in range(len(texts))]
                cols += [pa.array([zlib.crc32(x.encode()) for x in decoded], pa.int64()),
                         pa.array([x == (t or "") for x, t in zip(decoded, texts)])]
            yield pa.RecordBatch.from_arrays(cols, ["row", "ids", "decoded_crc32", "round_trip"][:len(cols)])
        pa.default_memory_pool().release_unused()          # the worker lives on between tasks
    return run


def encode(docs: DataFrame, model_path: str, text_col: str = "text", check: bool = False,
           keep: list[str] | None = None) -> DataFrame:
    """(row, ids): ``row`` is a struct of all columns (or those in ``keep``), ``ids`` the piece ids of the whole text.

    The text travels to the worker once more inside ``row``, and back, unless ``keep`` leaves it out.

    With ``check``, also decoded_crc32 (of the UTF-8 of the text decoded from ids) and
    round_trip (whether it equals the text; a text that holds the space mark itself,
    or that the model normalises, differs).  Null and empty texts have no ids.
    """
    rows = docs.select(F.struct(*(docs.columns if keep is None else keep)).alias("row"), F.col(text_col).alias("_text"))
    fields = [T.StructField("row", rows.schema["row"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if check:
        fields += [T.StructField("decoded_crc32", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    return rows.mapInArrow(_coder(model_path, check), T.StructType(fields))


def _decoder(path: str):
    def run(batches):
        m = model(path)
        for b in small_batches(batches, rows=4096):
            texts = [None if ids is None else m.decode(ids) for ids in column(b, "_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(b, "row"), pa.array(texts, pa.string())], ["row", "text"])
    return run


def decode(tokens: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """(row, text): the text of each array of ids; null ids have a null text."""
    rows = tokens.select(F.struct(*tokens.columns).alias("row"), F.col(ids_col).alias("_ids"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("text", T.StringType())])
    return rows.mapInArrow(_decoder(model_path), schema)
