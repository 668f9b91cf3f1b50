"""Token frames and SentencePiece against the libraries themselves."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def pieces():
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=PIECES)


def test_frames_round_trip(spark, edge, tokenizer, tmp_path, monkeypatch):
    from tabforge.llm import token_frames as TF
    files = TF.write_tokens(edge, f"file://{tmp_path}/tokens", WORD_BPE)
    back = TF.read_tokens(spark, files).collect()
    rows = sorted(((r["doc_id"], r["text"] or "") for r in edge.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    ids = {(d, t): tokenizer.encode(t, add_special_tokens=False).ids + [1] for d, t in rows}
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], list(np.array(r["ids"], np.uint32))) for r in back) == \
        sorted((-1 if d is None else d, ids[d, t]) for d, t in rows)
    # ascending ids, each start after all documents before it
    at = 0
    for r in sorted(back, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in sorted(back, key=lambda r: r["start"])]
    assert order == sorted(order)
    digest = {(r["start"], r["n_tokens"], r["ids_crc32"]) for r in TF.read_tokens(spark, files, digest=True).collect()}
    assert digest == {(r["start"], r["n_tokens"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in back}
    got = {}
    for f in files:
        got |= TF.fetch(f["path"], [8, 9])
    assert got[8].tolist() == [x for (d, _), x in ids.items() if d == 8][0] and len(got) == 2


def test_frames_empty(spark, no_docs, tmp_path):
    from tabforge.llm import token_frames as TF
    files = TF.write_tokens(no_docs, f"file://{tmp_path}/tokens", WORD_BPE)
    assert files == [] and TF.read_tokens(spark, files, digest=True).count() == 0


def test_frames_are_checked_and_apart(tmp_path, monkeypatch):
    import zstandard
    from pyarrow import fs
    from tabforge.llm import token_frames as TF
    monkeypatch.setattr(TF, "FRAME_BYTES", 64)
    path = f"{tmp_path}/x.zst"
    docs = [(None, np.arange(3)), (2, np.arange(100)), (3, np.arange(0)), (4, np.arange(16))]
    with fs.LocalFileSystem().open_output_stream(path, compression=None) as sink:
        w = TF.FrameWriter(sink)
        for d, x in docs:
            w.add(d, x.astype(np.uint32))
        w.close()
    raw = open(path, "rb").read()
    # each frame is whole in itself for any zstandard reader, and the file ends with the seek table's magic number
    assert raw[-4:] == (0x8F92EAB1).to_bytes(4, "little")
    reads = []

    class Source:
        def __init__(self, data):
            self.data, self.at = data, 0

        def size(self):
            return len(self.data)

        def seek(self, at):
            self.at = at

        def read(self, n):
            reads.append((self.at, n))
            return self.data[self.at:self.at + n]

    r = TF.FrameReader(Source(raw))
    single = [zstandard.ZstdDecompressor().decompress(raw[a:b]) for a, b in zip(r.starts, r.starts[1:])]
    assert b"".join(single) == b"".join(x.astype("<u4").tobytes() for _, x in docs) and len(single) == 1 + 7 + 1 + 1
    assert [r.doc_id(i) for i in range(4)] == [None, 2, 3, 4] and r.tokens().tolist() == [3, 100, 0, 16]
    reads.clear()
    assert np.frombuffer(r.raw(3), "<u4").tolist() == list(range(16)) and len(reads) == 1
    bad = bytearray(raw)
    bad[r.starts[0] + 9] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        TF.FrameReader(Source(bytes(bad))).raw(0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abEÉ'’sſtİΣσ̈ \t\n\x0b\x1c\xa0　|<>_1२…中"), max_size=30), min_size=1, max_size=4))
def test_words_encode_like_whole_texts(texts):
    import pyarrow as pa
    from tabforge.llm.token_frames import WordEncoder
    enc = test_words_encode_like_whole_texts.__dict__.setdefault("enc", WordEncoder(WORD_BPE, remembered=50))
    ids, off = enc(pa.array(texts))
    assert [ids[off[i]:off[i + 1]].tolist() for i in range(len(texts))] == \
        [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=25), st.text(alphabet=st.sampled_from("theaionrs ▁\n.,1éß"), max_size=40)), min_size=1, max_size=5))
def test_pieces_like_the_library(texts):
    from sentencepiece import SentencePieceProcessor
    from tabforge.llm import sp_trie
    m = sp_trie.model(PIECES)
    sp = test_pieces_like_the_library.__dict__.setdefault("sp", SentencePieceProcessor(model_file=PIECES))
    ids, off = m.encode(texts)
    for i, t in enumerate(texts):
        own = ids[off[i]:off[i + 1]].tolist()
        assert own == sp.encode(t)
        assert m.decode(own) == sp.decode(own)


def test_pieces_of_words_and_runs(pieces):
    from tabforge.llm import sp_trie
    m = sp_trie.model(PIECES)
    rng = random.Random(2)
    syllables = "tion ing er the an in re ed qu aux ß ung st ción ñ ☃ a b c".split()
    texts = [" ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 9))) for _ in range(200)) for _ in range(20)]
    texts += [" " * n + "x" + " " * n for n in range(1, 45)] + ["a" * n for n in range(1, 40)] + ["\n" * 5, "", None, "x" * 3000]
    ids, off = m.encode(texts)
    assert [ids[off[i]:off[i + 1]].tolist() for i in range(len(texts))] == [pieces.encode(t or "") for t in texts]


def test_decode_bytes_like_the_library(pieces):
    from tabforge.llm import sp_trie
    m = sp_trie.model(PIECES)
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randrange(8))]
        if 0 not in ids:
            assert m.decode(ids) == pieces.decode(ids)


def test_encode_query_on_edges(spark, edge, no_docs, pieces):
    from tabforge.llm.sp_trie import decode, encode
    out = encode(edge, PIECES, check=True)
    rows = out.collect()
    assert len(rows) == edge.count()
    for r in rows:
        assert r["ids"] == pieces.encode(r["row"]["text"] or "")
        assert r["round_trip"] == ("▁" not in (r["row"]["text"] or ""))
    back = decode(out.select("row.doc_id", "row.text", "ids", F.lit(1).alias("row")), PIECES).collect()
    assert all(b["text"] == pieces.decode(b["row"]["ids"]) for b in back)
    assert encode(no_docs, PIECES, check=True).count() == 0


def test_a_task_holds_a_few_megabytes_of_text(monkeypatch):
    """The words of a block are Python objects many times as large as their text, and the worker lives on."""
    from tabforge.llm import sp_trie
    import pyarrow as pa
    seen = []

    class Recorder:
        def encode(self, texts):
            seen.append(sum(map(len, texts)))
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)

    monkeypatch.setitem(sp_trie._MODELS, "recorder", Recorder())
    texts = ["word " * 600] * 4000
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(texts)], ["row", "_text"])
    assert sum(b.num_rows for b in sp_trie._coder("recorder", False)([batch])) == 4000
    assert sum(seen) == 4000 * 3000 and max(seen) < 3 << 20


def test_encode_leaves_out_columns(edge):
    from tabforge.llm import sp_trie
    whole, thin = sp_trie.encode(edge, PIECES), sp_trie.encode(edge, PIECES, keep=["doc_id"])
    assert thin.select("row.*").columns == ["doc_id"]
    key = lambda r: (r["row"]["doc_id"] is not None, r["row"]["doc_id"] or 0, list(r["ids"]))
    assert sorted(map(key, thin.collect())) == sorted(map(key, whole.collect()))
