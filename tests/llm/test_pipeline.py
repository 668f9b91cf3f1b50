"""The pipeline on a small folder, stage by stage, against plain Python."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from small_corpus import text_of  # noqa: E402
from test_lines_shards import key  # noqa: E402
from test_minhash import expected  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PASSAGE = "seven wonders of ancient stone remained hidden under the river while people walked past in silence"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = text_of("en", 120, 1)
    near = base.split()
    near[60] = "changed"
    rows = [(1, base, "en"), (2, base, "en"), (3, " ".join(near), "en"), (4, None, "en"), (5, "", "de"), (6, "12 | 34", "en"),
            (7, text_of("en", 40, 3) + "\n" + PASSAGE + "\n" + text_of("en", 40, 4), "en"),
            (8, "one shared line for all\n" + text_of("de", 60, 5), "de"), (9, "One Shared line for all \n" + text_of("de", 60, 6), "de"),
            (10, "one shared line for all", "en"), (None, text_of("fr", 50, 7), "fr"), (None, "", None)]
    rows += [(100 + i, text_of(lang, 60 + i, 20 + i), lang) for i in range(45) for lang in [["en", "de", "fr"][i % 3]]]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(d, t, lang, "s", None if t is None else len(t)) for d, t, lang in rows],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, tables[-1], folder)
        assert out.columns == COLUMNS and out.schema == docs.schema, name
        tables.append(out.cache())
    rows = [[(r["doc_id"], r["text"]) for r in t.select("doc_id", "text").collect()] for t in tables]
    order = lambda xs: sorted(xs, key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))

    # language: texts without a letter go, the others stay
    assert order(rows[1]) == order([(d, t) for d, t in rows[0] if any(c.isalpha() for c in t or "")])
    # lines
    low = {}
    for d, t in rows[1]:
        for x in t.split("\n"):
            if d is not None and len(key(x)) >= 10:
                low[key(x)] = min(low.get(key(x), d), d)
    assert order(rows[2]) == order([(d, "\n".join(x for x in t.split("\n") if d is None or low.get(key(x), d) == d)) for d, t in rows[1]])
    assert (10, "") in rows[2]                               # emptied, but still a document
    assert tables[2].where(F.col("n_chars") != F.length("text")).count() == 0
    # near duplicates
    keep = {d for d, _, c in expected(rows[2], 5) if d == c}
    assert order(rows[3]) == order([(d, t) for d, t in rows[2] if d is None or d in keep])
    assert 3 not in {d for d, _ in rows[3]} and (2, "") in rows[3] and None in {d for d, _ in rows[3]}
    # benchmark passage
    assert order(rows[4]) == order([(d, t) for d, t in rows[3] if d != 7])


def test_run_ends_with_ids(spark, folder):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert out[1]["ids"] == sp.encode(text_of("en", 120, 1)) and out[10]["ids"] == [] and all(r["round_trip"] for r in out.values())
    assert out[9]["ids"] == sp.encode(text_of("de", 60, 6)) and not {3, 4, 5, 6, 7} & set(out)


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_shape_of_the_module():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None
