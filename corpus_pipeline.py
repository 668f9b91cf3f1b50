"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next stage's documents.  All but the last return the
columns of ``documents``.  A row is found again by its id and its text's hash, so
null ids are safe; repeated rows (same id and text) stay or go together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import langid
from tabforge.llm.common import materialize
from tabforge.llm.decontaminate import contaminated
from tabforge.llm.line_dedup import line_dedup
from tabforge.llm.minhash_dedup import near_duplicates
from tabforge.llm.sp_trie import encode

MIN_SCORE = 0.5      # a calibrated probability below this names no language


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows named by (doc_id, text_hash) in ``gone``."""
    g = gone.select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash"))
    return docs.join(g, docs["doc_id"].eqNullSafe(g["_gone_id"]) & (F.xxhash64(docs["text"]) == g["_gone_hash"]), "left_anti")


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; texts without letters and undecided ones go."""
    known = langid.predict(docs, langid.train(docs))
    return known.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; none goes, even if no line is left."""
    out = line_dedup(docs, info_col="_lines")
    text = F.when(F.col("text").isNotNull(), F.col("_lines.kept"))
    return (out.withColumn("n_chars", F.when(F.col("_lines.n_dropped") > 0, F.char_length(text).cast("bigint")).otherwise(F.col("n_chars")))
            .withColumn("text", text).select(*docs.columns))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near duplicates (five-word shingles, 0.8)."""
    return without(docs, near_duplicates(docs, width=5, percent=80).where("NOT kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without(docs, contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they decode to its text."""
    out = encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), check=True, keep=["doc_id"])
    return out.select("row.doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded_crc32", "round_trip")


STAGES = [("language_id", identify), ("line_dedup", dedup_lines), ("near_dedup", dedup_near),
          ("decontamination", decontaminate), ("sentencepiece", tokenize)]

#: Language ID, MinHash components and piece encoding have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
