"""Registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import line_dedup as lines
from tabforge.llm import phrase_mining as mining
from tabforge.llm.common import documents

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_minhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on 2-word shingles at 0.8."""
    from tabforge.llm.minhash_dedup import near_duplicates
    return near_duplicates(documents(spark, sf_dir), width=2, percent=80)


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents; three quarters of them are the training set."""
    from tabforge.llm import langid
    docs = documents(spark, sf_dir).withColumn("_held", langid.held_out(F.col("doc_id")))
    model = langid.train(docs.where(~F.col("_held")))
    out = langid.predict(docs.select("doc_id", "_held", "text"), model)
    return out.select("row.doc_id", F.col("row._held").alias("held_out"), "lang_pred", "score")


@query("op3_histogram_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes."""
    from tabforge.llm.histogram_shards import shard_by_bytes
    return shard_by_bytes(documents(spark, sf_dir), shards=8)


@query("op4_token_frames")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to seekable files and read back."""
    import public_tokenizers
    from tabforge.llm.token_frames import read_tokens, write_tokens
    from tabforge.session import scratch_path
    files = write_tokens(documents(spark, sf_dir), scratch_path(spark, "tokens"),
                         public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_tokens(spark, files, digest=True)


@query("op5_sentencepiece")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of all documents, decoded again."""
    import public_tokenizers
    from tabforge.llm.sp_trie import encode
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = encode(docs, public_tokenizers.path("piece_bpe_32k.model"), check=True, keep=["doc_id"])
    return out.select("row.doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded_crc32", "round_trip")


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    from tabforge.llm.license_scan import scan
    return scan(documents(spark, sf_dir))


@query("op7_line_dedup", lines.ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents without those that an earlier document holds."""
    out = lines.line_dedup(documents(spark, sf_dir), min_chars=10, min_docs=2)
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped",
                      F.sha2(F.col("line_dedup.kept").cast("binary"), 256).alias("kept_sha256"))


@query("op8_maxent_lm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and maximum-entropy scores of all documents; four fifths of them are the training set."""
    from tabforge.llm.langid import held_out
    from tabforge.llm.maxent_lm import score_texts
    return score_texts(documents(spark, sf_dir), held_out(F.col("doc_id"), buckets=5, bucket=1))


@query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that leaked into any document."""
    from tabforge.llm.decontaminate import contaminated
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op10_multi_index")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector."""
    from tabforge.llm.multi_index import neighbours
    return neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op11_lockstep_align")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over all documents."""
    import public_tokenizers
    from tabforge.llm.lockstep_align import align
    out = align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")


@query("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by their nearest labelled texts; two thirds of the labelled ones are the training set."""
    from tabforge.llm import toxicity
    from tabforge.llm.langid import held_out
    docs = documents(spark, sf_dir).select("doc_id", "text", held_out(F.col("doc_id"), buckets=3, bucket=1).alias("held_out"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs.where("NOT held_out"), labels, docs)
    out = toxicity.predict(docs, model, keep=["doc_id", "held_out"])
    return out.select("row.doc_id", "row.held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "nearest", "terms")


@query("op13_phrase_mining", mining.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of two and three words of each language in all documents."""
    return mining.collocations(documents(spark, sf_dir), max_words=3, min_count=10, share=50, top=2000)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
