"""The registered queries of this subpackage: each applies one operator to a whole table with production parameters."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.jaccard import jaccard_classes

    return jaccard_classes(_table(spark, sf_dir, "documents"), k=3, threshold=Fraction(9, 10))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.rules import judged

    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged(_table(spark, sf_dir, "documents")).select("doc_id", *base, "base_failed", "kept", "quality")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.lines import repeated_lines

    return repeated_lines(_table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.decontam import benchmark_overlaps

    return benchmark_overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.quality import scored_quality

    return scored_quality(_table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from reelstat.llm.packing import pack, token_pieces
    from reelstat.llm.storage import Scratch

    pieces = token_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "task", "rank")
    with Scratch(spark) as scratch:
        return pack(scratch.keep(digests, "pieces")).withColumn("length", F.col("length").cast("long"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.warc import archived

    return archived(_table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.toxicity import graded

    return graded(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.langid import identified

    return identified(_table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 3 == 1)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.ctw import scored

    return scored(_table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.codes import compressed

    codes, books = compressed(_table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.merkle import manifest, without_breaks

    docs = _table(spark, sf_dir, "documents")
    found = manifest(docs, without_breaks(docs))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelstat.llm.sharding import sharded

    text = F.coalesce("text", F.lit(""))
    digests = {"size": F.octet_length(text).cast("long") + 1, "text_crc32": F.crc32(text)}
    docs = _table(spark, sf_dir, "documents").withColumns(digests)
    found = sharded(docs, 8, keep=["doc_id", "size", "text_crc32"])
    law = {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    return found.withColumns(law)


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_line_dedup, op3_benchmark_decontamination, op4_quality_classifier, op5_best_fit_packing, op6_ngram_jaccard_join, op7_warc, op8_toxicity, op9_language_id, op10_lm_scoring, op11_vector_codes, op12_merkle_manifest, op13_sharding)}
