"""The corpus pipeline: documents through the stages below, each one's rows written and read again for the next.

Rows with a null doc_id cannot be told apart by joins; they pass the stages that drop documents by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm.decontam import benchmark_overlaps
from reelstat.llm.jaccard import jaccard_classes
from reelstat.llm.lines import without_repeated_lines
from reelstat.llm.packing import pack, token_pieces
from reelstat.llm.storage import Scratch, materialise
from reelstat.llm.toxicity import without_toxic

TOKENIZER = "word_bpe_49k.json"
#: Documents of a sequence at most; more of them attend to little beside themselves.
DOCUMENTS = 32


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, learned from ``labels``, calls toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that equal one kept elsewhere, up to a few edits, are cut; documents left without a word by that go."""
    return without_repeated_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies (five-word shingles, similarity 0.8 or more): the document with the smallest doc_id of each group stays."""
    classes = jaccard_classes(docs)
    return docs.join(classes.where("doc_id <> component_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a verified overlap with a benchmark item go."""
    found = benchmark_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 2048 tokens and ``DOCUMENTS`` documents."""
    import public_tokenizers

    pieces = token_pieces(docs, public_tokenizers.path(TOKENIZER))
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "task", "rank")
    with Scratch(spark) as scratch:
        return pack(scratch.keep(digests, "pieces"), documents=DOCUMENTS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the learned model, the edit join or the tokenizer; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.keep(stage(spark, docs, sf_dir), name)
            scratch.drop(keep=1)
        return materialise(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
