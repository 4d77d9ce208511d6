"""A training-data corpus from documents: quality rules, line dedup, near-duplicate removal, decontamination, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyspark.llm.bpe import default_path, op9_columns
from canopyspark.llm.decontamination import decontaminated
from canopyspark.llm.line_dedup import line_dedup
from canopyspark.llm.ngram_join import near_duplicates_removed
from canopyspark.llm.quality import quality_kept
from canopyspark.llm.shared import Scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the limits and the trees; the trees are fitted on labelled documents of the table given."""
    return quality_kept(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that are boilerplate of its source."""
    kept = line_dedup(docs).drop("n_lines", "n_dropped")
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return near_duplicates_removed(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return op9_columns(docs, default_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_join_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]
#: Trees and BPE aren't SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written as Parquet in the shared folder and read again; a stage's table goes when the next one is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            held = Scratch(spark, f"pipeline-{name}")
            docs = held.written(docs, "kept")
            if last:
                last.drop()
            last = held
    return docs
