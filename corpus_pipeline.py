"""From raw documents to training sequences: five stages, each written as Parquet and read again as the next one's input.

All stages but the last return the columns of the table they get; rows only leave it by the stage's decision."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from tidemark.llm.common import join_ids, materialize, table
from tidemark.llm.queries import word_tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.judge_quality(docs).where("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated or nearly repeated lines; a document that had words and has none left goes."""
    out = line_dedup.dedup_lines(docs)
    out = out.where((F.col("n_lines_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of linked texts. Documents without an id stay."""
    groups = jaccard_join.jaccard_groups(docs)
    gone = materialize(groups.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return join_ids(docs, gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences, with their ids."""
    return packing.pack(docs, word_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("line dedup", lines), ("n-gram jaccard join", near_copies), ("benchmark decontamination", benchmark_leaks), ("packing", sequences),
]

#: No SQL: expectation-maximisation, SimHash, latent retrieval and the tokenizer have none; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
