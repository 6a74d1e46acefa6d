"""A corpus cleaning pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.llm.decontaminate import drop_leaks
from tallybook.llm.near_dups import drop_near_duplicates
from tallybook.llm.packing import pack
from tallybook.llm.pii import redact
from tallybook.llm.quality_rules import keep_good
from tallybook.llm.queries import tokenizer_path
from tallybook.llm.scratch import keep

# The stages train models and tokenise, which SQL cannot express; tests check each of them.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep, with all their columns.

    Null and empty texts are too short and go; long texts are judged whole. Repeated rows, and rows
    that tie in all measures, stay or go together. An empty table gives no rows.
    """
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, with all its columns.

    Of a group the row of the least doc_id stays, null last, and of rows that share an id the first as
    they are numbered. All null, empty and blank texts are one group; long texts are compared whole. An
    empty table gives no rows.
    """
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item, with all their columns.

    Null and empty texts repeat nothing and stay, as all do where the benchmark is empty. Every place of a
    long text counts. Repeated rows stay or go together. An empty table gives no rows.
    """
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; every row stays, with all its columns.

    A null text stays null and an empty one empty; long texts are searched whole. Repeated rows change
    alike; spans of equal start go in the order of their kinds. An empty table gives no rows.
    """
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, placed in sequences; the last stage, with columns of its own.

    A null or empty text is one end token; long texts are cut over several sequences. Repeated rows are
    each packed; which of equal pieces goes where is settled by their order of id and start. An
    empty table gives no rows.
    """
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written once and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
