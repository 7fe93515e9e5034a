"""From documents to packed training sequences: clean, dedupe, decontaminate, pack.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept, and returns
the rows it keeps with the columns they came with; the last one returns the packed pieces.
Empty tables pass through as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import decontaminate, exact, packing, simhash, toxicity
from shelfline.llm.common import stage
from shelfline.llm.queries import read, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text the network, learned from ``labels``, does not reject."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each text."""
    return exact.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces with their places in training sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None  # the network and the tokenizer are not expressible in SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
