"""Corpus pipeline: quality, exact copies, near copies, repeated passages, packing.

Each stage reads all rows its predecessor kept and, but for the last, returns
the columns of documents:

* quality: rows that the classifier rejects go (null texts are scored as empty);
* exact dedup: of equal texts the longest original, then smallest doc_id, stays;
* SimHash: the smallest doc_id of each group of near copies stays;
* substring: words of passages that a smaller doc_id has go, and rows left
  without words; ``n_chars`` follows the text;
* packing: the pieces of what is left.

Rows that repeat id and text are left once by the dedup stages; null texts,
empty tables and further columns pass through as the operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.llm.common import table, written
from patronage.llm.exact_dedup import without_copies
from patronage.llm.packing import digest, pack
from patronage.llm.quality import TRAIN, accepted, learn
from patronage.llm.simhash import without_near_copies
from patronage.llm.substring import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, learn(docs, table(spark, sf_dir, "labels"), TRAIN))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_copies(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest(pack(docs))


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("simhash", simhash), ("substring", substring), ("packing", packing)]

#: SQL expresses neither a fitted classifier nor the passages; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet to the shared
    folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
