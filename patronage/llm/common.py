"""Shared helpers of the operators.

Conventions for all of them: only the id and text columns of the input are
read (``ids_and_text``), so extra columns can never clash with an operator's
own; a null text counts as empty unless an operator says otherwise; a null id
is an id like any other and hashes as the empty text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 20
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 empty: bool = True) -> DataFrame:
    """(doc_id long, text string); null texts become empty if ``empty``."""
    text = F.coalesce(F.col(text_col), F.lit("")) if empty else F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def fold(id_col: str | Column, mod: int) -> Column:
    """crc32(id as text) mod ``mod``; a null id hashes as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % F.lit(mod)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run in here drop their shuffle files when they end, as their
    result is kept and nothing reads the files again."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def bounded_batches(spark: SparkSession) -> None:
    """Long texts go to Python workers in batches of few bytes instead of
    10,000 rows, unless the session has a bound."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def again(df: DataFrame) -> DataFrame:
    """The same rows planned anew, under the settings of now."""
    return df.select("*")


def cut(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder and cut the lineage:
    a later loss of an executor rereads files instead of recomputing."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return again(df).checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like ``cut`` for large results: a Parquet table in the shared folder,
    compressed and read by column."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        again(df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_col: str | Column, *parts: Column) -> Column:
    """One text that names a row: its id and what tells its text from others."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.concat_ws(":", F.coalesce(c.cast("long").cast("string"), F.lit("null")), *[p.cast("string") for p in parts])


def rows_with(docs: DataFrame, keys: DataFrame, key: Column, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``key`` is among
    ``keys`` (one column); of rows with one key that with the smallest text
    stays. Rows are shuffled once, by key."""
    row = docs.select(F.struct("*").alias("row"), key.alias("k"), F.col(text_col).alias("t"))
    row = row.join(keys.toDF("k").distinct(), "k", "left_semi").groupBy("k").agg(F.min_by("row", F.coalesce("t", F.lit(""))).alias("row"))
    return row.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(texts: list[str], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` characters, at least one row
    each, so that a batch's temporary arrays stay small."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, in
    UTF-8 (bytes.lower and bytes.split touch ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def binary_array(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def sorted_runs(key: np.ndarray) -> np.ndarray:
    """Start of each run of equal values, with the length at the end."""
    if not len(key):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
