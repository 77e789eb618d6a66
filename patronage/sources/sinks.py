"""Write an extract as the flat file the receiving system loads.

``write_extract`` writes a folder of part files, ``write_file`` one file with
one header. Both are written by all tasks; nothing passes through the driver
or through one task.
"""

from __future__ import annotations

import csv
import io
import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Bytes that a task copies at once.
CHUNK = 8 << 20


def _plain_decimals(df: DataFrame) -> DataFrame:
    """Decimals in plain digits (the writer would give a zero as 0E-10)."""
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def _write_csv(df: DataFrame, path: str, mode: str, header: bool) -> None:
    (_plain_decimals(df).write.mode(mode).option("header", header).option("nullValue", "").option("emptyValue", "")
     # values as they are: blanks kept, quotes doubled
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("quote", '"').option("escape", '"').csv(path))


def write_extract(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """CSV with a header row (the delivery format) or parquet.

    The write is distributed: one file per partition, no driver collection.
    NULL is written as an empty field, which is how the source system's
    export represents its empty strings.
    """
    if fmt == "csv":
        _write_csv(df, path, mode, header=True)
    elif fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def _header(names: list[str]) -> bytes:
    line = io.StringIO()
    csv.writer(line, lineterminator="\n").writerow(names)
    return line.getvalue().encode("utf-8")


def _copy_ranges(target: str):
    """Writes each part into its own range of the target; doing it twice
    gives the same bytes, so a lost task is simply repeated."""
    def run(batches):
        for b in batches:
            for source, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with open(source, "rb") as part, open(target, "r+b") as out:
                    out.seek(at)
                    while chunk := part.read(CHUNK):
                        out.write(chunk)
            yield b
    return run


def write_file(df: DataFrame, path: str) -> None:
    """One CSV file with one header row, the rows in ``df``'s order (that of
    its partitions, so a sorted extract is a sorted file). An existing file is
    replaced when the new one is complete.

    All tasks write headerless parts to a folder beside the target. Where the
    file system joins files by itself (HDFS) the parts are moved together; on
    a shared file path each part is copied into its own byte range of the
    target, all at once. Object stores offer neither: deliver parts there.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    scheme = fs.getUri().getScheme()
    if scheme not in ("file", "hdfs"):
        raise ValueError(f"one file cannot be joined from parts on {scheme}: write a folder of parts instead")
    staging = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    try:
        parts_dir = jvm.org.apache.hadoop.fs.Path(staging, "parts")
        _write_csv(df, parts_dir.toString(), "errorifexists", header=False)
        # the number in a part's name is its partition's: their order is the rows'
        parts = [s for s in fs.listStatus(parts_dir) if s.getPath().getName().startswith("part-") and s.getLen()]
        parts.sort(key=lambda s: int(s.getPath().getName().split("-")[1]))
        found = [(s.getPath().toString(), s.getLen()) for s in parts]
        whole = jvm.org.apache.hadoop.fs.Path(staging, "whole")
        if scheme == "file":
            _join_on_shared_path(spark, whole.toUri().getPath(), _header(df.columns), found)
            # a checksum beside an older file is not this file's
            fs.delete(fs.getChecksumFile(target), False)
            os.replace(whole.toUri().getPath(), target.toUri().getPath())
        else:
            _join_in_file_system(spark, fs, whole, target, _header(df.columns), found)
    finally:
        fs.delete(staging, True)


def _join_in_file_system(spark: SparkSession, fs, whole, target, header: bytes, parts: list[tuple[str, int]]) -> None:
    """The file system appends the parts' blocks to the header; no data moves."""
    hadoop, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    out = fs.create(whole)
    out.write(header)
    out.close()
    if parts:
        array = gateway.new_array(hadoop.Path, len(parts))
        for i, (p, _) in enumerate(parts):
            array[i] = hadoop.Path(p)
        fs.concat(whole, array)
    option = gateway.new_array(hadoop.Options.Rename, 1)
    option[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(whole, target, option)


def _join_on_shared_path(spark: SparkSession, whole: str, header: bytes, parts: list[tuple[str, int]]) -> None:
    """Copies the parts, as many tasks as parts, behind the header."""
    ranges, at = [], len(header)
    for uri, size in parts:
        ranges.append((spark._jvm.org.apache.hadoop.fs.Path(uri).toUri().getPath(), at))
        at += size
    with open(whole, "wb") as out:
        out.write(header)
        out.truncate(at)
    if ranges:
        rows = spark.createDataFrame(ranges, "source string, at long").repartition(len(ranges), "at")
        done = rows.mapInArrow(_copy_ranges(whole), "source string, at long").count()
        if done != len(ranges):
            raise OSError(f"{done} of {len(ranges)} parts were copied to {whole}")
