"""One delivered file with one header, and folder layout by volume."""

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from patronage.plans import extracts
from patronage.plans.registry import fixture_params
from patronage.sources.sinks import write_file
from patronage.sources.testdata import testdata_tables as derive_tables
from patronage.sources.warehouse import store_tables
from patronage.tables import Tables

ROWS = [(1, " Smith"), (2, "First "), (3, 'Jo "JJ" Lee'), (4, "a,b"), (5, "two\nlines"), (6, None), (7, '"'), (8, "back\\slash"),
        (9, "\u00e9\u4f60")]


def read(path):
    with open(path, newline="", encoding="utf-8") as fh:
        return list(csv.reader(fh))


def test_values_and_order_survive_in_one_file(spark, tmp_path):
    path = str(tmp_path / "f.csv")
    df = spark.createDataFrame(ROWS * 40, "k int, `the value, all` string").repartitionByRange(7, "k").sortWithinPartitions("k")
    write_file(df, path)
    header, *rows = read(path)
    assert header == ["k", "the value, all"]
    assert [(int(k), v or None) for k, v in rows] == [r for r in ROWS for _ in range(40)]
    # nothing is left beside it, and a second run replaces the file
    write_file(df.where("k = 4"), path)
    assert read(path)[1:] == [["4", "a,b"]] * 40
    assert os.listdir(tmp_path) == ["f.csv"]
    assert spark.read.option("header", True).csv(path).count() == 40


def test_an_empty_extract_is_its_header(spark, tmp_path):
    write_file(spark.createDataFrame([], "a int, b string"), str(tmp_path / "f.csv"))
    assert read(tmp_path / "f.csv") == [["a", "b"]]


def test_a_failed_run_leaves_the_old_file(spark, tmp_path):
    path = str(tmp_path / "f.csv")
    write_file(spark.range(3).toDF("a"), path)
    with pytest.raises(Exception):
        write_file(spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("a")), path)
    assert read(path) == [["a"], ["0"], ["1"], ["2"]]
    assert [f for f in os.listdir(tmp_path) if not f.endswith(".crc")] == ["f.csv"]


def test_a_file_system_without_joining_is_refused(spark):
    with pytest.raises(Exception):
        write_file(spark.range(1), "ftp://nowhere/f.csv")


def test_affiliation_file_is_sorted_by_id(spark, tmp_path):
    t = derive_tables(spark, "/root/testdata/sf0.001")
    df = extracts.affiliation_extract(t, fixture_params(t))
    write_file(df, str(tmp_path / "a.csv"))
    header, *rows = read(tmp_path / "a.csv")
    assert header == df.columns
    assert [[v or None for v in r] for r in rows] == [list(r) for r in df.collect()]
    ids = [r[0] for r in rows]
    assert ids == sorted(ids) and len(ids) > 100


def test_a_large_folder_is_written_by_as_many_tasks_as_it_fills(spark, tmp_path):
    """A third of the rows in one campaign; the others are many and small."""
    i = F.col("id")
    facts = spark.range(0, 120_000, 1, 16).select(
        F.when(i % 3 == 0, F.lit(1)).otherwise(i % 40 + 2).cast("int").alias("campaign_key"),
        F.sha2(i.cast("string"), 256).alias("gift_number"), F.lit(1).cast("decimal(14,2)").alias("credit_amount"))
    t = Tables({"adv_hh_giving_f": lambda: facts})
    # more partitions than folders, as on a cluster: few folders share the hot one's
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 10), "spark.sql.shuffle.partitions": "200"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        store_tables(t, str(tmp_path), names=("adv_hh_giving_f",))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = {k: len(glob.glob(f"{tmp_path}/adv_hh_giving_f/campaign_key={k}/*.parquet")) for k in range(1, 42)}
    # 40,000 rows of about 70 bytes in tasks of 256 KB
    assert 6 <= files[1] <= 16, files
    assert sum(files[k] for k in range(2, 42)) <= 40 * 2, files
    back = spark.read.parquet(f"{tmp_path}/adv_hh_giving_f")
    assert back.select(facts.columns).exceptAll(facts).count() == 0 and back.count() == 120_000
