"""Read the real warehouse tables by name."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from patronage.tables import TABLE_NAMES, Tables


def warehouse_tables(spark: SparkSession, location: str | None = None,
                     database: str | None = None, fmt: str = "parquet") -> Tables:
    """Tables from a catalog database (``spark.table``) or from
    ``{location}/{name}`` files. Nothing is read until an extract runs, and
    every scan is pruned to the columns and rows the extract uses."""
    if (location is None) == (database is None):
        raise ValueError("give exactly one of location or database")

    def loader(name: str):
        if database is not None:
            return lambda: spark.table(f"{database}.{name}")
        return lambda: spark.read.format(fmt).load(f"{location}/{name}")

    return Tables({name: loader(name) for name in TABLE_NAMES})


# Folders by the columns that queries fix or join a filtered code table on: a
# fiscal-year literal prunes the snapshot and the non-annual-fund tests; the
# list of annual-fund campaigns of the wanted years, a small filtered
# dimension, prunes the three facts when the query runs.
PARTITIONS: dict[str, tuple[str, ...]] = {
    "adv_donor_behavior_ps": ("fiscal_year",),
    "adv_hh_giving_f": ("campaign_key",),
    "adv_credit_f": ("fiscal_year", "campaign_key"),
    "adv_pledge_install_f": ("install_fiscal_year", "campaign_key"),
}


def store_tables(tables: Tables, location: str, partition_by: dict[str, tuple[str, ...]] | None = None,
                 names: tuple[str, ...] = TABLE_NAMES) -> None:
    """Write tables as ``{location}/{name}`` parquet folders (the layout
    ``warehouse_tables`` reads), the partitioned ones gathered by folder first
    so that a folder does not get a file from every task.

    How many tasks write a folder follows from its measured volume: the rows
    are rebalanced by folder, and adaptive execution cuts a folder's shuffled
    bytes into as many tasks of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    as they fill and puts small folders together. A year or campaign with a
    third of all rows is written by a third of the tasks."""
    parts = PARTITIONS if partition_by is None else partition_by
    for name in names:
        df = tables[name]
        if name not in parts:
            df.write.mode("overwrite").parquet(f"{location}/{name}")
            continue
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
            raise ValueError("store_tables needs spark.sql.adaptive.enabled: a large folder would be one task")
        (df.hint("rebalance", *[F.col(c) for c in parts[name]]).write.mode("overwrite").partitionBy(*parts[name])
         .parquet(f"{location}/{name}"))
