"""``row_number`` whose tasks stay bounded whatever group or key is hot.

(Skewed joins are handled by adaptive execution's skew-join splitting, or,
where the many side of a LEFT JOIN may be hot, by ``operators.attach``.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.session import written

# Sampled rows for each wanted range; every one of these many becomes a cut.
SAMPLED_PER_CUT = 64


def _sortable(cols: list[str]) -> Column:
    """A struct that compares as ``ORDER BY cols ASC NULLS LAST`` does."""
    return F.struct(*[part for i, c in enumerate(cols)
                      for part in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])


def _with_range(df: DataFrame, order_cols: list[str], most: int) -> DataFrame:
    """Adds ``__range``: how many entries of the sorted array ``__cuts`` (null:
    none) are at or before the row, by halving steps. Each step is a projection
    of its own, so the search is compiled code and the row's key is built once."""
    df = df.withColumn("__key", F.when(F.col("__cuts").isNotNull(), _sortable(order_cols))).withColumn("__range", F.lit(0))
    for b in range(most.bit_length(), -1, -1):
        further = F.get("__cuts", F.col("__range") + ((1 << b) - 1)) <= F.col("__key")
        df = df.withColumn("__range", F.col("__range") + F.when(further, 1 << b).otherwise(0))
    return df.drop("__key")


def numbered(df: DataFrame, partition_col: str | None, order_cols: list[str], out: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY p ORDER BY o1, o2, ...)`` (ascending,
    NULLs last; no ``p``: over all rows), one path at every size.

    Sampled cut points divide the rows, sorted by (p, order), into even
    ranges. A cut lies inside one ``p``; only a ``p`` that holds cuts straddles
    ranges, and its rows find theirs by a search among its own cuts. Each
    (p, range) is numbered by one window task of bounded size, and only the
    straddling ones (at most one per cut) have an offset. The rows are written
    once, so all passes see the same tie order, and shuffled once; the passes
    for cuts and offsets read the key columns only.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(df.withColumn("__row", F.monotonically_increasing_id()))
    order_cols = [*order_cols, "__row"]
    key = F.col(partition_col) if partition_col else F.lit(0)
    every = max(1, rows.count() // (ranges * SAMPLED_PER_CUT))
    sample = (rows.where(F.pmod(F.xxhash64("__row"), F.lit(every)) == 0)
              .select(key.alias("__p"), _sortable(order_cols).alias("__o")))
    # of bounded size: a fixed number of sampled rows per range
    place = F.row_number().over(Window.orderBy(F.col("__p").asc_nulls_last(), "__o"))
    cuts = sample.withColumn("__at", place).where(F.col("__at") % SAMPLED_PER_CUT == 0)
    listed = F.sort_array(F.collect_list("__o")).alias("__cuts")
    if partition_col:
        with_cuts = rows.join(F.broadcast(cuts.groupBy("__p").agg(listed)), key.eqNullSafe(F.col("__p")), "left").drop("__p")
    else:
        with_cuts = rows.withColumn("__cuts", cuts.agg(listed).scalar())
    split = _with_range(with_cuts, order_cols, 4 * ranges)
    group = [F.col(partition_col)] if partition_col else []
    counts = (split.where(F.col("__cuts").isNotNull()).groupBy(key.alias("__p"), F.col("__range").alias("__r"))
              .agg(F.count(F.lit(1)).alias("__n")))
    before = Window.partitionBy("__p").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", "__r", F.sum("__n").over(before).alias("__off"))
    local = F.row_number().over(Window.partitionBy(*group, "__range").orderBy(*[F.col(c).asc_nulls_last() for c in order_cols]))
    same = F.col("__range") == F.col("__r")
    return (split.drop("__cuts").withColumn("__local", local)
            .join(F.broadcast(offsets), same & key.eqNullSafe(F.col("__p")) if partition_col else same, "left")
            .withColumn(out, F.col("__local") + F.coalesce("__off", F.lit(0)))
            .drop("__row", "__range", "__local", "__off", "__p", "__r"))
