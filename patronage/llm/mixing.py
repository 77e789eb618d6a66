"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source has a weight and a target number of words; no target is above
``most`` times the source's own words, the excess goes to the others by
weight. The mix is counted in blocks of equal length: sources get blocks by
the highest quotients votes / (2k - 1), a source's blocks go to its shards by
the same rule, and a shard lays its documents end to end in seeded order, cuts
that line into its blocks and takes each of them ``quota div blocks`` times,
some (a seeded choice) once more. A block is never taken more than ``most``
times, so no document is either.

Shards are parts of a source by a hash of the document, of about ``SHARD_ROWS``
rows, so a hot source is many tasks. The rounds of the apportionment are
aggregations over the sources or shards, of which the driver sees one number.

Defined results: null text has no words; a null source is a source, after all
others; rows equal in id, source and size lie next to each other and share
what their stretch takes evenly; documents without words are taken with 0
words; an empty table gives an empty result. A null id hashes as nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.common import cut, table, written
from patronage.operators.skew import numbered

WEIGHTS = (1, 2, 3)
MOST, BLOCK, SHARD_ROWS, SEED = 3, 32, 4096, 42
#: Seats still to settle by single quotients after the divisor is found, and rounds to find it.
NEAR, ROUNDS = 8, 30
#: A prime beyond any number of blocks of a shard: multiples of it visit every block.
STRIDE = 2654435761


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def with_targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``target`` to rows with ``source_size`` and ``weight``: shares of
    all words by weight, at most ``most`` times the size, the excess reshared
    until none is above. Exact whole numbers up to the last division."""
    size = F.col("source_size").cast("decimal(38,0)")
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    shared, per = int(total or 0), int(weights or 0)
    while True:
        full = size * F.lit(most) * F.lit(per) < F.lit(shared).cast("decimal(38,0)") * F.col("weight")
        capped, free = sources.agg(F.sum(F.when(full, size * most)), F.sum(F.when(~full, F.col("weight")))).first()
        now = (int(total or 0) - int(capped or 0), int(free or 0))
        if now == (shared, per) or not now[1]:
            break
        shared, per = now
    level = F.col("weight") * F.lit(float(shared)) / F.lit(float(max(per, 1)))
    return sources.withColumn("target", F.when(full, size.cast("double") * most).otherwise(level))


def apportion(parties: DataFrame, group: list[str], order: list[str], out: str = "quota") -> DataFrame:
    """Sainte-Lague within each ``group``: parties have ``votes`` (double), a
    ``ceiling`` of seats and the group's ``seats``; adds ``out``. A divisor
    that gives nearly all seats is found by rounds of aggregations, the last
    few go (or return) one by one by the quotients; ties go in ``order``."""
    def given(divisor: Column) -> Column:
        return F.least("ceiling", F.floor(F.col("votes") / divisor + 0.5)).cast("long")
    parties = cut(parties)
    divisors = cut(parties.select(*group).distinct().withColumn("divisor", F.lit(1.0)))
    for _ in range(ROUNDS):
        now = parties.join(divisors, group).withColumn("k", given(F.col("divisor")))
        state = now.groupBy(*group).agg(
            F.first("divisor").alias("divisor"), (F.first("seats") - F.sum("k")).alias("gap"),
            F.sum(F.when(F.col("k") < F.col("ceiling"), F.col("votes"))).alias("free"))
        wanted = F.col("free") / F.col("divisor") + F.col("gap")
        near = F.abs("gap") <= NEAR
        # a divisor moves by no more than half or double, in case the rest is far from even
        state = cut(state.withColumn("next", F.when(near | F.col("free").isNull() | (F.col("free") <= 0), F.col("divisor")).otherwise(
            F.when(wanted > 0, F.least(F.greatest(F.col("free") / wanted, F.col("divisor") / 2), F.col("divisor") * 2))
            .otherwise(F.col("divisor") * 2))))
        if not state.where((F.col("next") != F.col("divisor"))).head(1):
            break
        divisors = state.select(*group, F.col("next").alias("divisor"))
    now = parties.join(divisors, group).withColumn("k", given(F.col("divisor")))
    gaps = now.groupBy(*group).agg((F.first("seats") - F.sum("k")).alias("gap"))
    now = cut(now.join(gaps, group))
    most = now.agg(F.max(F.abs("gap"))).first()[0] or 0
    if not most:
        return now.withColumnRenamed("k", out).drop("divisor", "gap")
    # the seats that may come next (or go first), each with its quotient
    steps = F.explode(F.sequence(F.lit(1).cast("long"), F.abs("gap")))
    seat = F.when(F.col("gap") > 0, F.col("k") + F.col("step")).otherwise(F.col("k") - F.col("step") + 1)
    open_seats = (now.where("gap <> 0").withColumn("step", steps).withColumn("seat", seat)
                  .where("seat between 1 and ceiling")
                  .withColumn("rank", F.col("votes") / (2 * F.col("seat") - 1) * F.when(F.col("gap") > 0, -1).otherwise(1)))
    ties = [F.col(c).asc_nulls_last() if i else F.when(F.col("gap") > 0, F.col(c)).otherwise(-F.col(c)) for i, c in enumerate(order)]
    chosen = (open_seats.withColumn("n", F.row_number().over(Window.partitionBy(*group).orderBy("rank", *ties, "step")))
              .where(F.col("n") <= most).where("n <= abs(gap)")
              .groupBy(*group, *order).agg(F.sum(F.signum("gap")).cast("long").alias("moved")))
    return (now.join(chosen, [*group, *order], "left")
            .withColumn(out, F.col("k") + F.coalesce("moved", F.lit(0))).drop("divisor", "gap", "k", "moved"))


def div(a: Column, b: Column) -> Column:
    """Whole-number division."""
    return F.call_function("div", a, b)


def _blocks(words: Column, block: int) -> Column:
    """Blocks of a line: lengths differ by one word at most; any words are a block."""
    return F.when(words > 0, F.greatest(F.lit(1), F.round(words / block))).otherwise(0).cast("long")


def _taken() -> Column:
    """Words of the stretch [at, at + words) of a line of ``shard_words`` in
    ``blocks`` blocks that ``quota`` block choices take."""
    n, s, q, at, end = F.col("blocks"), F.col("shard_words"), F.col("quota"), F.col("at"), F.col("at") + F.col("words")

    def block_of(position: Column) -> Column:
        return div((position + 1) * n - 1, s)

    def start(i: Column) -> Column:
        return div(i * s, n)
    more = F.pmod(q, n)

    def add(sum_: Column, i: Column) -> Column:
        chosen = F.pmod(i * F.lit(STRIDE) + F.pmod(F.col("turn"), n), n) < more
        return sum_ + F.when(chosen, F.least(start(i + 1), end) - F.greatest(start(i), at)).otherwise(0)
    some = F.aggregate(F.sequence(block_of(at), block_of(end - 1)), F.lit(0).cast("long"), add)
    whole = div(q, n) * F.col("words")
    return F.when(F.col("words") == 0, 0).when(more == 0, whole).otherwise(whole + some).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, shard: one row per
    document. Sources in code point order take the ``weights`` in turn."""
    rows = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               word_count(F.col(text_col)).alias("size"))
                   .groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies")))
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"),
                                         F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("long").alias("shards"))
    turns = F.array(*[F.lit(w).cast("long") for w in weights])
    sources = cut(numbered(sources, None, ["source"], "place")
                  .withColumn("weight", F.get(turns, F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int"))))
    sources = cut(with_targets(sources, most))
    drawn = F.xxhash64(F.lit(seed), "doc_id", "size")
    placed = (rows.join(sources.select(F.col("source").alias("s"), "place", "shards"), F.col("source").eqNullSafe(F.col("s")))
              .withColumn("shard", F.pmod(drawn, F.col("shards"))).withColumn("words", F.col("size") * F.col("copies"))
              .select("place", "shard", "doc_id", "size", "copies", "words"))
    shards = cut(placed.groupBy("place", "shard").agg(F.sum("words").alias("shard_words"))
                 .withColumn("blocks", _blocks(F.col("shard_words"), block)))
    totals = shards.groupBy("place").agg(F.sum("blocks").alias("source_blocks")).where("source_blocks > 0")
    # votes: how many of its own blocks a source needs for its target
    claims = (sources.join(totals, "place").withColumn("all", F.lit(0)).withColumn("ceiling", F.col("source_blocks") * most)
              .withColumn("votes", F.col("target") * F.col("source_blocks") / F.col("source_size")))
    seats = claims.agg(F.round(F.sum("votes")).cast("long")).first()[0] or 0
    quotas = apportion(claims.select("all", "place", "ceiling", "votes", "source_blocks", F.lit(seats).alias("seats")), ["all"], ["place"])
    parts = (shards.where("blocks > 0").join(quotas.select("place", "source_blocks", F.col("quota").alias("seats")), "place")
             .withColumn("votes", F.col("seats") * F.col("blocks") / F.col("source_blocks").cast("double"))
             .withColumn("ceiling", F.col("blocks") * most))
    parts = cut(apportion(parts, ["place"], ["shard"]).select("place", "shard", "shard_words", "blocks", "quota"))
    line = Window.partitionBy("place", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.col("doc_id").asc_nulls_last(), "size")
    laid = (placed.join(parts, ["place", "shard"], "left")
            .withColumn("at", F.sum("words").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words"))
            .withColumn("turn", F.xxhash64(F.lit(seed), "place", "shard")).withColumn("all_taken", _taken()))
    laid = laid.join(sources.select("place", "source", "source_size", "target"), "place")
    # rows equal in id, source and size: one row each again, in two steps so that no row holds an entry per copy
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / 1024)))
    copy = F.explode(F.sequence(F.col("first") * 1024, F.least(F.col("copies"), (F.col("first") + 1) * 1024) - 1))
    share = div(F.col("all_taken"), F.col("copies")) + F.when(F.col("copy") < F.pmod("all_taken", "copies"), 1).otherwise(0)
    return (laid.withColumn("first", first).withColumn("copy", copy)
            .select("doc_id", "size", "source_size", "target", share.cast("long").alias("taken"), "source", "shard"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
