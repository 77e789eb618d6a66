"""Skew probe: how much of a hot key lands in one task of the shipped code.

Builds gift and credit facts in which one key holds a third of all rows, runs
the shipped gift file, last gift and credit summary on them, and, for
comparison, the plain window forms; per-task shuffle records come from Spark's
event log (in a fresh scratch folder). Prints one JSON line per variant.

    python tools/skew_probe.py [rows]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window, functions as F  # noqa: E402

from patronage.operators import giving  # noqa: E402
from patronage.plans import extracts  # noqa: E402
from patronage.plans.registry import fixture_params  # noqa: E402
from patronage.sources.testdata import testdata_tables  # noqa: E402
from patronage.tables import Tables  # noqa: E402
from tools.event_log import by_group  # noqa: E402


def main(rows: int) -> None:
    scratch = tempfile.mkdtemp(prefix="skew-probe-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", scratch)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "32")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             # joins of persons and facts shuffle, as at scale; AQE's skew thresholds fit the probe's size
             .config("spark.sql.autoBroadcastJoinThreshold", "64k")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64k")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1m")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    base = testdata_tables(spark, "/root/testdata/sf0.001")
    p = fixture_params(base)
    hot, i = rows // 3, F.col("id")
    day = F.element_at(F.array(*[F.lit((y - 1) * 10000 + 701) for y in range(1996, 2001)]), (i % 5 + 1).cast("int"))

    def gifts(household, number):
        return spark.range(rows).select(
            household.alias("household_key"), number.alias("gift_number"), day.alias("date_key_gift"),
            (i % 5 + 1).cast("int").alias("designation_key"), ((i % 5 + 1996) * 10 + 1).cast("int").alias("campaign_key"),
            F.lit(0).alias("gift_description_key"), i.alias("pledge_number"),
            (i % 1000).cast("decimal(14,2)").alias("credit_amount"))

    def number(k):
        return F.concat(F.lit("G"), k.cast("string"))
    spread = i % 100_000 + 1
    in_hot = i < hot
    people = spark.range(rows).select(i.alias("constituent_key"), i.alias("household_key"), i.cast("string").alias("cons_id"))

    def with_gifts(fact):
        credit = fact.select(F.col("household_key").alias("constituent_key_credit"), "gift_description_key", "campaign_key",
                             F.lit(2000).alias("fiscal_year"), "credit_amount")
        own = {"adv_hh_giving_f": fact, "adv_credit_f": credit}
        return Tables({n: (lambda n=n: own.get(n, base[n] if n not in own else None)) for n in base.names()})
    hot_number = with_gifts(gifts(i, F.when(in_hot, F.lit("G0")).otherwise(number(spread))))
    hot_pair = with_gifts(gifts(F.when(in_hot, F.lit(0)).otherwise(i), F.when(in_hot, F.lit("G0")).otherwise(number(spread))))
    order = [F.col(c).asc_nulls_last() for c in extracts.GIFT_ORDER]

    def window(t):
        w = Window.partitionBy("gift_number").orderBy(*order)
        return extracts.gift_rows(t, p, people).withColumn("seq", F.row_number().over(w))
    variants = [("gift_extract, hot gift number, all persons distinct", lambda: extracts.gift_extract(hot_number, p, people)),
                ("the same by one window per gift number", lambda: window(hot_number)),
                ("gift_extract, hot (gift number, person) pair", lambda: extracts.gift_extract(hot_pair, p, people)),
                ("last_gift, hot household", lambda: giving.last_gift(hot_pair, p)),
                ("summary_person_credit, hot person", lambda: giving.summary_person_credit(hot_pair, p, people))]
    seconds = {}
    window(hot_pair).write.format("noop").mode("overwrite").save()  # warm-up
    extracts.gift_extract(hot_pair, p, people).write.format("noop").mode("overwrite").save()
    for name, build in variants:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - t0, 2)
    app_id = spark.sparkContext.applicationId
    spark.stop()
    figures = by_group(scratch, app_id)
    for name in seconds:
        print(json.dumps({"variant": name, "rows": rows, "hot_rows": hot, "seconds": seconds[name], **figures[name]}))


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 3_300_000)
