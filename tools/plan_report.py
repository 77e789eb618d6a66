"""Write PLANS.md: the physical plan shape of each extract on parquet warehouse tables.

Materializes the 32 tables derived from the test data (``sf_dir``) into a
fresh scratch folder, reads them back as a warehouse would, runs each extract
and reports what ran, from Spark's event log (stages, tasks, records read and
shuffled, with everything that the adaptive plan dropped afterwards), and the
filters and columns pushed into each parquet scan of the final plan. Broadcast
thresholds are capped at ``BCAST`` bytes (default 16 KB) so that, as at
scale, only the code tables are broadcast and person- or fact-sized inputs
are shuffled.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from patronage.plans import extracts  # noqa: E402
from patronage.plans.registry import fixture_params  # noqa: E402
from patronage.session import DEFAULT_CONF, local_session  # noqa: E402
from patronage.sources.testdata import testdata_tables  # noqa: E402
from patronage.sources.warehouse import store_tables, warehouse_tables  # noqa: E402
from tools.event_log import by_group  # noqa: E402

EXTRACTS = ["constituent_extract", "activity_extract", "affiliation_extract", "degree_extract",
            "gift_extract", "gift_summary_extract", "relative_extract"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    bcast = os.environ.get("BCAST", str(16 * 1024))
    logs = tempfile.mkdtemp(prefix="plan-report-log-")
    SparkSession.builder.master("local[8]").config(map={
        **DEFAULT_CONF, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": logs, "spark.eventLog.compress": "false"}).getOrCreate()
    spark = local_session(8)
    loc = tempfile.mkdtemp(prefix="plan-report-")
    store_tables(testdata_tables(spark, sf_dir), loc)  # the warehouse layout
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bcast)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", bcast)
    t = warehouse_tables(spark, location=loc)
    p = fixture_params(t)
    print("# PLANS\n")
    print(f"Final adaptive plans of the seven extracts on parquet warehouse tables derived from `{sf_dir}` "
          "(facts in folders by fiscal year and campaign), "
          f"broadcast threshold {int(bcast) // 1024} KB (code tables broadcast, person- and fact-sized "
          "inputs shuffled, as at scale). Generated by `tools/plan_report.py`.\n")
    lines: dict[str, list[str]] = {}
    for name in EXTRACTS:
        spark.sparkContext.setJobGroup(name, name)
        df = getattr(extracts, name)(t, p)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        lines[name] = []
        scans = {}
        for line in plan.splitlines():
            m = re.search(r"FileScan parquet \[([^\]]*)\].*Location: [^\[]*\[file:[^\]]*/(\w+)\]"
                          r".*PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]?, ReadSchema", line)
            if m:
                cols, table, parts, pushed = m.group(1), m.group(2), m.group(3), m.group(4)
                scans.setdefault(table, (len(cols.split(",")), parts, pushed))
        for table, (ncols, parts, pushed) in sorted(scans.items()):
            pruned = f"; partitions: {parts}" if parts else ""
            lines[name].append(f"* scan `{table}`: {ncols} columns{pruned}; pushed: {pushed or '-'}")
    app_id = spark.sparkContext.applicationId
    spark.stop()
    figures = by_group(logs, app_id)
    for name in EXTRACTS:
        f = figures[name]
        print(f"## {name}\n")
        print(f"* ran: {f['stages']} stages, {f['tasks']} tasks, {f['records_read']} records read from files, "
              f"{f['shuffle_records']} shuffled, {f['largest_task']} in the largest task")
        print(*lines[name], sep="\n", end="\n\n")


if __name__ == "__main__":
    main()
