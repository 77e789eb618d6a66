"""Run the differential test over a range of seeds: python tests/differential_sweep.py 0 100"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from patronage.session import local_session  # noqa: E402
from patronage.sources.testdata import testdata_tables  # noqa: E402
from tests.differential import differences  # noqa: E402

if __name__ == "__main__":
    lo, hi = int(sys.argv[1]), int(sys.argv[2])
    spark = local_session(8)
    derived = testdata_tables(spark, "/root/testdata/sf0.001")
    schemas = {n: derived[n].schema for n in derived.names()}
    failed = 0
    for seed in range(lo, hi):
        bad = differences(spark, schemas, seed)
        failed += bool(bad)
        print(seed, "OK" if not bad else bad, flush=True)
    print(f"{hi - lo - failed}/{hi - lo} seeds match")
