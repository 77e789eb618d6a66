"""Differential test: every registered query on random warehouses (NULLs,
'n/a', duplicate rows, shared ids, multi-person households, tied gifts),
Spark against the specification-style DuckDB statements.

The random data is checked to be sensitive: replacing the empty-string rule,
the numeric parent-year test or the staff-assignment fan-out with a plausible
wrong variant makes seeds fail. ``python tests/differential_sweep.py 0 100`` runs more.
"""

import pytest

from tests.differential import differences


@pytest.mark.parametrize("seed", range(3))
def test_random_warehouse_matches_oracle(spark, schemas, seed):
    assert differences(spark, schemas, seed) == {}
