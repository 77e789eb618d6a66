import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from patronage.session import local_session
    s = local_session("*", shuffle_partitions=8, app="patronage-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def schemas(spark):
    """Schemas of the 32 warehouse tables, as the test-data adapter builds them."""
    from patronage.sources.testdata import testdata_tables
    t = testdata_tables(spark, f"{TESTDATA}/sf0.001")
    return {n: t[n].schema for n in t.names()}


@pytest.fixture
def make_tables(spark, schemas):
    """Hand-made tables: given rows per table (column order of the adapter's
    schema); every other table is empty."""
    from patronage.tables import Tables

    def build(**rows):
        def loader(name):
            return lambda: spark.createDataFrame(rows.get(name, []), schemas[name])
        return Tables({n: loader(n) for n in schemas})
    return build
