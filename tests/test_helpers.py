"""Small helpers: literal tables, the table set, the sink, the parameter lookup."""

import pytest

from patronage.params import read_fiscal_year
from patronage.sources.sinks import write_extract
from patronage.sources.testdata import literal_table
from patronage.tables import Tables


def test_literal_table_quotes_nulls_and_types(spark):
    df = literal_table(spark, [("it's", 1, None), (None, 2, "x")], "a string, b bigint, c string")
    assert df.schema.simpleString() == "struct<a:string,b:bigint,c:string>"
    assert df.collect() == [("it's", 1, None), (None, 2, "x")]
    # an inline table has exact statistics, so it is small enough to broadcast
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)) < 1024


def test_tables_build_once_and_reject_unknown_names(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(1)

    t = Tables({"one": build})
    assert t.one is t["one"] and len(calls) == 1
    with pytest.raises(KeyError):
        t["missing"]


def test_sink_rejects_unknown_formats(spark, tmp_path):
    with pytest.raises(ValueError):
        write_extract(spark.range(1), str(tmp_path / "x"), fmt="xlsx")


def test_fiscal_year_parameter_must_not_be_null(spark):
    rv = literal_table(spark, [("VOLUNTR_FY", None)], "var_name string, var_value int")
    with pytest.raises(ValueError):
        read_fiscal_year(rv)
