"""Run every registered query on a random warehouse in Spark and in DuckDB."""

from __future__ import annotations

import duckdb
from pyspark.sql import SparkSession, types as T

from patronage.checks.oracle import over_tables
from patronage.plans.registry import QUERIES, comparable, fixture_params
from patronage.tables import Tables
from tests.oracle_compare import _rows, _types
from tests.random_warehouse import warehouse


def _duck_type(dt: T.DataType) -> str:
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.IntegerType):
        return "INTEGER"
    if isinstance(dt, T.StringType):
        return "VARCHAR"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.DateType):
        return "DATE"
    raise TypeError(dt)


def load(spark: SparkSession, schemas: dict, seed: int):
    rows = warehouse(seed)
    nullable = {n: T.StructType([T.StructField(f.name, f.dataType, True) for f in s.fields])
                for n, s in schemas.items() if n != "gift_base"}
    con = duckdb.connect()
    frames = {}
    for name, schema in nullable.items():
        data = rows.get(name, [])
        frames[name] = spark.createDataFrame(data, schema)
        cols = ", ".join(f'"{f.name}" {_duck_type(f.dataType)}' for f in schema.fields)
        con.execute(f"CREATE TABLE {name} ({cols})")
        if data:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(schema.fields))})", data)
    return Tables({n: (lambda df=df: df) for n, df in frames.items()}), con


def differences(spark: SparkSession, schemas: dict, seed: int, queries: dict | None = None) -> dict[str, str]:
    t, con = load(spark, schemas, seed)
    p = fixture_params(t)
    bad = {}
    for name, fn in (QUERIES if queries is None else queries).items():
        sdf = comparable(fn(t, p))
        s_cols, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
        res = con.execute(over_tables(name))
        d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
        if sorted(s_cols) != sorted(d_cols):
            bad[name] = f"columns {s_cols} vs {d_cols}"
        elif _rows(s_cols, s_rows) != _rows(d_cols, d_rows):
            a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
            bad[name] = f"rows {len(s_rows)} vs {len(d_rows)}; spark-only {list((a - b).items())[:2]}; " \
                        f"oracle-only {list((b - a).items())[:2]}"
        elif _types(s_cols, s_rows) != _types(d_cols, d_rows):
            bad[name] = f"types {_types(s_cols, s_rows)} vs {_types(d_cols, d_rows)}"
    return bad
