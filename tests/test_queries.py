"""Every registered core query runs on the smallest tables and equals its SQL there."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from granary.plans import catalogue


def canon(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (bool,)) or type(v).__name__ == "bool_":
        return bool(v)
    if isinstance(v, float) or type(v).__name__.startswith("float"):
        return None if math.isnan(v) else round(float(v), 5)
    if isinstance(v, int) or type(v).__name__.startswith(("int", "uint")):
        return int(v)
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(canon(x) for x in v)
    return str(v)


def rows(df):
    cols = sorted(df.columns)
    plain = df[cols].astype(object).where(df[cols].notna(), None)
    return cols, sorted((tuple(map(canon, r)) for r in plain.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, data, duck, name):
    got = entry.queries()[name](spark, data).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql is not None:
        assert rows(got) == rows(duck.sql(sql).df())


def test_entry(spark, data):
    assert entry.entry(spark).columns == ["layer", "reason", "n", "tokens"]
