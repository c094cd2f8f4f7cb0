"""The registered queries of the subpackage run on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from granary.llm import queries

SCHEMAS = {
    "p1_found": "src string, answer_id bigint, defect string",
    "p2_found": "file_path string",
    "p3_found": "chunk_id bigint, cut_kind string",
    "p4_found": "chunk_id_a bigint, chunk_id_b bigint",
    "p6_ids": "doc_id bigint, ids array<int>",
    "p8_found": "doc_id bigint, level string",
}


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, data, name):
    df = entry.queries()[name](spark, data)
    if name in SCHEMAS:
        assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == SCHEMAS[name]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_equals_sql(spark, data, name):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    df = entry.queries()[name](spark, data)
    got = sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)
    want = con.sql(queries.oracle_sql()[name])
    assert got == sorted(want.select(*sorted(want.columns)).fetchall(), key=repr)
