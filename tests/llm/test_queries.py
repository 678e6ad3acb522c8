"""The registered training-data queries at the smallest scale: SQL, and plans of the native ones."""

import duckdb
import pytest

from corate import llm

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = llm.QUERIES[name](spark, SF)
    want = con.execute(llm.ORACLE[name])
    cols = sorted(df.columns)
    names = [d[0] for d in want.description]
    assert cols == sorted(names)
    rows = [tuple(r[names.index(c)] for c in cols) for r in want.fetchall()]
    assert sorted(map(str, ((tuple(r[c] for c in cols)) for r in df.collect()))) == sorted(map(str, rows))


@pytest.mark.parametrize("name", ["op1_mix_sources", "op4_decontaminate", "op7_personal_data", "op10_licenses"])
def test_native_plans(spark, name):
    llm.QUERIES[name](spark, SF).createOrReplaceTempView("_native")
    plan = spark.sql("EXPLAIN EXTENDED SELECT * FROM _native").collect()[0][0]
    assert not any(x in plan for x in ("InPandas", "InArrow", "EvalPython", "CartesianProduct", "NestedLoop"))
