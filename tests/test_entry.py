"""Driver contract: every registered query against its SQL twin (sf0.001)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "dtype"):
        f = float(v)
        return None if math.isnan(f) else round(f, 9)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)),
                        key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_contract_keys():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 25


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "MAF" in df.columns


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_ORACLE)))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    sp = sdf.toPandas()
    dp = duck.execute(entry.oracle_sql()[name]).df()
    sc, sr = _rows(sp)
    dc, dr = _rows(dp)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
