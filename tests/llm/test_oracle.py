"""SQL twins of the training-data queries on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from twasprep.llm.oracle import ORACLE_SQL
from twasprep.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    rows = lambda df: sorted(tuple("" if pd.isna(x) else x for x in r)
                             for r in df[cols].itertuples(index=False))
    assert rows(got) == rows(want)
