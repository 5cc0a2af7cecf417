"""The corpus queries that SQL can express, against it, on the smallest tables."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest
from conftest import SMALL

from tidemark.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = con.execute(SQL[name]).fetchdf()
    result = queries.queries()[name](spark, SMALL)
    got = pd.DataFrame([tuple(r) for r in result.collect()], columns=result.columns, dtype=object)  # nullable integers stay integers
    assert sorted(got.columns) == sorted(want.columns)

    def rows(frame):
        frame = frame[sorted(want.columns)].astype(object)
        return sorted(map(str, frame.where(frame.notna(), None).itertuples(index=False, name=None)))

    assert rows(got) == rows(want)
