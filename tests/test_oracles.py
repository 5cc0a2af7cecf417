"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import os
import re

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(k for k in entry.queries() if not re.match(r"op\d+_", k) and k != "pipeline")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def rows_of(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    text = frame.astype(str).replace({"None": "~", "nan": "~", "NaT": "~", "<NA>": "~"}).replace(r"(\.0| 00:00:00(\.0+)?)$", "", regex=True)
    return sorted(map(tuple, text.to_numpy()))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    want = duck.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_tables_are_given():
    assert all(os.path.exists(f"{SMALL}/{t}.parquet") for t in TABLES)
