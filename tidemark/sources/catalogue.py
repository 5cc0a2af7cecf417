"""Tables of the session catalogue: registered folders, clones of a schema, tables of known kinds made where they are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.scratch import shared_dir
from tidemark.sources.tables import SCHEMAS

LISTING = "table_name string, ordinal int, column_name string, data_type string"


def database(spark: SparkSession, name: str) -> str:
    """A database whose tables lie in the shared folder, if there is none of the name."""
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{shared_dir(spark)}/{name}.db'")
    return name


def register(spark: SparkSession, db: str, name: str, path: str) -> str:
    """An existing Parquet folder or file as a table of the catalogue."""
    full = f"{db}.{name}"
    if not spark.catalog.tableExists(full):
        spark.catalog.createTable(full, path=path, source="parquet")
    return full


def create_missing(spark: SparkSession, db: str, kinds: dict[str, str] = SCHEMAS) -> list[str]:
    """Empty tables of the known kinds that the database lacks; returns which were made."""
    have = set(tables(spark, db))
    made = [k for k in kinds if k not in have]
    for k in made:
        spark.sql(f"CREATE TABLE {db}.{k} ({kinds[k]}) USING parquet")
    return made


def clone_schema(spark: SparkSession, source: str, target: str) -> str:
    """An empty table with the columns of another one, if there is none of the name."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {target} LIKE {source} USING parquet")
    return target


def tables(spark: SparkSession, db: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary)


def columns(spark: SparkSession, db: str) -> DataFrame:
    """Every column of every table of a database (LISTING)."""
    rows = [(t, i, c.name, c.dataType) for t in tables(spark, db) for i, c in enumerate(spark.catalog.listColumns(f"{db}.{t}"), 1)]
    return spark.createDataFrame(rows, LISTING)
