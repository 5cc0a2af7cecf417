"""The category dimension from a CSV file: byte-order mark, sniffed separator, header in any case, last line wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import category_or_other

SEPARATORS = (",", ";", "\t", "|")


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """id, symbol, category in file order (line). The file is small: one task reads it whole to keep its order."""
    header = spark.read.text(path).first()[0].lstrip("﻿")
    sep = max(SEPARATORS, key=header.count)
    rows = spark.read.csv(path, sep=sep, header=True, multiLine=True, quote='"', escape='"')
    names = {c.lstrip("﻿").strip().lower(): c for c in rows.columns}
    col = lambda n: F.trim(F.col(f"`{names[n]}`")) if n in names else F.lit(None).cast("string")
    ident = col("id") if "id" in names else col("symbol")
    line = rows.coalesce(1).select(F.monotonically_increasing_id().alias("line"), F.lower(ident).alias("id"), F.upper(col("symbol")).alias("symbol"), category_or_other(col("category")).alias("category"))
    return line.where("id is not null")


def last_wins(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: its last line's category, and whether lines of it disagree."""
    w = Window.partitionBy(key).orderBy(F.desc("line"))
    first = rows.where(F.coalesce(F.col(key), F.lit("")) != "").withColumn("_n", F.row_number().over(w))
    many = F.max("category").over(Window.partitionBy(key)) != F.min("category").over(Window.partitionBy(key))
    return first.withColumn("conflict", many).where("_n = 1").select(key, "category", "conflict")


def load_dimension(live: DataFrame, manual: DataFrame, path: str) -> DataFrame:
    """Replaces the category dimension at path: every live id with its category from the manual file, else Other, and which
    of the two it is (manual_csv, default_other). Returns the table as read back."""
    m = manual.select(F.col("id").alias("_id"), F.col("category").alias("_category"))
    j = live.where("id is not null").join(m, F.col("id") == F.col("_id"), "left")
    source = F.when(F.col("_id").isNotNull(), "manual_csv").otherwise("default_other")
    out = j.select("id", "symbol", category_or_other(F.col("_category")).alias("category"), source.alias("source"))
    out.write.mode("overwrite").parquet(path)
    return live.sparkSession.read.schema(out.schema).parquet(path)
