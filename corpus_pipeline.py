"""The corpus pipeline: quality rules, near-duplicates, secrets, mixing, packing.

Each stage is a function of (spark, docs, sf_dir) on all that the stage before has kept. All but the last return the columns
of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, near_dedup, packing, quality, secrets, tokens
from tidemark.llm.common import discard, only_result


def _recounted(docs: DataFrame) -> DataFrame:
    """docs with n_chars, if it has one, as its texts now are."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others, lines that failed go.

    Null and empty texts are rejected; nulls elsewhere, equal ids and repeated rows are judged row by row; no rows give none.
    """
    return _recounted(quality.accepted(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id, then text hash.

    Texts without words (null ones too) are alike to nothing and all stay; a null id gives way to any other; rows that repeat
    id and text go. Rows that share an id stay apart unless their texts link.
    """
    return near_dedup.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are blotted out; their documents stay.

    Null texts stay null; a null source counts as an owner of its own; repeated rows are all blotted out alike.
    """
    return _recounted(secrets.redact(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least; documents of small sources again, up to the repetition limit.

    A null source is a source; null ids and texts and repeated rows are rows like any other. Columns named like those of the
    mixture's order keep their own values; the order itself is given again by packing, which keeps repeats apart.
    """
    return mixing.mix(docs, with_order=False)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences along the curve, the mixture's repeats a pass over the corpus apart.

    Null and empty texts are their end id alone; rows of a null id are packed each on its own.
    """
    return packing.pack_sequences(docs, tokens.vocabulary("byte_bpe_50k.json"), end_id=0, repeats_apart=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: SQL has no tokenizer, so the last stage cannot be expressed; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents. Each writes a table that the next one reads; only the last one's is left in the end."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        out = only_result(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        docs = before = out
    return docs
