"""The training-data pipeline over the `documents` table.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage
before it kept, and returns a DataFrame; between stages the rows are written as
Parquet to the shared folder and read again. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_engine.llm.common import read_table
from catalog_engine.llm.line_dedup import deduplicated
from catalog_engine.llm.mixing import mixed_documents
from catalog_engine.llm.near_dedup import without_near_duplicates
from catalog_engine.llm.piece_bpe import encode_rows
from catalog_engine.llm.queries import PIECE_MODEL
from catalog_engine.llm.repetition import with_verdict
from catalog_engine.session import checkpoint_root


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return with_verdict(docs).filter("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that equal or nearly equal an earlier line go; no document does."""
    return deduplicated(docs, every_repeat=True).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out so that sources meet their targets."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    return encode_rows(docs, PIECE_MODEL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: No SQL: edit-distance classes, sketches and the tokenizer are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each kept lies in a folder of this run under spark.checkpoint.dir."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{checkpoint_root(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
