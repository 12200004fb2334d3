"""The corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator of ``cyclecount.llm`` on all rows that the stage before kept:
the quality classifier drops what it rejects, SimHash near-duplicates leave one document of
each group, secrets are replaced by a mark, the mix repeats or leaves out documents to meet
its sources' targets, in training order, and packing gives every document's pieces their
places in sequences. Every stage's rows are written as Parquet and read again by the next.

Null, empty and very long texts, ties, repeated rows, empty tables and extra columns behave
as the operators' docstrings say; extra columns ride along up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclecount.llm import mixing, packing, quality, secrets, simhash
from cyclecount.llm.common import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3, fitted on the labels of the documents given."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group stays."""
    return simhash.dedup(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: spans are replaced by a mark, and n_chars counts the new text."""
    out = secrets.redact(docs)
    changed = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the copies that the mix takes, in training order."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the pieces of every document and their places."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The classifier's and the tokenizer's results can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs
