"""The corpus pipeline: documents without toxic and near-duplicate texts, benchmark passages and personal data, packed."""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lapwise.llm.contamination import without_contaminated  # noqa: E402
from lapwise.llm.neardup import without_near_duplicates  # noqa: E402
from lapwise.llm.packing import harmonic_pack  # noqa: E402
from lapwise.llm.pii import find_pii, masked  # noqa: E402
from lapwise.llm.queries import vocabulary_path  # noqa: E402
from lapwise.llm.toxicity import without_toxic  # noqa: E402
from lapwise.session import shared_folder  # noqa: E402


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the last model of the chain calls toxic."""
    return without_toxic(docs, docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each class."""
    return without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with at least one word in twenty inside a benchmark passage."""
    return without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each span of personal data by its kind in brackets."""
    return masked(find_pii(docs, into="__pii"), spans="__pii")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts documents into pieces and packs them into sequences; one row for each piece, with its token ids."""
    return harmonic_pack(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: A trained classifier and sampled signatures cannot be told in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again as the next one's documents."""
    docs = _table(spark, sf_dir, "documents")
    place = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, function) in enumerate(STAGES):
        path = f"{place}/{number}-{name}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
