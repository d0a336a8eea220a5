"""From raw documents to packed training sequences.

Toxic documents go; one document of each group of near duplicates stays;
personal data is replaced; sources are mixed to their target weights; what
results is packed into sequences. Each stage's result is written as Parquet and
read again as the next one's documents.

Nulls, empty texts, repeated rows and extra columns are handled as each
operator states it. Rows without ``doc_id``, or with the same one, pass the mix
like any other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellmend.llm.common import importable
from cellmend.llm.mixing import mixed_documents
from cellmend.llm.ngram_join import one_of_each_group
from cellmend.llm.packing import pack_documents
from cellmend.llm.pii import pseudonymise
from cellmend.llm.queries import EXAMPLE_KEY, table
from cellmend.llm.toxicity import without_toxic
from cellmend.operators.ordering import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    importable(spark)
    return without_toxic(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    importable(spark)
    return one_of_each_group(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with pseudonyms in place of personal values."""
    importable(spark)
    return (pseudonymise(docs.select(*COLUMNS), EXAMPLE_KEY)
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the words that the mix takes."""
    importable(spark)
    return mixed_documents(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in the sequences."""
    importable(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: The classifier, the permutations and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
