"""A corpus pipeline: language ID, near duplicates, pseudonyms, mixing, packing.

Each stage takes all that the one before it kept, as a table written and read again. Documents
without a language go; of each group of near copies one document stays; personal data become
pseudonyms; sources are mixed to their weights, with repeated epochs; the rest is packed. Null
values, empty texts, repeated rows and further columns have the results that each operator's
module states; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signpost.llm import chosen_path, langid, mixing, packing, pii
from signpost.llm.queries import PII_KEY
from signpost.llm.tables import documents, materialize, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; `lang` is the one found."""
    ship_package(spark)
    return langid.with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of likeness 0.8 or more in five-word shingles."""
    ship_package(spark)
    return chosen_path.without_near_copies(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; `n_chars` follows the text."""
    ship_package(spark)
    kept = pii.pseudonymize(docs, PII_KEY)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 1, 2, 3, repeating; documents repeat with their epochs."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    ship_package(spark)
    return packing.pieces(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("mix_sources", mix_sources),
    ("pack", pack),
]
# Language ID, near copies, pseudonyms and packing are beyond SQL; tests/llm holds the stages
# against plain ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as a table that the next one reads."""
    ship_package(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
