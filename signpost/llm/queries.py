"""The registered queries of this folder and their SQL; each applies one operator to a whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signpost.llm import (
    chosen_path,
    extract,
    kmeans_tree,
    langid,
    mixing,
    packing,
    pii,
    repair,
    rollup,
    spelling,
    spotsigs,
    substrings,
    warc,
)
from signpost.llm.tables import documents, read, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


PII_KEY = "rotatethiskey2026"


@query("op1_pseudonymize")
def op1_pseudonymize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's id, text with pseudonyms, and how many values were replaced."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.pseudonymize(docs, PII_KEY, count_as="n_replaced")


@query("op2_warc", warc.SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, normalised, and read back."""
    return warc.round_trip(read(spark, sf_dir, "pages"))


@query("op3_spotsigs")
def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness."""
    return spotsigs.edited_likeness(documents(spark, sf_dir))


@query("op4_ngram_join")
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class and number of links: five-word shingles, likeness of 0.8 or more."""
    return chosen_path.near_copies(documents(spark, sf_dir))


@query("op5_nearest")
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found of every hundredth vector."""
    return kmeans_tree.nearest(read(spark, sf_dir, "embeddings"))


@query("op6_pack")
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces in sequences of at most 1024 tokens."""
    return packing.pieces(documents(spark, sf_dir))


@query("op7_extract")
def op7_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract.extracted(read(spark, sf_dir, "pages"))


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, by a model of three quarters of the labelled documents."""
    return langid.labelled(documents(spark, sf_dir))


@query("op9_token_rollup", rollup.SQL)
def op9_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens by source, language and tokenizer version after four batches of deltas."""
    return rollup.corpus_history(spark, sf_dir)


@query("op10_mix_sources", mixing.SQL)
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: sources weigh 1, 2, 3, repeating, and share all words."""
    return mixing.mix(documents(spark, sf_dir))


@query("op11_spelling", spelling.SQL)
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of six letters or more, its near words' number, its form and root."""
    return spelling.variants(documents(spark, sf_dir))


@query("op12_substrings", substrings.SQL)
def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words under windows of 50 that an earlier document holds."""
    return substrings.removed(documents(spark, sf_dir))


@query("op13_repair", repair.SQL)
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, its cheapest edits and its repaired text's digest."""
    return repair.repaired(read(spark, sf_dir, "conversations"))
