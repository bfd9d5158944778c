"""Filters and routing of postings and taxonomy rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signpost.functions.text import is_blank, is_short, trim_u
from signpost.schema import (
    MIN_INTRO_CHARS,
    REJECT_BELOW,
    STATUS_FILTERED,
    STATUS_PENDING,
)


def valid_rows(rows: DataFrame) -> DataFrame:
    """Rows with a non-blank id; both texts trimmed."""
    return rows.filter(~is_blank("mid")).withColumns(
        {"mid": trim_u("mid"), "job_intro": F.coalesce(trim_u("job_intro"), F.lit(""))}
    )


def route_short(rows: DataFrame, min_chars: int = MIN_INTRO_CHARS) -> DataFrame:
    """Mark rows too short to match. Both kinds stay in the store."""
    return rows.withColumn("is_filtered", is_short("job_intro", min_chars))


def initial_status(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "status",
        F.when(F.col("is_filtered"), F.lit(STATUS_FILTERED)).otherwise(F.lit(STATUS_PENDING)),
    )


def all_matchable(store: DataFrame) -> DataFrame:
    """Postings with a text, whatever their status."""
    return store.filter(F.col("job_intro").isNotNull() & (F.col("job_intro") != ""))


def pending_match(store: DataFrame) -> DataFrame:
    """Postings to match. Processed ones are included: resuming goes by the result."""
    return all_matchable(store).filter(F.col("status") != STATUS_FILTERED)


def pending_structuring(store: DataFrame, limit: int | None = None) -> DataFrame:
    """Postings without a structured summary, oldest first."""
    todo = all_matchable(store).filter(
        F.col("structured_summary").isNull() | (F.col("structured_summary") == "")
    )
    todo = todo.withColumn("category", F.coalesce("category", F.lit("")))
    if limit is None or limit <= 0:
        return todo
    return todo.orderBy("updated_at", "mid").limit(limit)


def pending_enrichment(
    taxonomy: DataFrame, force: bool = False, limit: int | None = None
) -> DataFrame:
    """Taxonomy rows without an overview, in file order."""
    todo = taxonomy if force else taxonomy.filter(is_blank("overview"))
    if limit is None or limit <= 0:
        return todo
    return todo.orderBy("ordinal").limit(limit)


def reject_low_similarity(matches: DataFrame, below: float = REJECT_BELOW) -> DataFrame:
    """Drop matches under the limit."""
    return matches.filter(F.col("similarity") >= below)


def tag_low_confidence(matches: DataFrame, below: float = 0.0) -> DataFrame:
    """Keep every match, only mark those under the limit."""
    return matches.withColumn("low_conf", F.col("similarity") < below)


def ignored(store: DataFrame) -> DataFrame:
    """The rows of the ignore file, regenerated from the store."""
    return store.filter(F.col("status") == STATUS_FILTERED).select("mid", "job_intro")
