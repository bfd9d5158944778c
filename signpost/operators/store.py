"""The posting store: upsert, keyed updates, id clean-up and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.functions.text import is_job_id, text_key, trim_u
from signpost.operators.sizing import KNOWN_IDS, broadcast_if_bounded
from signpost.schema import STATUS_DONE, STATUS_FILTERED, STATUS_PENDING
from signpost.session import materialize
from signpost.sources.versions import VersionedTable


def upsert_postings(store: DataFrame, load: DataFrame, loaded_at: Column) -> DataFrame:
    """Merge a load into the store by id.

    `load` has mid, job_intro, source, is_filtered and ordinal (file order). The
    last row of an id wins. Its status is filtered if that row is short; goes
    back to pending when the id was filtered before (in the store or earlier in
    the load); otherwise it stays. The load is reduced to one row per id with
    map-side partial aggregation, so a hot id never meets in one task.
    """
    last = load.groupBy("mid").agg(
        F.max_by(F.struct("job_intro", "source", "is_filtered"), "ordinal").alias("new"),
        F.bool_or("is_filtered").alias("any_filtered"),
    )
    old, new = store.alias("old"), last.alias("new_rows")
    merged = old.join(new, F.col("old.mid") == F.col("new_rows.mid"), "full_outer")
    touched = F.col("new_rows.mid").isNotNull()
    was_filtered = (
        F.col("old.status").isNull()
        | (F.col("old.status") == STATUS_FILTERED)
        | F.col("any_filtered")
    )
    status = (
        F.when(~touched, F.col("old.status"))
        .when(F.col("new.is_filtered"), F.lit(STATUS_FILTERED))
        .when(was_filtered, F.lit(STATUS_PENDING))
        .otherwise(F.col("old.status"))
    )
    replaced = {
        "mid": F.coalesce(F.col("old.mid"), F.col("new_rows.mid")),
        "job_intro": F.when(touched, F.col("new.job_intro")).otherwise(F.col("old.job_intro")),
        "source": F.when(touched, F.col("new.source")).otherwise(F.col("old.source")),
        "status": status,
        "category": F.when(F.col("old.mid").isNull(), F.lit("")).otherwise(F.col("old.category")),
        "updated_at": F.when(touched, loaded_at).otherwise(F.col("old.updated_at")),
    }
    return merged.select(
        *[replaced.get(c, F.col(f"old.{c}")).alias(c) for c in store.columns]
    )


def load_postings(table: VersionedTable, load: DataFrame, loaded_at: Column) -> None:
    """`upsert_postings` into a stored table keyed by mid: only the parts it touches are rewritten."""
    table.merge(load, lambda held, rows: upsert_postings(held, rows, loaded_at))


def backfill_missing(postings: DataFrame, results: DataFrame, limit: int | None = None):
    """Postings that have no result row yet; optionally the first N by id.

    The result side is only reduced by map-side distinct: an id repeated there
    many times costs nothing on the reduce side. A bounded number of ids goes to
    the postings, so that their texts are not shuffled.
    """
    done = broadcast_if_bounded(results.select(trim_u("mid").alias("mid")).distinct(), KNOWN_IDS)
    todo = postings.join(done, "mid", "left_anti")
    return todo.orderBy("mid").limit(limit) if limit and limit > 0 else todo


def mark_processed(store: DataFrame, results: DataFrame) -> DataFrame:
    """Status becomes processed for every id with a result row."""
    done = results.select(trim_u("mid").alias("mid")).distinct().withColumn("has_result", F.lit(True))
    status = F.when(F.col("has_result"), F.lit(STATUS_DONE)).otherwise(F.col("status"))
    return store.join(done, "mid", "left").withColumn("status", status).drop("has_result")


def update_by_key(table: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Overwrite `columns` of the rows with a change; others keep their values.

    A change with null in a column sets null. Of several changes to a key the greatest, by
    `columns`, is taken, so no row of the table is multiplied.
    """
    new = changes.groupBy(key).agg(F.max(F.struct(*columns)).alias("_new"))
    joined = table.join(new, key, "left")
    updated = {
        c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c))
        for c in columns
    }
    return joined.withColumns(updated).drop("_new")


def update_stored(table: VersionedTable, changes: DataFrame, columns: list[str]) -> None:
    """`update_by_key` in a stored table, by its key: parts without a change keep their files."""
    table.merge(changes, lambda held, rows: update_by_key(held, rows, table.key, columns))


def mark_stored(table: VersionedTable, results: DataFrame) -> None:
    """`mark_processed` in a stored table keyed by mid: parts without a result keep their files."""
    table.merge(results.select(trim_u("mid").alias("mid")), mark_processed)


STRUCTURED_COLUMNS = [
    "structured_json",
    "structured_summary",
    "structured_responsibilities",
    "structured_skills",
    "structured_industry",
    "structured_locations",
    "structured_category_hints",
    "structured_updated_at",
]


def apply_structured(store: DataFrame, payloads: DataFrame) -> DataFrame:
    """Write the structured columns of the postings the model answered for."""
    good = payloads.filter(F.col("error").isNull())
    return update_by_key(store, good, "mid", STRUCTURED_COLUMNS)


def apply_enrichment(taxonomy: DataFrame, payloads: DataFrame) -> DataFrame:
    """Overwrite the enriched fields of the taxonomy rows the model answered for."""
    good = payloads.filter(F.col("error").isNull())
    return update_by_key(taxonomy, good, "code", ["overview", "duties", "keywords", "titles"])


def normalize_job_ids(store: DataFrame, ordinal: str, most_salts: int = 8) -> DataFrame:
    """Replace ids that are not 32 hex digits by a hash of the row.

    The old id stays in `source_mid`. A hash that is already an id in use gets a salted second
    hash, and that a third, until no id is contested; a valid id stays, then the row that needed
    fewer salts, then the earlier one.
    """
    clean = trim_u("mid")
    # Every part is present, so that concat_ws skips none.
    parts = [
        F.col(ordinal).cast("string"),
        *[F.coalesce(c, F.lit("")) for c in (clean, F.col("job_intro"), F.col("source"))],
    ]
    base = F.concat_ws("|", *parts)
    rows = store.withColumns(
        {"source_mid": F.col("mid"), "_valid": F.coalesce(is_job_id(clean), F.lit(False)), "_salt": F.lit(0)}
    ).withColumn("mid", F.when(F.col("_valid"), clean).otherwise(text_key(base)))
    place = F.struct("_salt", ordinal)
    loses = ~F.col("_valid") & F.col("_taken").isNotNull() & (F.col("_taken") | (place != F.col("_first")))
    for salt in range(1, most_salts + 1):
        # Partial aggregation leaves one small row per id and map task.
        contested = (
            rows.groupBy("mid")
            .agg(
                F.bool_or("_valid").alias("_taken"),
                F.min(F.when(~F.col("_valid"), place)).alias("_first"),
                F.max(F.when(~F.col("_valid"), place)).alias("_last"),
            )
            # Equal rows of one place share their hash.
            .filter(F.col("_first").isNotNull() & (F.col("_taken") | (F.col("_first") != F.col("_last"))))
            .drop("_last")
        )
        # Collisions of 128-bit hashes: normally none, so the rows are not shuffled.
        contested = materialize(contested, "contested-ids")
        if contested.isEmpty():
            return rows.drop("_valid", "_salt")
        salted = text_key(
            F.concat_ws("|", F.col(ordinal).cast("string"), F.coalesce(trim_u("source_mid"), F.lit("")),
                        *parts[2:], F.lit(str(salt)))
        )
        rows = (
            rows.join(broadcast_if_bounded(contested), "mid", "left")
            .withColumn("_loses", F.coalesce(loses, F.lit(False)))
            .withColumns(
                {
                    "mid": F.when(F.col("_loses"), salted).otherwise(F.col("mid")),
                    "_salt": F.when(F.col("_loses"), F.lit(salt)).otherwise(F.col("_salt")),
                }
            )
            .drop("_taken", "_first", "_loses")
        )
    raise RuntimeError(f"ids still contested after {most_salts} salts")


def store_counts(store: DataFrame) -> DataFrame:
    """All rows, rows with a text, filtered and processed rows, in one pass."""
    has_text = F.col("job_intro").isNotNull() & (F.col("job_intro") != "")
    return store.agg(
        F.count("*").alias("all_rows"),
        F.count_if(has_text).alias("with_intro"),
        F.count_if(F.col("status") == STATUS_FILTERED).alias("filtered"),
        F.count_if(has_text & (F.col("status") == STATUS_DONE)).alias("processed"),
    )


def import_stats(rows: DataFrame, *by: str) -> DataFrame:
    """Total, imported and filtered rows per file."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(~F.col("is_filtered")).alias("imported"),
        F.count_if("is_filtered").alias("filtered"),
    )
