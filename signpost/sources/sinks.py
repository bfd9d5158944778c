"""Writers. Every one replaces its target as a whole, so a rerun leaves no duplicates.

Vectors, neighbours and the enriched taxonomy become visible by one rename; `read_table` and
`enriched_folder` find what is current.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signpost.functions.payloads import taxonomy_metadata
from signpost.functions.text import is_blank, trim_u
from signpost.functions.vectors import normalize_vector
from signpost.operators.reconcile import dedup_keep_first
from signpost.operators.store import apply_enrichment
from signpost.schema import TAXONOMY_LIST_FIELDS, TAXONOMY_OVERVIEW_FIELD, TAXONOMY_TEXT_FIELDS
from signpost.session import materialize
from signpost.sources.versions import VersionedTable, replace_table

_CSV = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "lineSep": "\n"}


def write_results(results: DataFrame, path: str) -> None:
    """Result rows as CSV, scores with four decimals."""
    text = results.withColumn("similarity_score", F.format_string("%.4f", "similarity_score"))
    text.write.mode("overwrite").options(**_CSV).csv(path)


def write_ignored(ignored_rows: DataFrame, path: str) -> None:
    ignored_rows.select("mid", "job_intro").write.mode("overwrite").options(**_CSV).csv(path)


def vector_rows(embedded: DataFrame, listed_once: bool = False) -> DataFrame:
    """Taxonomy rows with `document` and a raw `embedding` -> entries of the vector table.

    One entry per code: the first row of a code that has a vector. Where every code is known to be
    listed once, no vector is shuffled for that.
    """
    unit = embedded.filter(F.coalesce("code", F.lit("")) != "").select(
        "code",
        normalize_vector("embedding").alias("embedding"),
        "document",
        taxonomy_metadata().alias("metadata"),
        "ordinal",
    )
    entries = unit.filter(F.col("embedding").isNotNull())
    if listed_once:
        return entries.filter(~is_blank("code")).withColumn("code", trim_u("code"))
    return dedup_keep_first(entries, "code", "ordinal")


def write_vectors(entries: DataFrame, path: str) -> None:
    """The vector table, keyed by code: importing again replaces it."""
    replace_table(entries, path)


def write_neighbors(edges: DataFrame, path: str) -> None:
    replace_table(edges.select("job_id", "neighbor_id", "score"), path)


def manifest_lines(manifests: DataFrame, file: str = "file") -> DataFrame:
    """One text per manifest, in the form the reader parses."""
    keys = ["total", "processed", "filtered", "db", "ok"]
    lines = [F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys]
    return manifests.select(F.col(file).alias("file"), F.concat_ws("\n", *lines).alias("value"))


def write_manifests(manifests: DataFrame, path: str, file: str = "file") -> None:
    """One folder per file name. Give it only rows whose counts agree."""
    manifest_lines(manifests, file).write.mode("overwrite").partitionBy("file").text(path)


def enriched_documents(taxonomy: DataFrame) -> DataFrame:
    """Taxonomy rows under the field names of the file format."""
    names = {
        **{c: f for f, c in TAXONOMY_TEXT_FIELDS.items()},
        "overview": TAXONOMY_OVERVIEW_FIELD,
        **{c: f for f, c in TAXONOMY_LIST_FIELDS.items()},
    }
    return taxonomy.select(*[F.col(c).alias(f) for c, f in names.items() if c in taxonomy.columns])


def write_enriched_taxonomy(taxonomy: DataFrame, payloads: DataFrame, path: str) -> bool:
    """Write the taxonomy with its payloads only when no record failed; tells whether it did.

    The payloads are written first, so what is checked is what is applied and no model is asked
    twice. Without them, or after a failure before the switch, the earlier file stays.
    """
    answers = materialize(payloads, "enrichment")
    if not answers.filter(F.col("error").isNotNull()).isEmpty():
        return False
    replace_table(enriched_documents(apply_enrichment(taxonomy, answers)), path, "json")
    return True


def enriched_folder(spark: SparkSession, path: str) -> str:
    """The folder of the enriched taxonomy as it now stands, for `read_taxonomy(lines=True)`."""
    return VersionedTable(spark, path, form="json").folders()[0]
