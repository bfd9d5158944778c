"""Do source, store, result and ignored rows agree? Repair where they do not."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signpost.functions.text import is_blank, is_short, trim_u
from signpost.operators.routing import pending_match
from signpost.schema import MIN_INTRO_CHARS, STATUS_FILTERED


def result_ids(results: DataFrame) -> DataFrame:
    """Distinct non-blank ids of a result."""
    return results.filter(~is_blank("mid")).select(trim_u("mid").alias("mid")).distinct()


def eligible_ids(store: DataFrame) -> DataFrame:
    return (
        pending_match(store)
        .filter(~is_blank("mid"))
        .select(trim_u("mid").alias("mid"))
        .distinct()
    )


def distinct_results(results: DataFrame) -> DataFrame:
    """Rows and distinct ids of a result."""
    return results.agg(
        F.count("*").alias("rows"),
        F.count_distinct(F.nullif(trim_u("mid"), F.lit(""))).alias("unique_ids"),
    )


def duplicate_results(results: DataFrame) -> DataFrame:
    """Ids with more than one row, and how many rows they have."""
    return (
        results.filter(~is_blank("mid"))
        .groupBy(trim_u("mid").alias("mid"))
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def dedup_keep_first(
    rows: DataFrame, key: str = "mid", ordinal: str = "ordinal", drop: DataFrame | None = None
) -> DataFrame:
    """First row per id in input order; blank ids and ids in `drop` are removed.

    The rank filter is applied on the map side first, so a hot id sends one row
    per map task. Unwanted ids go after that, in the same partitioning.
    """
    named = rows.filter(~is_blank(key)).withColumn(key, trim_u(key))
    first = Window.partitionBy(key).orderBy(F.col(ordinal))
    kept = named.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    return kept if drop is None else kept.join(drop.select(key), key, "left_anti")


def is_listed_once(rows: DataFrame, key: str = "mid") -> bool:
    """Has every non-blank id one row? Looks at the ids alone."""
    ids = rows.filter(~is_blank(key)).agg(F.count("*").alias("n"), F.count_distinct(trim_u(key)).alias("ids"))
    known = ids.first()
    return known["n"] == known["ids"]


def diff_result_store(results: DataFrame, store: DataFrame, sample: int = 10) -> DataFrame:
    """One row: valid, missing and extra ids, and the smallest missing ones."""
    both = _presence(results, store)
    missing = F.col("in_store").isNotNull() & F.col("in_result").isNull()
    counts = both.agg(
        F.count_if(F.col("in_store").isNotNull() & F.col("in_result").isNotNull()).alias("valid"),
        F.count_if(missing).alias("missing"),
        F.count_if(F.col("in_store").isNull()).alias("extras"),
    ).withColumn("missing_sample", F.lit(None).cast("string"))
    smallest = (
        both.filter(missing)
        .orderBy("mid")
        .limit(sample)
        .agg(F.array_join(F.array_sort(F.collect_list("mid")), ",").alias("missing_sample"))
    )
    zero = F.lit(0).cast("long")
    smallest = smallest.select(
        zero.alias("valid"), zero.alias("missing"), zero.alias("extras"), "missing_sample"
    )
    return counts.unionByName(smallest).agg(
        F.sum("valid").alias("valid"),
        F.sum("missing").alias("missing"),
        F.sum("extras").alias("extras"),
        F.coalesce(F.max("missing_sample"), F.lit("")).alias("missing_sample"),
    )


def missing_sample(results: DataFrame, store: DataFrame, sample: int = 10) -> DataFrame:
    """The smallest ids without a result row."""
    return eligible_ids(store).join(result_ids(results), "mid", "left_anti").orderBy("mid").limit(
        sample
    )


def _presence(results: DataFrame, store: DataFrame) -> DataFrame:
    left = eligible_ids(store).withColumn("in_store", F.lit(True))
    right = result_ids(results).withColumn("in_result", F.lit(True))
    return left.join(right, "mid", "full_outer")


def drop_extras(results: DataFrame, store: DataFrame) -> DataFrame:
    """Result rows whose id is an eligible posting of the store."""
    cleaned = results.withColumn("mid", trim_u("mid"))
    return cleaned.join(eligible_ids(store), "mid", "left_semi")


def result_except_store(results: DataFrame, store: DataFrame) -> DataFrame:
    return result_ids(results).subtract(eligible_ids(store))


def result_intersect_store(results: DataFrame, store: DataFrame) -> DataFrame:
    return result_ids(results).intersect(eligible_ids(store))


def routed_union(results: DataFrame, ignored_rows: DataFrame, source: DataFrame) -> DataFrame:
    """Per route: distinct ids, and how many of them the source has.

    Result and ignored ids together must cover the source without overlap.
    """
    routed = result_ids(results).withColumn("route", F.lit("result")).unionByName(
        result_ids(ignored_rows).withColumn("route", F.lit("ignored"))
    )
    per_id = routed.groupBy("mid").agg(
        F.when(F.count("*") > 1, F.lit("both")).otherwise(F.max("route")).alias("route")
    )
    in_source = result_ids(source).withColumn("in_source", F.lit(True))
    return (
        per_id.join(in_source, "mid", "full_outer")
        .groupBy(F.coalesce("route", F.lit("unrouted")).alias("route"))
        .agg(F.count("*").alias("ids"), F.count_if(F.col("in_source")).alias("in_source"))
    )


def reconcile(
    source: DataFrame,
    store: DataFrame,
    results: DataFrame,
    ignored_rows: DataFrame,
    file: str = "file",
    min_chars: int = MIN_INTRO_CHARS,
) -> DataFrame:
    """Per file: the counts that have to agree, and which repairs are due.

    Each input is reduced to one row per file before anything is joined.
    """
    origin = source.filter(~is_blank("mid")).groupBy(file).agg(
        F.count("*").alias("total"),
        F.count_if(is_short("job_intro", min_chars)).alias("origin_filtered"),
        (F.count("*") - F.count_distinct(trim_u("mid"))).alias("duplicate_ids"),
    )
    stored = store.groupBy(file).agg(
        F.count("*").alias("db"),
        F.count_if(F.col("status") == STATUS_FILTERED).alias("db_filtered"),
    )
    per_id = (
        results.filter(~is_blank("mid"))
        .groupBy(file, trim_u("mid").alias("mid"))
        .agg(F.count("*").alias("copies"))
    )
    # A row with a blank id counts as a row, not as an id.
    blank = results.filter(is_blank("mid")).groupBy(file).agg(F.count("*").alias("blank_rows"))
    eligible = (
        pending_match(store).select(file, trim_u("mid").alias("mid")).distinct()
        .withColumn("eligible", F.lit(True))
    )
    written = (
        per_id.join(eligible, [file, "mid"], "left")
        .groupBy(file)
        .agg(
            F.sum("copies").alias("keyed_rows"),
            F.count("*").alias("unique_ids"),
            F.count_if(F.col("eligible")).alias("valid_ids"),
        )
    )
    dropped = ignored_rows.groupBy(file).agg(F.count("*").alias("ignore_rows"))
    joined = origin
    for part in (stored, written, blank, dropped):
        joined = joined.join(part, file, "full_outer")
    counts = [c for c in joined.columns if c != file]
    joined = joined.select(file, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])
    joined = joined.withColumn("result_rows", F.col("keyed_rows") + F.col("blank_rows"))
    flags = {
        "ok": (F.col("result_rows") + F.col("ignore_rows") == F.col("total"))
        & (F.col("db") == F.col("total")),
        "need_reimport": F.col("db") < F.col("total"),
        "need_rebuild": F.col("db") > F.col("total"),
        "need_status_fix": F.col("db_filtered") != F.col("origin_filtered"),
        "need_ignore_fix": F.col("ignore_rows") != F.col("origin_filtered"),
        "need_rewrite": (F.col("result_rows") != F.col("unique_ids"))
        | (F.col("unique_ids") != F.col("valid_ids")),
        "need_backfill": F.col("valid_ids") < F.col("total") - F.col("origin_filtered"),
    }
    return joined.withColumns(flags).select(
        file,
        "total",
        "origin_filtered",
        "duplicate_ids",
        "db",
        "db_filtered",
        "ignore_rows",
        "result_rows",
        "unique_ids",
        "valid_ids",
        *flags,
    )


def manifest_rows(reconciled: DataFrame, file: str = "file") -> DataFrame:
    """The manifest of every file whose counts agree; others get none."""
    return reconciled.filter("ok").select(
        file,
        "total",
        F.col("result_rows").alias("processed"),
        F.col("ignore_rows").alias("filtered"),
        "db",
        "ok",
    )
