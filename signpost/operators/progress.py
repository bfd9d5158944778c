"""Row counts per platform and progress over files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signpost.functions.progress import progress_pct, progress_status


def platform_rollup(files: DataFrame) -> DataFrame:
    """Rows per file, per platform and in all.

    `files` has one row per (platform, file) with `row_count`; level 0 is a file,
    1 a platform, 3 everything.
    """
    return files.rollup("platform", "file").agg(
        F.grouping_id().cast("int").alias("level"),
        F.count("*").alias("files"),
        F.sum("row_count").alias("row_count"),
    )


def file_counts(rows: DataFrame, platform: str, file: str) -> DataFrame:
    return rows.groupBy(F.col(platform).alias("platform"), F.col(file).alias("file")).agg(
        F.count("*").alias("row_count")
    )


def count_report(files: DataFrame) -> DataFrame:
    """The roll-up in report order: files by platform and name, platforms, then the total."""
    return platform_rollup(files).orderBy("level", "platform", "file")


def with_progress(files: DataFrame) -> DataFrame:
    """Recompute the percentage and status of each file from its counts."""
    pct = progress_pct("source_lines", F.col("result_lines") + F.col("ignore_lines"))
    return files.withColumn("processed_pct", pct).withColumn(
        "status", progress_status("processed_pct")
    )


def progress_scan(source: DataFrame, output: DataFrame, manifests: DataFrame) -> DataFrame:
    """Progress of every source file from its output counts.

    A valid manifest replaces the counted lines and is authoritative.
    """
    is_valid = (
        F.col("ok")
        & (F.least("total", "processed", "filtered") >= 0)
        & (F.col("processed") + F.col("filtered") == F.col("total"))
    )
    trusted = manifests.filter(is_valid).select("file", "total", "processed", "filtered")
    joined = source.join(output, "file", "left").join(trusted, "file", "left")
    authoritative = F.col("total").isNotNull()
    result = F.coalesce("processed", "result_lines", F.lit(0)).cast("long")
    ignore = F.coalesce("filtered", "ignore_lines", F.lit(0)).cast("long")
    scanned = joined.select(
        "file",
        F.coalesce("total", "source_lines").cast("long").alias("source_lines"),
        result.alias("result_lines"),
        ignore.alias("ignore_lines"),
        (authoritative | (result > 0) | (ignore > 0)).alias("has_output"),
        authoritative.alias("authoritative"),
    )
    # A trusted file counts as complete even when it has no rows at all.
    return with_progress(scanned).withColumn(
        "processed_pct",
        F.when(F.col("authoritative"), F.lit(100.0)).otherwise(F.col("processed_pct")),
    ).withColumn("status", progress_status("processed_pct"))


_FILE_FIELDS = ["source_lines", "result_lines", "ignore_lines"]


def takes_new(old: Column, new: Column) -> Column:
    """Does the new figure of a file replace the old one?

    New file: yes. Authoritative: yes. No output seen: no. Otherwise unless it
    would go back. A stored snapshot is never authoritative.
    """
    old_done = old["result_lines"] + old["ignore_lines"]
    new_done = new["result_lines"] + new["ignore_lines"]
    return (
        F.when(new.isNull(), F.lit(False))
        .when(old.isNull(), F.lit(True))
        .when(new["authoritative"], F.lit(True))
        .when(~new["has_output"], F.lit(False))
        .otherwise(new_done >= old_done)
    )


def merge_progress(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge a scan into the stored snapshot, file by file."""
    left = old.select("file", F.struct(*_FILE_FIELDS).alias("old"))
    right = new.select(
        "file", F.struct(*_FILE_FIELDS, "has_output", "authoritative").alias("new")
    )
    merged = left.join(right, "file", "full_outer").withColumn(
        "take", takes_new(F.col("old"), F.col("new"))
    )
    fields = [
        F.when(F.col("take"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
        for c in _FILE_FIELDS
    ]
    return with_progress(merged.select("file", *fields))


def progress_totals(files: DataFrame) -> DataFrame:
    """Files, completed files, lines, processed lines and the overall percentage."""
    done = F.col("result_lines") + F.col("ignore_lines")
    totals = files.agg(
        F.count("*").alias("total_files"),
        F.count_if(F.col("processed_pct") >= 100).alias("completed_files"),
        F.coalesce(F.sum("source_lines"), F.lit(0)).alias("total_lines"),
        F.coalesce(F.sum(done), F.lit(0)).alias("processed_lines"),
    )
    overall = F.when(
        F.col("total_lines") > 0, F.col("processed_lines") / F.col("total_lines") * 100
    ).otherwise(F.lit(0.0))
    return totals.withColumn("overall_pct", overall)


def throughput(windows: DataFrame, seconds: int) -> DataFrame:
    """Rate of each time window and the average since the start.

    `windows` has window_start and n. Running sums are taken inside a day and
    then shifted by the total of the earlier days, so no single task sees all
    windows.
    """
    daily = windows.withColumn("day", F.to_date("window_start"))
    per_day = daily.groupBy("day").agg(
        F.sum("n").alias("day_n"), F.min("window_start").alias("day_start")
    )
    # One row per day: this window is over days, not over events.
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    ever = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = per_day.select(
        "day",
        F.coalesce(F.sum("day_n").over(before), F.lit(0)).alias("n_before"),
        F.min("day_start").over(ever).alias("first_start"),
    )
    within = Window.partitionBy("day").orderBy("window_start")
    running = daily.withColumn("n_day", F.sum("n").over(within)).join(offsets, "day")
    total = F.col("n_before") + F.col("n_day")
    elapsed = (
        F.unix_timestamp("window_start") - F.unix_timestamp("first_start") + F.lit(seconds)
    )
    return running.select(
        "window_start",
        "n",
        (F.col("n") / F.lit(seconds)).alias("per_second"),
        (total / elapsed).alias("avg_per_second"),
    )
