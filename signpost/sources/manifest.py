"""Count manifests: small `key=value` text files that certify a finished file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signpost.functions.text import trim_u

_NUMBERS = ["total", "processed", "filtered", "db"]


def parse_manifests(lines: DataFrame, need_db: bool = True) -> DataFrame:
    """Lines (`path`, `value`, `line_no`) -> one row per readable manifest.

    Unknown keys are ignored and the last value of a key counts. A line without
    `=`, a value that does not parse or a missing key spoils the manifest. `ok`
    is what the file says; `is_valid` also checks that the counts agree.
    """
    numbers = _NUMBERS if need_db else _NUMBERS[:-1]
    text = trim_u("value")
    kept = lines.withColumn("text", text).filter(F.col("text") != "")
    pair = F.split("text", "=", 2)
    kept = kept.select(
        "path",
        "line_no",
        (F.size(pair) < 2).alias("no_pair"),
        trim_u(F.try_element_at(pair, F.lit(1))).alias("key"),
        trim_u(F.try_element_at(pair, F.lit(2))).alias("val"),
    )
    is_int = F.rlike(F.col("val"), F.lit("^[+-]?[0-9]+\\z"))
    number = F.when(is_int, F.col("val").try_cast("long"))
    flag = (
        F.when(F.lower("val") == "true", F.lit(True)).when(F.lower("val") == "false", F.lit(False))
    )
    unreadable = (
        F.col("no_pair")
        | (F.col("key").isin(*numbers) & number.isNull())
        | ((F.col("key") == "ok") & flag.isNull())
    )

    def last(key: str, value):
        mine = F.col("key") == key
        return F.max_by(F.when(mine, value), F.when(mine, F.col("line_no"))).alias(key)

    parsed = kept.groupBy("path").agg(
        F.bool_or(F.coalesce(unreadable, F.lit(False))).alias("spoiled"),
        *[last(n, number) for n in numbers],
        last("ok", flag),
    )
    complete = ~F.col("spoiled") & F.col("ok").isNotNull()
    for n in numbers:
        complete = complete & F.col(n).isNotNull()
    counts_agree = (
        F.col("ok")
        & (F.least(*numbers) >= 0)
        & (F.col("processed") + F.col("filtered") == F.col("total"))
    )
    if need_db:
        counts_agree = counts_agree & (F.col("db") == F.col("total"))
    return parsed.filter(complete).drop("spoiled").withColumn("is_valid", counts_agree)


def read_manifests(spark: SparkSession, path: str, need_db: bool = True) -> DataFrame:
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        "value",
        # Rows of one small file are numbered in order within its task.
        F.monotonically_increasing_id().alias("line_no"),
    )
    return parse_manifests(lines, need_db)
