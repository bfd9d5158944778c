"""Reading the given tables and cutting lineage, shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signpost.session import materialize, ship_package

__all__ = ["documents", "grid", "materialize", "read", "ship_package", "unique_name"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def unique_name(frame: DataFrame, stem: str) -> str:
    """A column name that no column of `frame` has, in any case."""
    taken = {name.lower() for name in frame.columns}
    name, n = f"_{stem}", 0
    while name.lower() in taken:
        n += 1
        name = f"_{stem}_{n}"
    return name


def grid(key: Column, bounds: list[int]) -> Column:
    """The number of `bounds` (sorted) that lie below `key`, by binary search; 0 for null.

    The bounds travel inside the plan, so their number must be small and known.
    """
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    held = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.try_element_at(held, at + step) < key), at + step
        ).otherwise(at),
    )
