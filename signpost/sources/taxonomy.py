"""Taxonomy files: a JSON array of loosely typed objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, VariantType

from signpost.functions.text import clean_list, clean_taxonomy_text, parse_list_field
from signpost.schema import (
    TAXONOMY_LIST_FIELDS,
    TAXONOMY_OVERVIEW_FIELD,
    TAXONOMY_TEXT_FIELDS,
)


FIELDS = [*TAXONOMY_TEXT_FIELDS, TAXONOMY_OVERVIEW_FIELD, *TAXONOMY_LIST_FIELDS]
_BROKEN = "_broken"


def _of(record: Column) -> Column:
    """The fields of one record, as VARIANT values; all null if it is no object."""
    return F.struct(*[F.try_variant_get(record, f"$['{n}']", "variant").alias(n) for n in FIELDS])


def _records(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    """One row `v` per record, a struct of VARIANT fields."""
    if lines:
        raw = spark.read.option("singleVariantColumn", "v").json(path)
        return raw.select(_of(F.col("v")).alias("v"))
    schema = StructType([StructField(n, VariantType()) for n in FIELDS] + [StructField(_BROKEN, StringType())])
    options = {"multiLine": "true", "columnNameOfCorruptRecord": _BROKEN}
    raw = spark.read.schema(schema).options(**options).json(path)
    # The reader gives a file with elements that are no objects as a whole. That one is parsed as
    # one value; what is no JSON raises.
    whole = F.parse_json(_BROKEN)
    odd = F.transform(F.try_variant_get(whole, "$", "array<variant>"), _of)
    plain = F.array(F.struct(*[F.col(f"`{n}`").alias(n) for n in FIELDS]))
    return raw.select(F.explode(F.when(F.col(_BROKEN).isNull(), plain).otherwise(odd)).alias("v"))


def _field(name: str) -> Column:
    return F.col(f"v.`{name}`")


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _as_text(value: Column) -> Column:
    """A JSON value as text: strings as they are, others printed; null for null."""
    kind = _kind(value)
    return (
        F.when(kind == "VOID", F.lit(None).cast("string"))
        .when(kind == "STRING", F.try_variant_get(value, "$", "string"))
        .otherwise(F.to_json(value))
    )


def text_field(name: str, keep_scalars: bool = False) -> Column:
    """A text field; other scalars are dropped unless `keep_scalars`."""
    value = _field(name)
    text = _as_text(value) if keep_scalars else F.when(_kind(value) == "STRING", _as_text(value))
    return clean_taxonomy_text(F.coalesce(text, F.lit("")))


def list_field(name: str) -> Column:
    """A list: a JSON array element by element, or a text that holds a list."""
    value = _field(name)
    items = F.try_variant_get(value, "$", "array<variant>")
    listed = clean_list(F.transform(items, _as_text))
    return F.when(F.startswith(_kind(value), F.lit("ARRAY")), listed).otherwise(
        parse_list_field(_as_text(value))
    )


def read_taxonomy(
    spark: SparkSession, path: str, keep_scalars: bool = False, lines: bool = False
) -> DataFrame:
    """Taxonomy rows in file order; rows without a code are skipped.

    A file is one JSON array, or with `lines` one object per line. The objects of an array become
    rows one by one, so an array may be larger than a VARIANT value can be; one with elements that
    are no objects (skipped as well) may not. A file that is no JSON raises.
    """
    raw = _records(spark, path, lines)
    fields = {
        column: text_field(name, keep_scalars) for name, column in TAXONOMY_TEXT_FIELDS.items()
    }
    fields["overview"] = text_field(TAXONOMY_OVERVIEW_FIELD, keep_scalars=True)
    for name, column in TAXONOMY_LIST_FIELDS.items():
        fields[column] = list_field(name)
    rows = raw.select(
        *[c.alias(n) for n, c in fields.items()],
        F.monotonically_increasing_id().alias("ordinal"),
    )
    return rows.filter(F.col("code") != "")
