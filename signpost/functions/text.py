"""Text clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost.schema import MIN_INTRO_CHARS, RESULT_TEXT_CHARS, WHITE_SPACE

_LIST_SEPARATORS = "[；;，,\n\r]"


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_u(value) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.btrim(_c(value), F.lit(WHITE_SPACE))


def is_blank(value) -> Column:
    """True for null and for text of white space only."""
    return F.coalesce(trim_u(value), F.lit("")) == ""


def is_short(intro, min_chars: int = MIN_INTRO_CHARS) -> Column:
    """Trimmed text has fewer than `min_chars` code points."""
    return F.char_length(F.coalesce(trim_u(intro), F.lit(""))) < min_chars


def flatten_breaks(value) -> Column:
    """Line breaks and tabs become one blank each."""
    no_crlf = F.replace(_c(value), F.lit("\r\n"), F.lit(" "))
    return F.translate(no_crlf, "\n\r\t", "   ")


def clean_cell(value) -> Column:
    return trim_u(flatten_breaks(value))


def truncate_text(value, limit: int = RESULT_TEXT_CHARS) -> Column:
    """Clean a cell and cut it at `limit` code points, marking the cut."""
    cell = clean_cell(value)
    return F.when(
        F.char_length(cell) > limit, F.concat(F.left(cell, F.lit(limit)), F.lit("..."))
    ).otherwise(cell)


def preview_text(value, limit: int) -> Column:
    """Trim only, then cut: line breaks stay."""
    cell = trim_u(value)
    return F.when(
        F.char_length(cell) > limit, F.concat(F.left(cell, F.lit(limit)), F.lit("..."))
    ).otherwise(cell)


def safe_metadata(value, legacy_quotes: bool = False) -> Column:
    """Metadata as one line of text; missing is empty.

    `legacy_quotes` doubles quotes here although the CSV writer escapes them again.
    """
    text = F.coalesce(flatten_breaks(value), F.lit(""))
    return F.replace(text, F.lit('"'), F.lit('""')) if legacy_quotes else text


def clean_taxonomy_text(value) -> Column:
    """Drop bold marks, then trim."""
    return trim_u(F.replace(_c(value), F.lit("**"), F.lit("")))


def clean_list(values) -> Column:
    """Clean each element and drop what is blank."""
    cleaned = F.transform(_c(values), lambda x: clean_taxonomy_text(F.coalesce(x, F.lit(""))))
    return F.filter(cleaned, lambda x: x != "")


def strict_json(value) -> Column:
    """JSON text as a variant; null unless the whole text is one JSON value.

    The parser stops at the end of the first value. Text after it would close
    an array or an object too early or add members, so one of the two wrapped
    forms fails.
    """
    text = _c(value)
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when(in_object.isNotNull(), F.try_variant_get(in_array, "$[0]", "variant"))


def parse_list_field(value) -> Column:
    """Text holding a list -> cleaned array; blank gives an empty array.

    A bracketed text that is a JSON array of strings is decoded. Anything else
    is split at list separators; with a single part the whole text is kept.
    """
    text = trim_u(value)
    json_type = F.schema_of_variant(strict_json(text))
    is_string_array = (
        F.startswith(text, F.lit("["))
        & F.endswith(text, F.lit("]"))
        & F.coalesce(json_type.isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit(False))
    )
    parts = F.filter(F.split(text, _LIST_SEPARATORS), lambda x: x != "")
    raw = (
        F.when(is_string_array, F.from_json(text, "array<string>"))
        .when(F.size(parts) > 1, parts)
        .otherwise(F.array(text))
    )
    empty = F.array().cast("array<string>")
    return F.when(F.coalesce(text, F.lit("")) == "", empty).otherwise(clean_list(raw))


def text_key(value) -> Column:
    """128-bit key of a text: the first half of its SHA-256, in hex."""
    return F.left(F.sha2(_c(value), 256), F.lit(32))


def is_job_id(value) -> Column:
    """Exactly 32 hexadecimal digits."""
    return F.rlike(_c(value), F.lit("^[0-9a-fA-F]{32}\\z"))


def record_label(*levels, ordinal) -> Column:
    """First non-empty code from fine to coarse, else a label made of the position."""
    named = [F.nullif(_c(level), F.lit("")) for level in levels]
    return F.coalesce(*named, F.concat(F.lit("记录#"), (_c(ordinal) + 1).cast("string")))


def utc_stamp(value) -> Column:
    """RFC 3339 text in UTC, to the second (session time zone is UTC)."""
    return F.date_format(_c(value), "yyyy-MM-dd'T'HH:mm:ss'Z'")
