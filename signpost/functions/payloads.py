"""JSON payloads, embedding texts and prompts as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from signpost.functions.text import _c, is_blank, strict_json, trim_u
from signpost.schema import (
    ENRICHMENT_TYPE,
    HINT_CONFIDENCE,
    HINT_NAME,
    PAYLOAD_DUTIES,
    PAYLOAD_HINTS,
    PAYLOAD_INDUSTRY,
    PAYLOAD_LOCATIONS,
    PAYLOAD_SKILLS,
    PAYLOAD_SUMMARY,
    PAYLOAD_TYPE,
    TAXONOMY_LIST_FIELDS,
    TAXONOMY_OVERVIEW_FIELD,
)

_TEXT = ("STRING", "VOID")
_TEXTS = ("ARRAY<STRING>", "ARRAY<VOID>", "VOID")


def _field_type(variant: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(variant, f"$['{field}']", "variant"))


def _type_ok(variant: Column, field: str, allowed) -> Column:
    """A missing field is fine; a present one needs an allowed JSON type."""
    return F.coalesce(_field_type(variant, field).isin(*allowed), F.lit(True))


def _is_number(kind: Column) -> Column:
    return F.coalesce(
        kind.isin("BIGINT", "DOUBLE", "FLOAT", "VOID") | F.startswith(kind, F.lit("DECIMAL")),
        F.lit(True),
    )


def _hints_ok(variant: Column) -> Column:
    """Every hint is an object with a text name and a numeric confidence."""
    kind = _field_type(variant, PAYLOAD_HINTS)
    items = F.try_variant_get(variant, f"$['{PAYLOAD_HINTS}']", "array<variant>")

    def bad(item: Column) -> Column:
        item_kind = F.schema_of_variant(item)
        shaped = F.startswith(item_kind, F.lit("OBJECT")) | (item_kind == "VOID")
        return ~(
            F.coalesce(shaped, F.lit(True))
            & _type_ok(item, HINT_NAME, _TEXT)
            & _is_number(_field_type(item, HINT_CONFIDENCE))
        )

    listed = F.startswith(kind, F.lit("ARRAY"))
    fine = F.when(listed, ~F.coalesce(F.exists(items, bad), F.lit(False))).otherwise(kind == "VOID")
    return F.coalesce(fine, F.lit(True))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often `use` refers to it.

    Inside a condition Spark evaluates each reference anew, a parse of a text included.
    """
    return F.transform(F.array(value), use)[0]


def _is_typed(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    shaped = F.startswith(kind, F.lit("OBJECT")) | (kind == "VOID")
    checks = (
        F.coalesce(shaped, F.lit(False))
        & _type_ok(v, PAYLOAD_SUMMARY, _TEXT)
        & _type_ok(v, PAYLOAD_DUTIES, _TEXTS)
        & _type_ok(v, PAYLOAD_SKILLS, _TEXTS)
        & _type_ok(v, PAYLOAD_INDUSTRY, _TEXT)
        & _type_ok(v, PAYLOAD_LOCATIONS, _TEXTS)
    )
    return checks & _hints_ok(v)


def structured_is_typed(raw) -> Column:
    """The text is JSON and each known field has its declared type."""
    return _bound(strict_json(raw), _is_typed)


def _labelled(label: str, value: Column) -> Column:
    """`label: value`, or null (so that concat_ws skips it) when empty."""
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}: "), value))


def _labelled_list(label: str, values: Column, sep: str) -> Column:
    # A null element of a JSON list is an empty text.
    joined = F.array_join(F.transform(values, lambda x: F.coalesce(x, F.lit(""))), sep)
    return F.when(F.size(values) > 0, F.concat(F.lit(f"{label}: "), joined))


def two_decimals(value: Column) -> Column:
    """A number with two decimals, rounded from its exact binary value, ties to even.

    Java's own formatting rounds the shortest decimal form instead; it is left with numbers of
    2^63 and more, which have no decimals, and those that are no numbers.
    """
    mask, half, limit = F.lit(2**31 - 1), F.lit(2**61), F.lit(float(2**63))

    def parts(x: Column) -> Column:
        # The fraction is exact, and so is its scaling by 2^62, whose upper and lower 31 bits are
        # multiplied by 100 apart, as the whole product does not fit a long.
        size = F.when(F.abs(x) < limit, F.abs(x))
        scaled = ((size - F.floor(size)) * F.lit(float(2**62))).cast("long")
        low = scaled.bitwiseAND(mask) * 100
        high = F.shiftright(scaled, 31) * 100 + F.shiftright(low, 31)
        return F.struct(x.alias("x"), F.floor(size).alias("units"), high.alias("high"), low.alias("low"))

    def cents(p: Column) -> Column:
        whole = F.shiftright(p["high"], 31)
        rest = F.shiftleft(p["high"].bitwiseAND(mask), 31) + p["low"].bitwiseAND(mask)
        up = (rest > half) | ((rest == half) & (whole % 2 == 1))
        return F.struct(p["x"].alias("x"), p["units"].alias("units"), (whole + up.cast("long")).alias("cents"))

    def text(c: Column) -> Column:
        exact = F.concat(
            F.when(c["x"] < 0, F.lit("-")).otherwise(F.lit("")),
            (c["units"] + F.floor(c["cents"] / 100)).cast("string"),
            F.lit("."),
            F.lpad((c["cents"] % 100).cast("string"), 2, "0"),
        )
        return F.when(F.abs(c["x"]) < limit, exact).otherwise(F.format_string("%.2f", c["x"]))

    return _bound(value, lambda x: _bound(parts(x), lambda p: _bound(cents(p), text)))


def _payload_lines(p: Column) -> Column:
    named = F.filter(p[PAYLOAD_HINTS], lambda h: F.coalesce(h[HINT_NAME], F.lit("")) != "")
    hints = F.transform(
        named,
        lambda h: F.concat(
            h[HINT_NAME],
            F.lit("(信心"),
            two_decimals(F.coalesce(h[HINT_CONFIDENCE], F.lit(0.0))),
            F.lit(")"),
        ),
    )
    return F.concat_ws(
        "\n",
        _labelled(PAYLOAD_SUMMARY, p[PAYLOAD_SUMMARY]),
        _labelled_list(PAYLOAD_DUTIES, p[PAYLOAD_DUTIES], "；"),
        _labelled_list(PAYLOAD_SKILLS, p[PAYLOAD_SKILLS], "；"),
        _labelled(PAYLOAD_INDUSTRY, p[PAYLOAD_INDUSTRY]),
        _labelled_list(PAYLOAD_LOCATIONS, p[PAYLOAD_LOCATIONS], "；"),
        _labelled_list("大类猜测", hints, "；"),
    )


def format_structured(raw) -> Column:
    """Readable lines of a structured payload; the raw text where it does not parse."""
    raw = _c(raw)
    lines = _bound(F.from_json(raw, PAYLOAD_TYPE), _payload_lines)
    return F.when(is_blank(raw), F.lit("")).when(structured_is_typed(raw), lines).otherwise(raw)


def posting_embedding_text(structured, intro, source, status, category) -> Column:
    """Structured lines, if any, followed by the plain fields of a posting."""
    head = F.nullif(F.coalesce(format_structured(structured), F.lit("")), F.lit(""))

    def line(label: str, value) -> Column:
        return F.concat(F.lit(f"{label}: "), F.coalesce(_c(value), F.lit("")))

    return F.concat_ws(
        "\n",
        head,
        line("岗位描述", intro),
        line("来源", source),
        line("状态", status),
        line("分类", category),
    )


def taxonomy_embedding_text(for_graph: bool = False) -> Column:
    """Text of a taxonomy row for the embedding model.

    Uses the enriched fields; only a row without any falls back to its level
    names. The graph form always adds the code and its own description.
    """
    enriched = [
        _labelled("岗位概述", F.col("overview")),
        _labelled_list("核心职责" if for_graph else "典型职责", F.col("duties"), "；"),
        _labelled_list("关联关键词", F.col("keywords"), "、"),
        _labelled_list("典型岗位", F.col("titles"), "、"),
    ]

    def always(label: str, name: str) -> Column:
        return F.concat(F.lit(f"{label}: "), F.coalesce(F.col(name), F.lit("")))

    levels = [
        always("大类", "big"),
        _labelled("大类含义", F.col("big_meaning")),
        always("中类", "middle"),
        _labelled("中类含义", F.col("middle_meaning")),
        always("小类", "small"),
        _labelled("小类含义", F.col("small_meaning")),
    ]
    own = [always("职业", "code"), _labelled("职业含义", F.col("code_meaning"))]
    has_enriched = F.coalesce(*enriched).isNotNull()
    if for_graph:
        own += [
            _labelled("主要任务", F.col("tasks")),
            _labelled("包含工种", F.col("included_jobs")),
        ]
        return F.when(has_enriched, F.concat_ws("\n", *enriched, *own)).otherwise(
            F.concat_ws("\n", *levels, *own)
        )
    own.append(_labelled("工作任务", F.col("tasks")))
    return F.when(has_enriched, F.concat_ws("\n", *enriched)).otherwise(
        F.concat_ws("\n", *levels, *own)
    )


def taxonomy_metadata() -> Column:
    """Metadata stored next to a vector: 11 texts always, 4 enriched ones when present."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    def joined(name: str, sep: str) -> Column:
        return F.nullif(F.array_join(F.col(name), sep), F.lit(""))

    return F.struct(
        text("big").alias("大类"),
        text("big_meaning").alias("大类含义"),
        text("middle").alias("中类"),
        text("middle_meaning").alias("中类含义"),
        text("small").alias("小类"),
        text("small_meaning").alias("小类含义"),
        text("code").alias("细类职业"),
        text("code_meaning").alias("细类含义"),
        text("included_jobs").alias("细类包含工种"),
        text("tasks").alias("细类主要工作任务"),
        text("source_row").alias("源行号"),
        F.nullif(F.col("overview"), F.lit("")).alias("LLM岗位概述"),
        joined("duties", "；").alias("LLM典型职责"),
        joined("keywords", "、").alias("LLM关联关键词"),
        joined("titles", "、").alias("LLM典型岗位"),
    )


def extract_json(value) -> Column:
    """From the first `{` to the last `}`, null unless that is valid JSON."""
    text = _c(value)
    start = F.instr(text, "{")
    tail = F.substring_index(text, "}", -1)
    end = F.char_length(text) - F.char_length(tail)
    candidate = F.when(
        (start > 0) & F.contains(text, F.lit("}")) & (end > start),
        F.substring(text, start, end - start + 1),
    )
    return F.when(strict_json(candidate).isNotNull(), candidate)


def strip_code_fence(value) -> Column:
    """Remove a Markdown fence and its optional `json` tag around a reply."""
    fence = "```"
    text = trim_u(value)
    inner = trim_u(F.substring(text, 4, 2**31 - 1))
    inner = F.when(
        F.startswith(F.lower(inner), F.lit("json")), trim_u(F.substring(inner, 5, 2**31 - 1))
    ).otherwise(inner)
    tail = F.substring_index(inner, fence, -1)
    body = F.when(
        F.contains(inner, F.lit(fence)),
        F.left(inner, F.char_length(inner) - F.char_length(tail) - 3),
    ).otherwise(inner)
    return F.when(F.startswith(text, F.lit(fence)), trim_u(body)).otherwise(text)


def normalize_json(value) -> Column:
    """Reparse and print with sorted keys (compact); null where it is no JSON."""
    return F.to_json(strict_json(value))


def json_or_default(value, default: str = "[]") -> Column:
    """A JSON fragment, or the default where it is blank or invalid."""
    text = trim_u(value)
    return F.when(strict_json(text).isNotNull(), text).otherwise(F.lit(default))


def null_if_blank(value) -> Column:
    return F.when(~is_blank(value), _c(value))


def decode_enrichment(reply) -> Column:
    """Model reply -> struct of the four enriched fields; null where it does not decode."""
    text = strip_code_fence(reply)
    v = strict_json(text)
    kind = F.schema_of_variant(v)
    typed = F.coalesce(F.startswith(kind, F.lit("OBJECT")) | (kind == "VOID"), F.lit(False))
    typed = typed & _type_ok(v, TAXONOMY_OVERVIEW_FIELD, _TEXT)
    for field in TAXONOMY_LIST_FIELDS:
        typed = typed & _type_ok(v, field, _TEXTS)
    return F.when(typed, F.from_json(text, ENRICHMENT_TYPE))


def validate_enrichment(overview, duties, keywords, titles) -> Column:
    """Name of the first missing field, null when the record is complete."""
    check = F.when(is_blank(overview), F.lit(TAXONOMY_OVERVIEW_FIELD))
    for column, field in zip((duties, keywords, titles), TAXONOMY_LIST_FIELDS):
        check = check.when(F.coalesce(F.size(_c(column)), F.lit(0)) < 1, F.lit(field))
    return check


def taxonomy_prompt() -> Column:
    """Prompt asking a model to enrich one taxonomy row: its non-blank fields, then the task."""
    labels = {
        "大类": "big",
        "大类含义": "big_meaning",
        "中类": "middle",
        "中类含义": "middle_meaning",
        "小类": "small",
        "小类含义": "small_meaning",
        "细类（职业）": "code",
        "细类含义": "code_meaning",
        "细类主要工作任务": "tasks",
        "细类包含工种": "included_jobs",
    }
    lines = [
        F.when(~is_blank(name), F.concat(F.lit(f"{label}: "), F.col(name)))
        for label, name in labels.items()
    ]
    fields = ", ".join([TAXONOMY_OVERVIEW_FIELD, *TAXONOMY_LIST_FIELDS])
    return F.concat_ws("\n", *lines, F.lit(f"Reply with one JSON object: {fields}."))


def posting_prompt(mid, source, category, intro) -> Column:
    """Prompt asking a model to structure one posting; a missing category reads 未分类."""
    known = F.coalesce(F.nullif(_c(category), F.lit("")), F.lit("未分类"))
    fields = ", ".join(
        [
            PAYLOAD_SUMMARY,
            PAYLOAD_DUTIES,
            PAYLOAD_SKILLS,
            PAYLOAD_INDUSTRY,
            PAYLOAD_LOCATIONS,
            PAYLOAD_HINTS,
        ]
    )
    return F.concat_ws(
        "\n",
        F.lit(f"Reply with one JSON object: {fields}."),
        F.concat(F.lit("岗位ID: "), _c(mid)),
        F.concat(F.lit("来源: "), F.coalesce(_c(source), F.lit(""))),
        F.concat(F.lit("已有分类: "), known),
        F.concat(F.lit("岗位描述: "), trim_u(intro)),
    )
