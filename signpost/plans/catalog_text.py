"""Queries: filters, routing and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from signpost.functions import payloads as P
from signpost.functions import text as X
from signpost.functions.progress import progress_pct, progress_status
from signpost.operators import routing, store
from signpost.plans import views as V
from signpost.plans.registry import query
from signpost.plans.views import trim_sql
from signpost.schema import (
    HINT_CONFIDENCE,
    HINT_NAME,
    PAYLOAD_DUTIES,
    PAYLOAD_HINTS,
    PAYLOAD_INDUSTRY,
    PAYLOAD_LOCATIONS,
    PAYLOAD_SKILLS,
    PAYLOAD_SUMMARY,
    PREVIEW_CHARS,
    STATUS_FILTERED,
)
from signpost.sources.delimited import source_tag

# --- filters --------------------------------------------------------------------


@query(
    "valid_rows",
    f"""SELECT {trim_sql('mid')} AS mid, length({trim_sql('job_intro')}) AS n FROM (
          SELECT role AS mid, text AS job_intro FROM conversations
          UNION ALL SELECT ' ', r_name FROM region)
        WHERE {trim_sql('mid')} <> ''""",
)
def valid_rows(spark, sf):
    talk = V.table(spark, sf, "conversations").select(
        F.concat(F.lit(" "), "role", F.lit("　")).alias("mid"), F.col("text").alias("job_intro")
    )
    blank = V.table(spark, sf, "region").select(
        F.lit(" ").alias("mid"), F.col("r_name").alias("job_intro")
    )
    kept = routing.valid_rows(talk.unionByName(blank))
    return kept.select("mid", F.char_length("job_intro").cast("long").alias("n"))


@query(
    "route_short",
    f"""SELECT CAST(doc_id AS VARCHAR) AS mid,
          length({trim_sql('text')}) < {V.SHORT_CHARS} AS is_filtered FROM documents""",
)
def route_short(spark, sf):
    return V.routed_postings(spark, sf).select("mid", "is_filtered")


@query(
    "valid_job_id",
    """SELECT mid, regexp_full_match(mid, '[0-9a-fA-F]{32}') AS is_valid FROM (
         SELECT substr(sha256(url), 1, 32) AS mid FROM pages
         UNION ALL SELECT upper(substr(sha256(url), 1, 32)) FROM pages
         UNION ALL SELECT substr(sha256(url), 1, 31) || chr(10) FROM pages
         UNION ALL SELECT CAST(doc_id AS VARCHAR) FROM documents)""",
)
def valid_job_id(spark, sf):
    pages = V.table(spark, sf, "pages").select(X.text_key("url").alias("mid"))
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("mid"))
    ids = (
        pages.unionByName(pages.select(F.upper("mid").alias("mid")))
        .unionByName(pages.select(F.concat(F.left("mid", F.lit(31)), F.lit("\n")).alias("mid")))
        .unionByName(docs)
    )
    return ids.select("mid", X.is_job_id("mid").alias("is_valid"))


@query(
    "normalize_job_ids",
    f"""WITH {V.POSTINGS} SELECT mid AS source_mid,
          substr(sha256(ordinal || '|' || mid || '|' || job_intro || '|' || source), 1, 32) AS mid
        FROM postings
        UNION ALL SELECT substr(sha256(url), 1, 32), substr(sha256(url), 1, 32) FROM pages""",
)
def normalize_job_ids(spark, sf):
    docs = V.postings(spark, sf).select("mid", "job_intro", "source", "ordinal")
    pages = V.table(spark, sf, "pages").select(
        X.text_key("url").alias("mid"),
        F.col("html").alias("job_intro"),
        F.lit("pages").alias("source"),
        (F.col("page_id") + V.BLOCK).alias("ordinal"),
    )
    return store.normalize_job_ids(docs.unionByName(pages), "ordinal").select("source_mid", "mid")


@query(
    "pending_match",
    f"""WITH {V.POSTINGS} SELECT mid, status, length(job_intro) AS n FROM postings
        WHERE status <> '{STATUS_FILTERED}' AND job_intro <> ''""",
)
def pending_match(spark, sf):
    rows = routing.pending_match(V.postings(spark, sf))
    return rows.select("mid", "status", F.char_length("job_intro").cast("long").alias("n"))


@query(
    "order_by_mid",
    f"""WITH {V.POSTINGS} SELECT mid, status FROM postings
        WHERE status <> '{STATUS_FILTERED}' AND job_intro <> '' ORDER BY mid""",
)
def order_by_mid(spark, sf):
    return routing.pending_match(V.postings(spark, sf)).select("mid", "status").orderBy("mid")


@query(
    "all_matchable",
    f"""WITH {V.POSTINGS} SELECT mid, status FROM postings WHERE job_intro <> ''""",
)
def all_matchable(spark, sf):
    return routing.all_matchable(V.postings(spark, sf)).select("mid", "status")


_PENDING_STRUCTURING = f"""WITH {V.POSTINGS} SELECT mid, category, updated_at FROM postings
  WHERE job_intro <> '' AND (structured_summary IS NULL OR structured_summary = '')"""


@query("pending_structuring", _PENDING_STRUCTURING)
def pending_structuring(spark, sf):
    rows = routing.pending_structuring(V.postings(spark, sf))
    return rows.select("mid", "category", "updated_at")


@query("oldest_first", f"{_PENDING_STRUCTURING} ORDER BY updated_at, mid LIMIT 100")
def oldest_first(spark, sf):
    rows = routing.pending_structuring(V.postings(spark, sf), limit=100)
    return rows.select("mid", "category", "updated_at")


@query(
    "pending_enrichment",
    f"WITH {V.TAXONOMY} SELECT code, small FROM taxonomy WHERE overview = ''",
)
def pending_enrichment(spark, sf):
    return routing.pending_enrichment(V.taxonomy(spark, sf)).select("code", "small")


@query(
    "record_label",
    """SELECT o_orderkey AS ordinal,
         coalesce(nullif(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END, ''),
                  CASE WHEN o_orderstatus = 'O' THEN o_orderstatus END,
                  '记录#' || (o_orderkey + 1)) AS label
       FROM orders""",
)
def record_label(spark, sf):
    orders = V.table(spark, sf, "orders")
    fine = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("")
    small = F.when(F.col("o_orderstatus") == "O", F.col("o_orderstatus"))
    label = X.record_label(fine, small, ordinal="o_orderkey")
    return orders.select(F.col("o_orderkey").alias("ordinal"), label.alias("label"))


@query(
    "progress_pct",
    """SELECT l_orderkey, l_linenumber,
         CASE WHEN s <= 0 THEN 0.0::DOUBLE WHEN d = s THEN 100.0::DOUBLE
              ELSE greatest(0.0::DOUBLE, least(99.9::DOUBLE, round(d / s * 100, 6))) END AS pct
       FROM (SELECT l_orderkey, l_linenumber, l_quantity - 10 AS s,
               CAST(l_suppkey AS DOUBLE) AS d FROM lineitem)""",
)
def progress_pct_query(spark, sf):
    rows = V.table(spark, sf, "lineitem")
    pct = progress_pct(F.col("l_quantity") - 10, F.col("l_suppkey").cast("double"))
    return rows.select("l_orderkey", "l_linenumber", F.round(pct, 6).alias("pct"))


@query(
    "progress_status",
    """SELECT l_orderkey, l_linenumber, CASE WHEN p >= 100 THEN 'completed' WHEN p > 0
         THEN 'processing' ELSE 'pending' END AS status
       FROM (SELECT l_orderkey, l_linenumber, (l_quantity - 10) * 5 AS p FROM lineitem)""",
)
def progress_status_query(spark, sf):
    rows = V.table(spark, sf, "lineitem")
    pct = (F.col("l_quantity") - 10) * 5
    return rows.select("l_orderkey", "l_linenumber", progress_status(pct).alias("status"))


# --- text functions -------------------------------------------------------------


@query(
    "source_tag",
    """SELECT doc_id, lang AS source, source || '.v1' AS base FROM documents""",
)
def source_tag_query(spark, sf):
    docs = V.table(spark, sf, "documents")
    path = F.concat(F.lit("file:///data/"), "lang", F.lit("/"), "source", F.lit(".v1.csv"))
    tags = source_tag(path)
    return docs.select("doc_id", tags["source"].alias("source"), tags["base"].alias("base"))


@query(
    "clean_taxonomy_text",
    f"""SELECT page_id, {trim_sql("replace(replace(html, '<', '**'), '**', '')")} AS cleaned
        FROM pages""",
)
def clean_taxonomy_text(spark, sf):
    marked = F.replace("html", F.lit("<"), F.lit("**"))
    return V.table(spark, sf, "pages").select(
        "page_id", X.clean_taxonomy_text(marked).alias("cleaned")
    )


_SPLIT = f"""list_filter(list_transform(
    string_split_regex({trim_sql('text')}, '[；;，,\n\r]'), lambda x: {trim_sql('x')}),
    lambda x: x <> '')"""


@query(
    "parse_list_field",
    f"""SELECT conv_id, turn, 'text' AS form, len(p) AS n, array_to_string(p, '|') AS joined
        FROM (SELECT conv_id, turn, {_SPLIT} AS p FROM conversations)
        UNION ALL
        SELECT conv_id, turn, 'json', len(p), array_to_string(p, '|')
        FROM (SELECT conv_id, turn, list_filter([{trim_sql('role')}, {trim_sql('text')}],
                lambda x: x <> '') AS p FROM conversations)
        UNION ALL
        SELECT conv_id, turn, 'mixed', 2, '[' || turn || '|"' || role || '"]' FROM conversations
        UNION ALL
        SELECT conv_id, turn, 'single', 1, role || ';' FROM conversations""",
)
def parse_list_field(spark, sf):
    talk = V.table(spark, sf, "conversations")
    as_json = F.to_json(F.array(F.concat(F.lit(" "), "role"), "text", F.lit("  ")))
    mixed = F.concat(F.lit("["), "turn", F.lit(',"'), "role", F.lit('"]'))
    forms = talk.select(
        "conv_id",
        "turn",
        F.explode(
            F.create_map(
                F.lit("text"), "text",
                F.lit("json"), as_json,
                F.lit("mixed"), mixed,
                F.lit("single"), F.concat("role", F.lit(";")),
            )
        ).alias("form", "value"),
    )
    parsed = forms.withColumn("p", X.parse_list_field("value"))
    return parsed.select(
        "conv_id",
        "turn",
        "form",
        F.size("p").cast("long").alias("n"),
        F.array_join("p", "|").alias("joined"),
    )


def _cell_sql(text: str) -> str:
    flat = f"translate(replace({text}, '\r\n', ' '), '\n\r\t', '   ')"
    return trim_sql(flat)


@query(
    "clean_cell",
    f"SELECT doc_id, {_cell_sql('text')} AS cell FROM documents",
)
def clean_cell(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", X.clean_cell("text").alias("cell"))


@query(
    "truncate_text",
    f"""SELECT doc_id, CASE WHEN length(c) > 500 THEN c[:500] || '...' ELSE c END AS cut,
          CASE WHEN length(t) > {PREVIEW_CHARS} THEN t[:{PREVIEW_CHARS}] || '...' ELSE t END
            AS preview
        FROM (SELECT doc_id, {_cell_sql('text')} AS c, {trim_sql('text')} AS t FROM documents)""",
)
def truncate_text(spark, sf):
    return V.table(spark, sf, "documents").select(
        "doc_id",
        X.truncate_text("text").alias("cut"),
        X.preview_text("text", PREVIEW_CHARS).alias("preview"),
    )


@query(
    "safe_metadata",
    """SELECT page_id, flat AS plain, replace(flat, '"', '""') AS quoted FROM (
         SELECT page_id, coalesce(translate(replace(html, '\r\n', ' '), '\n\r\t', '   '), '')
           AS flat FROM pages)""",
)
def safe_metadata(spark, sf):
    return V.table(spark, sf, "pages").select(
        "page_id",
        X.safe_metadata("html").alias("plain"),
        X.safe_metadata("html", legacy_quotes=True).alias("quoted"),
    )


@query("text_key", "SELECT doc_id, substr(sha256(text), 1, 32) AS text_key FROM documents")
def text_key(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", X.text_key("text").alias("text_key"))


@query(
    "utc_stamp",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM events",
)
def utc_stamp(spark, sf):
    return V.table(spark, sf, "events").select("event_id", X.utc_stamp("ts").alias("stamp"))


# --- embedding texts and metadata -------------------------------------------------

_LLM_LINES = """CASE WHEN overview <> '' THEN '岗位概述: ' || overview END,
  CASE WHEN len(duties) > 0 THEN '{duties}: ' || array_to_string(duties, '；') END,
  CASE WHEN len(keywords) > 0 THEN '关联关键词: ' || array_to_string(keywords, '、') END,
  CASE WHEN len(titles) > 0 THEN '典型岗位: ' || array_to_string(titles, '、') END"""
_LEVELS = """'大类: ' || big, '大类含义: ' || big_meaning, '中类: ' || middle, '小类: ' || small"""
_OWN = """'职业: ' || code, '职业含义: ' || code_meaning"""


@query(
    "taxonomy_embedding_text",
    f"""WITH {V.TAXONOMY} SELECT code,
          CASE WHEN overview <> '' THEN concat_ws(chr(10), {_LLM_LINES.format(duties='典型职责')})
               ELSE concat_ws(chr(10), {_LEVELS}, {_OWN}, '工作任务: ' || tasks) END AS plain,
          CASE WHEN overview <> ''
               THEN concat_ws(chr(10), {_LLM_LINES.format(duties='核心职责')}, {_OWN},
                              '主要任务: ' || tasks)
               ELSE concat_ws(chr(10), {_LEVELS}, {_OWN}, '主要任务: ' || tasks) END AS graph
        FROM taxonomy""",
)
def taxonomy_embedding_text(spark, sf):
    return V.taxonomy(spark, sf).select(
        "code",
        P.taxonomy_embedding_text().alias("plain"),
        P.taxonomy_embedding_text(for_graph=True).alias("graph"),
    )


@query(
    "taxonomy_metadata",
    f"""WITH {V.TAXONOMY} SELECT big AS "大类", big_meaning AS "大类含义", middle AS "中类",
          middle_meaning AS "中类含义", small AS "小类", small_meaning AS "小类含义",
          code AS "细类职业", code_meaning AS "细类含义", included_jobs AS "细类包含工种",
          tasks AS "细类主要工作任务", source_row AS "源行号",
          nullif(overview, '') AS "LLM岗位概述",
          nullif(array_to_string(duties, '；'), '') AS "LLM典型职责",
          nullif(array_to_string(keywords, '、'), '') AS "LLM关联关键词",
          nullif(array_to_string(titles, '、'), '') AS "LLM典型岗位" FROM taxonomy""",
)
def taxonomy_metadata(spark, sf):
    return V.taxonomy(spark, sf).select(P.taxonomy_metadata().alias("m")).select("m.*")


def structured_rows(spark, sf):
    """A structured payload per document, as JSON text; every kind of defect occurs."""
    docs = V.table(spark, sf, "documents")
    hint = F.struct(
        F.col("source").alias(HINT_NAME), (F.col("doc_id") / 1000).alias(HINT_CONFIDENCE)
    )
    unnamed = F.struct(F.lit("").alias(HINT_NAME), F.lit(0.5).alias(HINT_CONFIDENCE))
    payload = F.to_json(
        F.struct(
            F.col("lang").alias(PAYLOAD_SUMMARY),
            F.split("text", "\n").alias(PAYLOAD_DUTIES),
            F.array("lang", "source").alias(PAYLOAD_SKILLS),
            F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("source")).alias(
                PAYLOAD_INDUSTRY
            ),
            F.array().cast("array<string>").alias(PAYLOAD_LOCATIONS),
            F.array(hint, unnamed).alias(PAYLOAD_HINTS),
        )
    )
    wrong_type = F.concat(F.lit(f'{{"{PAYLOAD_SUMMARY}": '), "n_chars", F.lit("}"))
    raw = (
        F.when(F.col("lang") == "es", wrong_type)
        .when(F.col("source") == "src1", F.col("text"))
        .when(F.col("source") == "src2", F.lit("  "))
        .otherwise(payload)
    )
    return docs.select(
        F.col("doc_id").cast("string").alias("mid"),
        raw.alias("structured_json"),
        F.col("text").alias("job_intro"),
        "source",
        F.lit("").alias("status"),
        F.col("lang").alias("category"),
    )


_STRUCTURED = f"""CASE
  WHEN lang = 'es' THEN '{{"{PAYLOAD_SUMMARY}": ' || n_chars || '}}'
  WHEN source = 'src1' THEN text
  WHEN source = 'src2' THEN ''
  ELSE concat_ws(chr(10), '{PAYLOAD_SUMMARY}: ' || lang,
    '{PAYLOAD_DUTIES}: ' || replace(text, chr(10), '；'),
    '{PAYLOAD_SKILLS}: ' || lang || '；' || source,
    CASE WHEN lang <> 'de' THEN '{PAYLOAD_INDUSTRY}: ' || source END,
    '大类猜测: ' || source || '(信心' || printf('%.2f', doc_id / 1000) || ')') END"""


@query(
    "format_structured",
    f"SELECT CAST(doc_id AS VARCHAR) AS mid, {_STRUCTURED} AS formatted FROM documents",
)
def format_structured(spark, sf):
    rows = structured_rows(spark, sf)
    return rows.select("mid", P.format_structured("structured_json").alias("formatted"))


@query(
    "posting_embedding_text",
    f"""SELECT CAST(doc_id AS VARCHAR) AS mid, concat_ws(chr(10), nullif({_STRUCTURED}, ''),
          '岗位描述: ' || text, '来源: ' || source, '状态: ', '分类: ' || lang) AS full_text
        FROM documents""",
)
def posting_embedding_text(spark, sf):
    text = P.posting_embedding_text("structured_json", "job_intro", "source", "status", "category")
    return structured_rows(spark, sf).select("mid", text.alias("full_text"))


# --- model replies ----------------------------------------------------------------


def _replies(spark, sf):
    events = V.table(spark, sf, "events")
    kind = F.col("event_type")
    reply = (
        F.when(kind == "click", F.concat(F.lit("Sure: "), "props", F.lit(" done")))
        .when(kind == "view", F.concat(F.lit("```json\n"), "props", F.lit("\n```")))
        .when(kind == "error", F.concat("props", F.lit(" }")))
        .when(kind == "signup", F.lit("} nothing {"))
        .otherwise(F.concat(F.lit("  ```"), "props", F.lit("``` bye")))
    )
    return events.select("event_id", "event_type", "props", reply.alias("reply"))


@query(
    "extract_json",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN props END
         AS found FROM events""",
)
def extract_json(spark, sf):
    return _replies(spark, sf).select("event_id", P.extract_json("reply").alias("found"))


@query(
    "strip_code_fence",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'Sure: ' || props || ' done'
         WHEN 'error' THEN props || ' }' WHEN 'signup' THEN '} nothing {' ELSE props END AS body
       FROM events""",
)
def strip_code_fence(spark, sf):
    return _replies(spark, sf).select("event_id", P.strip_code_fence("reply").alias("body"))


@query(
    "normalize_json",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE
         '{"a":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' END
         AS normalized FROM events""",
)
def normalize_json(spark, sf):
    k = F.get_json_object("props", "$.k")
    text = F.concat(F.lit('{ "k" : '), k, F.lit(', "a": "'), "event_type", F.lit('" }'))
    bad = F.when(F.col("event_type") == "error", F.concat(text, F.lit("}"))).otherwise(text)
    return V.table(spark, sf, "events").select(
        "event_id", P.normalize_json(bad).alias("normalized")
    )


@query(
    "json_or_default",
    """SELECT event_id, CASE event_type WHEN 'error' THEN '[]' WHEN 'signup' THEN '[]'
         WHEN 'view' THEN 'null' ELSE props END AS fragment,
         CASE WHEN event_type <> 'signup' THEN props END AS raw FROM events""",
)
def json_or_default(spark, sf):
    kind = F.col("event_type")
    value = (
        F.when(kind == "error", F.concat(F.lit("x"), "props"))
        .when(kind == "signup", F.lit(" "))
        .when(kind == "view", F.lit("null"))
        .otherwise(F.concat(F.lit(" "), "props", F.lit("\n")))
    )
    raw = F.when(kind == "signup", F.lit(" \n")).otherwise(F.col("props"))
    return V.table(spark, sf, "events").select(
        "event_id", P.json_or_default(value).alias("fragment"), P.null_if_blank(raw).alias("raw")
    )


@query(
    "validate_enrichment",
    f"""WITH {V.TAXONOMY} SELECT code, CASE WHEN overview = '' THEN 'LLM岗位概述'
          WHEN small = 'BUILDING' THEN 'LLM典型职责' WHEN small = 'MACHINERY' THEN 'LLM关联关键词'
          WHEN big = 'ASIA' THEN 'LLM典型岗位' END AS missing FROM taxonomy""",
)
def validate_enrichment(spark, sf):
    rows = V.taxonomy(spark, sf)
    none = F.array().cast("array<string>")

    def emptied(column: str, when):
        return F.when(when, none).otherwise(F.col(column))

    missing = P.validate_enrichment(
        "overview",
        emptied("duties", F.col("small") == "BUILDING"),
        emptied("keywords", F.col("small") == "MACHINERY"),
        emptied("titles", F.col("big") == "ASIA"),
    )
    return rows.select("code", missing.alias("missing"))


@query(
    "build_prompt",
    f"""WITH {V.TAXONOMY} SELECT 't' || code AS id, concat_ws(chr(10), '大类: ' || big,
          '大类含义: ' || big_meaning, '中类: ' || middle, '小类: ' || small,
          '细类（职业）: ' || code, '细类含义: ' || code_meaning, '细类主要工作任务: ' || tasks,
          'Reply with one JSON object: LLM岗位概述, LLM典型职责, LLM关联关键词, LLM典型岗位.')
          AS prompt FROM taxonomy
        UNION ALL
        SELECT 'p' || doc_id, concat_ws(chr(10), 'Reply with one JSON object: 岗位概述, 核心职责, '
          || '技能标签, 行业, 工作地点, 可能对应的大类.', '岗位ID: ' || doc_id, '来源: ' || source,
          '已有分类: ' || CASE WHEN lang = 'en' THEN '未分类' ELSE lang END,
          '岗位描述: ' || {trim_sql('text')}) FROM documents""",
)
def build_prompt(spark, sf):
    codes = V.taxonomy(spark, sf).select(
        F.concat(F.lit("t"), "code").alias("id"), P.taxonomy_prompt().alias("prompt")
    )
    category = F.when(F.col("category") != "en", F.col("category"))
    posts = V.raw_postings(spark, sf).select(
        F.concat(F.lit("p"), "mid").alias("id"),
        P.posting_prompt("mid", "source", category, "job_intro").alias("prompt"),
    )
    return codes.unionByName(posts)
