"""Queries: sources, sinks and model steps, on files Spark writes from the given tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from signpost.operators import graph as G
from signpost.operators import models as M
from signpost.operators import nearest as N
from signpost.operators import routing, store
from signpost.plans import index as I
from signpost.plans import views as V
from signpost.plans.catalog_store import _RECONCILED, LOADED_AT, enrichments, reconciled
from signpost.plans.catalog_vectors import _CODE_TEXT, _TOP, _cut_sql, _RESULT_FIELDS
from signpost.plans.registry import query
from signpost.plans.views import clamp_sql, trim_sql
from signpost.schema import RESULT_COLUMNS, STATUS_FILTERED, TAXONOMY_LIST_FIELDS
from signpost.session import materialize, scratch_dir
from signpost.sources import delimited as D
from signpost.sources import manifest as T
from signpost.sources import sinks as W
from signpost.sources.taxonomy import read_taxonomy
from signpost.sources.versions import read_table

_WRITE = {
    "header": "true",
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _posting_files(spark, sf) -> str:
    path = scratch_dir(spark, "postings")
    docs = V.raw_postings(spark, sf).select("mid", "job_intro", "category", "source")
    docs.write.partitionBy("source").options(**_WRITE).csv(path)
    return path


_TEXT = f"{trim_sql('replace(text, chr(13) || chr(10), chr(10))')}"


@query(
    "read_postings_csv",
    f"""SELECT CAST(doc_id AS VARCHAR) AS mid, {_TEXT} AS job_intro, 'source=' || source AS source,
          length({_TEXT}) < {V.SHORT_CHARS} AS is_filtered FROM documents""",
)
def read_postings_csv(spark, sf):
    rows = D.read_postings(spark, f"{_posting_files(spark, sf)}/*", V.SHORT_CHARS)
    return rows.select("mid", "job_intro", "source", "is_filtered")


@query(
    "csv_row_count",
    """SELECT mode, source, count(*) AS row_count
       FROM documents, (SELECT unnest(['any', 'keyed', 'strict']) AS mode) GROUP BY ALL""",
)
def csv_row_count(spark, sf):
    path = f"{_posting_files(spark, sf)}/*"

    def counted(mode: str):
        files = D.csv_row_count(spark, path, mode).withColumn("mode", F.lit(mode))
        folder = F.regexp_extract("path", "source=([^/]+)/", 1)
        return files.groupBy("mode", folder.alias("source")).agg(
            F.sum("row_count").alias("row_count")
        )

    return counted("any").unionByName(counted("keyed")).unionByName(counted("strict"))


def _taxonomy_columns(rows):
    lists = TAXONOMY_LIST_FIELDS.values()
    plain = [c for c in rows.columns if c not in lists and c != "ordinal"]
    return rows.select(*plain, *[F.array_join(c, "|").alias(c) for c in lists])


_TAXONOMY_OUT = f"""WITH {V.TAXONOMY} SELECT * EXCLUDE (duties, keywords, titles, ordinal),
    array_to_string(duties, '|') AS duties, array_to_string(keywords, '|') AS keywords,
    array_to_string(titles, '|') AS titles FROM taxonomy"""


@query("read_taxonomy", _TAXONOMY_OUT)
def read_taxonomy_query(spark, sf):
    path = scratch_dir(spark, "taxonomy")
    W.enriched_documents(V.taxonomy_raw(spark, sf)).write.json(path)
    return _taxonomy_columns(read_taxonomy(spark, path, lines=True))


@query("read_taxonomy_array", _TAXONOMY_OUT)
def read_taxonomy_array(spark, sf):
    """The same rows from files that each hold one JSON array over several lines."""
    path = scratch_dir(spark, "taxonomy")
    raw = V.taxonomy_raw(spark, sf)
    record = F.to_json(F.struct(*W.enriched_documents(raw.drop("ordinal")).columns))
    rows = W.enriched_documents(raw).select(record.alias("record"))
    # A hundred codes or so a file.
    file = F.pmod(F.xxhash64("record"), F.greatest(F.lit(1), F.lit(raw.count() // 100)))
    arrays = rows.groupBy(file.alias("file")).agg(F.array_join(F.collect_list("record"), ",\n").alias("records"))
    arrays.select("file", F.concat(F.lit("[\n"), "records", F.lit("\n]"))).write.partitionBy("file").text(path)
    return _taxonomy_columns(read_taxonomy(spark, f"{path}/*"))


@query(
    "write_enriched_taxonomy",
    f"""WITH {V.TAXONOMY}, answers AS (
          SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name FROM supplier WHERE s_acctbal >= 0)
        SELECT t.* EXCLUDE (overview, duties, keywords, titles, ordinal),
          CASE WHEN s_name IS NULL THEN overview ELSE s_name END AS overview,
          {', '.join(f"CASE WHEN s_name IS NULL THEN array_to_string({c}, '|') ELSE s_name || '|x' END AS {c}"
                     for c in ('duties', 'keywords', 'titles'))}
        FROM taxonomy t LEFT JOIN answers a ON a.code = t.code""",
)
def write_enriched_taxonomy(spark, sf):
    """Refused while an answer is an error; then written with the others applied, and read back."""
    path = scratch_dir(spark, "enriched")
    rows, answers = V.taxonomy(spark, sf), enrichments(spark, sf)
    good = answers.filter(F.col("error").isNull())
    if not W.write_enriched_taxonomy(rows, answers, path):
        W.write_enriched_taxonomy(rows, good, path)
    return _taxonomy_columns(read_taxonomy(spark, W.enriched_folder(spark, path), lines=True))


@query(
    "read_manifest",
    f"""{_RECONCILED} SELECT file, total, result_rows AS processed, ignore_rows AS filtered, db,
          ok, ok AND result_rows + ignore_rows = total AS is_valid FROM rec
        WHERE file <> 'src0'""",
)
def read_manifest(spark, sf):
    """A manifest per file; the one of src0 is spoiled by a line without `=`."""
    # Unlike the writer this keeps files whose counts disagree.
    counts = reconciled(spark, sf).withColumnsRenamed(
        {"result_rows": "processed", "ignore_rows": "filtered"}
    )
    lines = W.manifest_lines(counts)
    noise = F.when(F.col("file") == "src0", F.lit("\n\nspoiled")).otherwise(
        F.lit("\n note = a=b \n")
    )
    path = scratch_dir(spark, "manifests")
    lines.select("file", F.concat("value", noise).alias("value")).write.partitionBy("file").text(
        path
    )
    found = T.read_manifests(spark, path)
    return found.withColumn("file", F.regexp_extract("path", "file=([^/]+)/", 1)).drop("path")


@query(
    "write_results",
    f"""{_TOP}, {V.TAXONOMY}, {V.POSTINGS}
        SELECT p.mid AS job_id, {_cut_sql('p.job_intro')} AS job_intro,
          printf('%.4f', round(coalesce({clamp_sql('b.cosine')}, 0), 4)) AS similarity_score, {_RESULT_FIELDS}
        FROM postings p LEFT JOIN top b ON b.mid = p.mid AND b.rank = 1
        LEFT JOIN taxonomy t ON t.code = b.code""",
)
def write_results(spark, sf):
    """Result rows written as CSV and read back as text."""
    top = N.best_match(N.topk_candidates(V.query_vectors(spark, sf), V.ref_vectors(spark, sf)))
    # A posting without a match has a row as well.
    matches = V.postings(spark, sf).join(top, "mid", "left").fillna(0.0, ["similarity"])
    path = scratch_dir(spark, "results")
    W.write_results(G.result_rows(G.attach_taxonomy(matches, V.taxonomy(spark, sf))), path)
    schema = ", ".join(f"`{c}` string" for c in RESULT_COLUMNS)
    return D.read_ids(spark, path, schema, "job_id").select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in RESULT_COLUMNS]
    )


@query(
    "write_ignored",
    f"""WITH {V.POSTINGS} SELECT mid, job_intro FROM postings
        WHERE status = '{STATUS_FILTERED}'""",
)
def write_ignored(spark, sf):
    path = scratch_dir(spark, "ignored")
    W.write_ignored(routing.ignored(V.postings(spark, sf)), path)
    rows = D.read_ids(spark, path, "id string, job_intro string", "id")
    return rows.select("mid", F.coalesce("job_intro", F.lit("")).alias("job_intro"))


@query(
    "write_vectors",
    f"""WITH {V.TAXONOMY} SELECT code, {_CODE_TEXT} AS document, 512::BIGINT AS dim,
          code_meaning AS meaning FROM taxonomy""",
)
def write_vectors(spark, sf):
    path = scratch_dir(spark, "vectors")
    W.write_vectors(I.embed_taxonomy(V.taxonomy(spark, sf)), path)
    return read_table(spark, path).select(
        "code",
        "document",
        F.size("embedding").cast("long").alias("dim"),
        F.col("metadata.细类含义").alias("meaning"),
    )


@query(
    "write_neighbors",
    f"WITH {V.REFS}, {V.GRAPH} SELECT job_id, neighbor_id, score FROM edges",
)
def write_neighbors(spark, sf):
    path = scratch_dir(spark, "neighbors")
    W.write_neighbors(N.neighbor_graph(V.ref_vectors(spark, sf)), path)
    return read_table(spark, path)


# --- model steps, with a stand-in model that reads the prompt ---------------------------


def _field_of(prompt: str, label: str) -> str:
    return next((x[len(label) + 2 :] for x in prompt.split("\n") if x.startswith(f"{label}: ")), "")


def enriching_model():
    """Stands in for a chat model: repeats fields of the prompt inside a fence."""

    def reply(prompt: str) -> str:
        small = _field_of(prompt, "小类")
        code = _field_of(prompt, "细类（职业）")
        if small == "BUILDING":
            return "I would rather not"
        names = [] if small == "MACHINERY" else [code]
        payload = dict.fromkeys(TAXONOMY_LIST_FIELDS, [small, code])
        payload["LLM典型岗位"] = names
        payload["LLM岗位概述"] = f"{small} {code}"
        return f"```json\n{json.dumps(payload, ensure_ascii=False)}\n```"

    return reply


@query(
    "enrich_records",
    f"""WITH {V.TAXONOMY} SELECT code,
          CASE WHEN small NOT IN ('BUILDING', 'MACHINERY') THEN small || ' ' || code END
            AS overview,
          CASE WHEN small NOT IN ('BUILDING', 'MACHINERY') THEN small || '|' || code END
            AS duties,
          small IN ('BUILDING', 'MACHINERY') AS failed FROM taxonomy WHERE overview = ''""",
)
def enrich_records(spark, sf):
    pending = routing.pending_enrichment(V.taxonomy(spark, sf))
    done = M.enrich_records(pending, enriching_model, retries=1, pause=0.0)
    good = F.col("error").isNull()
    return done.select(
        "code",
        F.when(good, F.col("overview")).alias("overview"),
        F.when(good, F.array_join("duties", "|")).alias("duties"),
        (~good).alias("failed"),
    )


def structuring_model():
    """Stands in for a chat model: a short payload with text around it, or no JSON at all."""

    def reply(prompt: str) -> str:
        category = _field_of(prompt, "已有分类")
        if category == "es":
            return "no idea"
        source = _field_of(prompt, "来源")
        payload = {"岗位概述": category, "技能标签": [source], "行业": None}
        return f"Here it is: {json.dumps(payload, ensure_ascii=False)} - done"

    return reply


@query(
    "structure_postings",
    f"""WITH {V.POSTINGS} SELECT mid,
          CASE WHEN category <> 'es' AND coalesce(structured_summary, '') = '' THEN category
               ELSE structured_summary END AS structured_summary,
          CASE WHEN category <> 'es' AND coalesce(structured_summary, '') = ''
               THEN '["' || source || '"]' END AS structured_skills FROM postings""",
)
def structure_postings(spark, sf):
    blank = {
        c: F.lit(None).cast("timestamp" if c.endswith("_at") else "string")
        for c in store.STRUCTURED_COLUMNS
        if c != "structured_summary"
    }
    rows = V.postings(spark, sf).withColumns(blank)
    stamp = F.lit(LOADED_AT).cast("timestamp")
    pending = routing.pending_structuring(rows)
    answers = M.structure_postings(pending, structuring_model, stamp)
    # Model calls are expensive: their answers are written before they are applied.
    applied = store.apply_structured(rows, materialize(answers, "answers"))
    return applied.select("mid", "structured_summary", "structured_skills")
