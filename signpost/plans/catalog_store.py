"""Queries: store updates, reconciliation, set operations and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from signpost.operators import graph as G
from signpost.operators import models as M
from signpost.operators import progress as R
from signpost.operators import reconcile as C
from signpost.operators import routing, store
from signpost.plans import views as V
from signpost.plans.registry import query
from signpost.plans.views import trim_sql
from signpost.schema import STATUS_DONE, STATUS_FILTERED, STATUS_PENDING
from signpost.session import scratch_dir
from signpost.sources.versions import VersionedTable

LOADED_AT = "2024-06-01 00:00:00"


def _load(spark, sf):
    """Turns of conversations as a load: ids repeat, some are new."""
    talk = V.table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("mid"),
        F.col("text").alias("job_intro"),
        F.col("role").alias("source"),
        F.col("turn").alias("ordinal"),
    )
    extra = V.table(spark, sf, "benchmark").select(
        (F.col("item_id") + V.EXTRA_ID).cast("string").alias("mid"),
        F.col("text").alias("job_intro"),
        F.lit("benchmark").alias("source"),
        F.lit(0).cast("long").alias("ordinal"),
    )
    return routing.route_short(
        routing.valid_rows(talk.unionByName(extra)), V.SHORT_CHARS
    )


_UPSERT = f"""WITH {V.POSTINGS}, load AS (
          SELECT mid, {trim_sql('text')} AS job_intro, source, ordinal,
            length({trim_sql('text')}) < {V.SHORT_CHARS} AS is_filtered FROM (
            SELECT CAST(conv_id AS VARCHAR) AS mid, text, role AS source, turn AS ordinal
            FROM conversations
            UNION ALL SELECT CAST(item_id + {V.EXTRA_ID} AS VARCHAR), text, 'benchmark', 0
            FROM benchmark)),
        last AS (SELECT mid, arg_max(job_intro, ordinal) AS job_intro,
            arg_max(source, ordinal) AS source, arg_max(is_filtered, ordinal) AS is_filtered,
            bool_or(is_filtered) AS any_filtered FROM load GROUP BY mid)
        SELECT coalesce(p.mid, l.mid) AS mid, coalesce(l.job_intro, p.job_intro) AS job_intro,
          coalesce(l.source, p.source) AS source,
          CASE WHEN l.mid IS NULL THEN p.status WHEN l.is_filtered THEN '{STATUS_FILTERED}'
            WHEN p.status IS NULL OR p.status = '{STATUS_FILTERED}' OR l.any_filtered
            THEN '{STATUS_PENDING}' ELSE p.status END AS status,
          coalesce(p.category, '') AS category,
          CASE WHEN l.mid IS NULL THEN p.updated_at ELSE TIMESTAMP '{LOADED_AT}' END AS updated_at
        FROM postings p FULL JOIN last l ON l.mid = p.mid"""
_STORED = ["mid", "job_intro", "source", "status", "category", "updated_at"]


@query("upsert_postings", _UPSERT)
def upsert_postings(spark, sf):
    stamp = F.lit(LOADED_AT).cast("timestamp")
    return store.upsert_postings(V.postings(spark, sf).select(*_STORED), _load(spark, sf), stamp)


@query("load_postings", _UPSERT)
def load_postings(spark, sf):
    """The load merged into a stored table, whose untouched parts keep their files."""
    table = VersionedTable(spark, scratch_dir(spark, "store"), key="mid", parts=16)
    table.replace(V.postings(spark, sf).select(*_STORED))
    store.load_postings(table, _load(spark, sf), F.lit(LOADED_AT).cast("timestamp"))
    return table.read()


_TODO = f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.RESULT_IDS}
  SELECT mid, status FROM postings p WHERE status <> '{STATUS_FILTERED}' AND job_intro <> ''
    AND NOT EXISTS (SELECT 1 FROM result_ids r WHERE r.mid = p.mid)"""


@query("backfill_missing", _TODO)
def backfill_missing(spark, sf):
    todo = store.backfill_missing(
        routing.pending_match(V.postings(spark, sf)), V.results(spark, sf)
    )
    return todo.select("mid", "status")


@query("limit_jobs", f"{_TODO} ORDER BY mid LIMIT 50")
def limit_jobs(spark, sf):
    pending = routing.pending_match(V.postings(spark, sf)).select("mid", "status")
    return store.backfill_missing(pending, V.results(spark, sf), limit=50)


@query(
    "mark_processed",
    f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.RESULT_IDS} SELECT p.mid,
          CASE WHEN r.mid IS NOT NULL THEN '{STATUS_DONE}' ELSE status END AS status
        FROM postings p LEFT JOIN result_ids r ON r.mid = p.mid""",
)
def mark_processed(spark, sf):
    marked = store.mark_processed(V.postings(spark, sf), V.results(spark, sf))
    return marked.select("mid", "status")


@query(
    "apply_structured",
    f"""WITH {V.POSTINGS} SELECT p.mid,
          CASE WHEN l.quality = 1 THEN '{{"岗位概述":"' || p.category || '","技能标签":["'
            || p.source || '"]}}' END AS structured_json,
          CASE WHEN l.quality = 1 THEN p.category ELSE p.structured_summary END
            AS structured_summary,
          CASE WHEN l.quality = 1 THEN '["' || p.source || '"]' END AS structured_skills,
          CASE WHEN l.quality = 1 THEN '[]' END AS structured_locations
        FROM postings p LEFT JOIN labels l ON l.doc_id = p.ordinal""",
)
def apply_structured(spark, sf):
    rows = V.postings(spark, sf)
    blank = {
        c: F.lit(None).cast("timestamp" if c.endswith("_at") else "string")
        for c in store.STRUCTURED_COLUMNS
        if c != "structured_summary"
    }
    full = rows.withColumns(blank)
    labels = V.table(spark, sf, "labels").select(F.col("doc_id").alias("ordinal"), "quality")
    good = F.concat(
        F.lit('Here: {"技能标签": ["'), "source", F.lit('"], "岗位概述": "'), "category", F.lit('"}.')
    )
    # A reply without JSON is an error: those postings keep what they had.
    replies = rows.join(labels, "ordinal").select(
        "mid",
        F.when(F.col("quality") == 1, good).otherwise(F.lit("no idea")).alias("reply"),
        F.lit(None).cast("string").alias("error"),
    )
    stamp = F.lit(LOADED_AT).cast("timestamp")
    applied = store.apply_structured(full, M.parse_structured(replies, stamp))
    return applied.select(
        "mid", "structured_json", "structured_summary", "structured_skills", "structured_locations"
    )


@query(
    "apply_enrichment",
    f"""WITH {V.TAXONOMY} SELECT t.code,
          CASE WHEN s.s_suppkey IS NOT NULL THEN s.s_name ELSE overview END AS overview,
          CASE WHEN s.s_suppkey IS NOT NULL THEN s.s_name || '|x' ELSE
            array_to_string(duties, '|') END AS duties
        FROM taxonomy t LEFT JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = t.code
          AND s.s_acctbal >= 0""",
)
def apply_enrichment(spark, sf):
    applied = store.apply_enrichment(V.taxonomy(spark, sf), enrichments(spark, sf))
    return applied.select("code", "overview", F.array_join("duties", "|").alias("duties"))


def enrichments(spark, sf):
    """Answers for the codes that suppliers stand for, one failed for each negative balance."""
    supplier = V.table(spark, sf, "supplier")
    pair = F.array("s_name", F.lit("x"))
    return supplier.select(
        F.col("s_suppkey").cast("string").alias("code"),
        F.col("s_name").alias("overview"),
        pair.alias("duties"),
        pair.alias("keywords"),
        pair.alias("titles"),
        F.when(F.col("s_acctbal") < 0, F.lit("failed")).alias("error"),
    )


# --- reconciliation -----------------------------------------------------------------


@query(
    "diff_result_store",
    f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.RESULT_IDS}, {V.ELIGIBLE},
        present AS (SELECT coalesce(e.mid, r.mid) AS mid, e.mid IS NOT NULL AS s,
            r.mid IS NOT NULL AS r FROM eligible e FULL JOIN result_ids r ON r.mid = e.mid)
        SELECT count(*) FILTER (s AND r) AS valid, count(*) FILTER (s AND NOT r) AS missing,
          count(*) FILTER (NOT s) AS extras,
          (SELECT coalesce(string_agg(mid, ',' ORDER BY mid), '') FROM
            (SELECT mid FROM present WHERE s AND NOT r ORDER BY mid LIMIT 10)) AS missing_sample
        FROM present""",
)
def diff_result_store(spark, sf):
    return C.diff_result_store(V.results(spark, sf), V.postings(spark, sf))


@query(
    "missing_sample",
    f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.RESULT_IDS}, {V.ELIGIBLE}
        SELECT mid FROM eligible WHERE mid NOT IN (SELECT mid FROM result_ids)
        ORDER BY mid LIMIT 10""",
)
def missing_sample(spark, sf):
    return C.missing_sample(V.results(spark, sf), V.postings(spark, sf))


@query(
    "drop_extras",
    f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.ELIGIBLE}
        SELECT mid, copy, ordinal FROM results WHERE mid IN (SELECT mid FROM eligible)""",
)
def drop_extras(spark, sf):
    kept = C.drop_extras(V.results(spark, sf), V.postings(spark, sf))
    return kept.select("mid", "copy", "ordinal")


@query(
    "distinct_results",
    f"""WITH {V.RESULTS} SELECT count(*) AS rows,
          count(DISTINCT nullif({trim_sql('mid')}, '')) AS unique_ids FROM results""",
)
def distinct_results(spark, sf):
    return C.distinct_results(V.results(spark, sf))


@query(
    "duplicate_results",
    f"""WITH {V.RESULTS} SELECT {trim_sql('mid')} AS mid, count(*) AS copies FROM results
        WHERE {trim_sql('mid')} <> '' GROUP BY 1 HAVING count(*) > 1""",
)
def duplicate_results(spark, sf):
    return C.duplicate_results(V.results(spark, sf))


@query(
    "dedup_keep_first",
    f"""WITH {V.RESULTS}, {V.POSTINGS}, {V.ELIGIBLE}
        SELECT mid, min(ordinal) AS ordinal, min(copy) AS copy FROM results
        WHERE mid IN (SELECT mid FROM eligible) GROUP BY mid""",
)
def dedup_keep_first(spark, sf):
    rows, posts = V.results(spark, sf), V.postings(spark, sf)
    extras = C.result_except_store(rows, posts)
    return C.dedup_keep_first(rows, drop=extras).select("mid", "ordinal", "copy")


@query(
    "result_except_store",
    f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.RESULT_IDS}, {V.ELIGIBLE}
        SELECT mid FROM result_ids EXCEPT SELECT mid FROM eligible""",
)
def result_except_store(spark, sf):
    return C.result_except_store(V.results(spark, sf), V.postings(spark, sf))


@query(
    "result_intersect_store",
    f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.RESULT_IDS}, {V.ELIGIBLE}
        SELECT mid FROM result_ids INTERSECT SELECT mid FROM eligible""",
)
def result_intersect_store(spark, sf):
    return C.result_intersect_store(V.results(spark, sf), V.postings(spark, sf))


@query(
    "routed_union",
    f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.RESULT_IDS},
        routed AS (SELECT mid, CASE WHEN count(*) > 1 THEN 'both' ELSE max(route) END AS route
          FROM (SELECT mid, 'result' AS route FROM result_ids UNION ALL
            SELECT mid, 'ignored' FROM postings WHERE status = '{STATUS_FILTERED}') GROUP BY mid)
        SELECT coalesce(route, 'unrouted') AS route, count(*) AS ids,
          count(p.mid) AS in_source
        FROM routed r FULL JOIN postings p ON p.mid = r.mid GROUP BY 1""",
)
def routed_union(spark, sf):
    posts = V.postings(spark, sf)
    return C.routed_union(V.results(spark, sf), routing.ignored(posts), posts)


@query(
    "store_counts",
    f"""WITH {V.POSTINGS} SELECT count(*) AS all_rows, count(*) FILTER (job_intro <> '')
          AS with_intro, count(*) FILTER (status = '{STATUS_FILTERED}') AS filtered,
          count(*) FILTER (job_intro <> '' AND status = '{STATUS_DONE}') AS processed
        FROM postings""",
)
def store_counts(spark, sf):
    return store.store_counts(V.postings(spark, sf))


@query(
    "import_stats",
    f"""SELECT source, lang AS base, count(*) AS total,
          count(*) FILTER (NOT short) AS imported, count(*) FILTER (short) AS filtered
        FROM (SELECT source, lang, length({trim_sql('text')}) < {V.SHORT_CHARS} AS short
          FROM documents) GROUP BY ALL""",
)
def import_stats(spark, sf):
    rows = V.routed_postings(spark, sf).withColumnRenamed("category", "base")
    return store.import_stats(rows, "source", "base")


def reconciled(spark, sf):
    posts = V.postings(spark, sf).withColumn("file", F.col("source"))
    return C.reconcile(
        V.raw_postings(spark, sf).withColumn("file", F.col("source")),
        posts,
        V.results(spark, sf),
        posts.filter(F.col("status") == STATUS_FILTERED),
        min_chars=V.SHORT_CHARS,
    )


_RECONCILED = f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.ELIGIBLE},
  o AS (SELECT source AS file, count(*) AS total,
      count(*) FILTER (length({trim_sql('text')}) < {V.SHORT_CHARS}) AS origin_filtered,
      count(*) - count(DISTINCT doc_id) AS duplicate_ids FROM documents GROUP BY 1),
  s AS (SELECT source AS file, count(*) AS db,
      count(*) FILTER (status = '{STATUS_FILTERED}') AS db_filtered FROM postings GROUP BY 1),
  r AS (SELECT x.file, count(*) AS result_rows,
      count(DISTINCT nullif({trim_sql('x.mid')}, '')) AS unique_ids,
      count(DISTINCT e.mid) AS valid_ids
    FROM results x LEFT JOIN eligible e ON e.mid = x.mid GROUP BY 1),
  j AS (SELECT o.file, total, origin_filtered, duplicate_ids, db, db_filtered,
      db_filtered AS ignore_rows, coalesce(result_rows, 0) AS result_rows,
      coalesce(unique_ids, 0) AS unique_ids, coalesce(valid_ids, 0) AS valid_ids
    FROM o JOIN s ON s.file = o.file LEFT JOIN r ON r.file = o.file),
  rec AS (SELECT *, result_rows + ignore_rows = total AND db = total AS ok,
      db < total AS need_reimport, db > total AS need_rebuild,
      db_filtered <> origin_filtered AS need_status_fix,
      ignore_rows <> origin_filtered AS need_ignore_fix,
      result_rows <> unique_ids OR unique_ids <> valid_ids AS need_rewrite,
      valid_ids < total - origin_filtered AS need_backfill FROM j)"""


@query("reconcile", f"{_RECONCILED} SELECT * FROM rec")
def reconcile(spark, sf):
    return reconciled(spark, sf)


def _repaired(spark, sf):
    """The same files after a repair: extras and repeats dropped, missing ones added."""
    posts = V.postings(spark, sf).withColumn("file", F.col("source"))
    ignored_rows = posts.filter(F.col("status") == STATUS_FILTERED)
    kept = C.dedup_keep_first(C.drop_extras(V.results(spark, sf), posts)).select("mid", "file")
    # Only languages other than English have been matched again so far.
    todo = store.backfill_missing(routing.pending_match(posts), kept).filter("category <> 'en'")
    repaired = kept.unionByName(todo.select("mid", "file"))
    source = V.raw_postings(spark, sf).withColumn("file", F.concat("category", F.lit("-"), "source"))
    by_file = posts.withColumn("file", F.concat("category", F.lit("-"), "source"))
    named = by_file.select("mid", "file")
    return C.reconcile(
        source,
        by_file,
        repaired.drop("file").join(named, "mid"),
        ignored_rows.drop("file").join(named, "mid"),
        min_chars=V.SHORT_CHARS,
    )


@query(
    "write_manifest",
    f"""WITH {V.POSTINGS}, {V.RESULTS}, {V.ELIGIBLE}
        SELECT category || '-' || source AS file, count(*) AS total,
          count(*) FILTER (status <> '{STATUS_FILTERED}') AS processed,
          count(*) FILTER (status = '{STATUS_FILTERED}') AS filtered, count(*) AS db, true AS ok
        FROM postings p GROUP BY 1
        HAVING bool_and(status = '{STATUS_FILTERED}' OR category <> 'en'
          OR mid IN (SELECT mid FROM results))""",
)
def write_manifest(spark, sf):
    return C.manifest_rows(_repaired(spark, sf))


# --- counts and progress -------------------------------------------------------------

_ROLLUP = """SELECT platform, file, CAST(grouping(platform, file) AS INT) AS level,
    count(*) AS files, CAST(sum(row_count) AS BIGINT) AS row_count
  FROM (SELECT lang AS platform, source AS file, count(*) AS row_count FROM documents
        GROUP BY ALL) GROUP BY ROLLUP (platform, file)"""


@query("platform_rollup", _ROLLUP)
def platform_rollup(spark, sf):
    return R.platform_rollup(V.files(spark, sf))


@query("count_report", f"{_ROLLUP} ORDER BY level, platform NULLS FIRST, file NULLS FIRST")
def count_report(spark, sf):
    return R.count_report(V.files(spark, sf))


@query(
    "file_report_order",
    """SELECT lang AS platform, source AS file, count(*) AS row_count FROM documents
       GROUP BY ALL ORDER BY platform, file""",
)
def file_report_order(spark, sf):
    return V.files(spark, sf).orderBy("platform", "file")


_HALF = f"""SELECT CAST(user_id AS VARCHAR) AS file, count(*) AS source_lines,
    count(*) FILTER (event_type IN ('purchase', 'view')) AS result_lines,
    count(*) FILTER (event_type = 'error') AS ignore_lines,
    count(*) FILTER (event_type IN ('purchase', 'view', 'error')) > 0 AS has_output,
    count(*) FILTER (event_type = 'signup') > 8 AS authoritative
  FROM events WHERE ts {{op}} TIMESTAMP '{V.SPLIT_AT} 00:00:00' GROUP BY 1"""


def _pct_sql(source: str, done: str) -> str:
    return f"""CASE WHEN {source} <= 0 THEN 0.0::DOUBLE WHEN {done} = {source} THEN 100.0::DOUBLE
      ELSE least(99.9::DOUBLE, CAST({done} AS DOUBLE) / {source} * 100) END"""


MERGED = f"""o AS ({_HALF.format(op='<')}), n AS ({_HALF.format(op='>=')}),
  t AS (SELECT o AS o, n AS n, coalesce(n.file, o.file) AS file,
      CASE WHEN n.file IS NULL THEN false WHEN o.file IS NULL OR n.authoritative THEN true
        WHEN NOT n.has_output THEN false ELSE n.result_lines + n.ignore_lines
          >= o.result_lines + o.ignore_lines END AS take
    FROM o FULL JOIN n ON n.file = o.file),
  m AS (SELECT file, CASE WHEN take THEN n.source_lines ELSE o.source_lines END AS source_lines,
      CASE WHEN take THEN n.result_lines ELSE o.result_lines END AS result_lines,
      CASE WHEN take THEN n.ignore_lines ELSE o.ignore_lines END AS ignore_lines FROM t),
  merged AS (SELECT *, {_pct_sql('source_lines', '(result_lines + ignore_lines)')}
      AS processed_pct FROM m)"""
STATUS_SQL = """CASE WHEN processed_pct >= 100 THEN 'completed' WHEN processed_pct > 0
  THEN 'processing' ELSE 'pending' END"""


@query(
    "merge_progress",
    f"""WITH {MERGED} SELECT file, source_lines, result_lines, ignore_lines,
          round(processed_pct, 6) AS processed_pct, {STATUS_SQL} AS status FROM merged""",
)
def merge_progress(spark, sf):
    merged = R.merge_progress(V.progress_half(spark, sf, False), V.progress_half(spark, sf, True))
    return merged.withColumn("processed_pct", F.round("processed_pct", 6))


@query(
    "progress_totals",
    f"""WITH {MERGED} SELECT count(*) AS total_files,
          count(*) FILTER (processed_pct >= 100) AS completed_files,
          CAST(sum(source_lines) AS BIGINT) AS total_lines,
          CAST(sum(result_lines + ignore_lines) AS BIGINT) AS processed_lines,
          round(sum(result_lines + ignore_lines) / sum(source_lines) * 100, 6) AS overall_pct
        FROM merged""",
)
def progress_totals(spark, sf):
    merged = R.merge_progress(V.progress_half(spark, sf, False), V.progress_half(spark, sf, True))
    totals = R.progress_totals(merged)
    return totals.withColumn("overall_pct", F.round("overall_pct", 6))


@query(
    "progress_scan",
    f"""WITH {V.RESULTS}, {V.POSTINGS},
        src AS (SELECT source AS file, count(*) AS source_lines FROM documents GROUP BY 1),
        res AS (SELECT file, count(*) AS c FROM results GROUP BY 1),
        ign AS (SELECT source AS file, count(*) FILTER (status = '{STATUS_FILTERED}') AS c
                FROM postings GROUP BY 1),
        man AS (SELECT source AS file, count(*) AS total,
            count(*) FILTER (lang = 'en') AS processed, count(*) FILTER (lang <> 'en') AS filtered
          FROM documents GROUP BY 1 HAVING max(n_chars) >= 15000),
        j AS (SELECT src.file, coalesce(man.total, source_lines) AS source_lines,
            coalesce(man.processed, res.c, 0) AS result_lines,
            coalesce(man.filtered, ign.c, 0) AS ignore_lines,
            man.total IS NOT NULL AS authoritative
          FROM src LEFT JOIN res ON res.file = src.file LEFT JOIN ign ON ign.file = src.file
          LEFT JOIN man ON man.file = src.file),
        p AS (SELECT *, CASE WHEN authoritative THEN 100.0::DOUBLE ELSE
            {_pct_sql('source_lines', '(result_lines + ignore_lines)')} END AS processed_pct FROM j)
        SELECT file, source_lines, result_lines, ignore_lines,
          authoritative OR result_lines > 0 OR ignore_lines > 0 AS has_output, authoritative,
          round(processed_pct, 6) AS processed_pct, {STATUS_SQL} AS status FROM p""",
)
def progress_scan(spark, sf):
    docs = V.table(spark, sf, "documents").withColumnRenamed("source", "file")
    by_file = docs.groupBy("file")
    source = by_file.agg(F.count("*").alias("source_lines"))
    results = V.results(spark, sf).groupBy("file").agg(F.count("*").alias("result_lines"))
    ignored = (
        V.postings(spark, sf)
        .groupBy(F.col("source").alias("file"))
        .agg(F.count_if(F.col("status") == STATUS_FILTERED).alias("ignore_lines"))
    )
    output = results.join(ignored, "file", "full_outer")
    total = F.count("*")
    # Manifests of the files without a long document claim one row too many.
    manifests = by_file.agg(
        total.alias("total"),
        (F.count_if(F.col("lang") == "en")
         + F.when(F.max("n_chars") < 15000, 1).otherwise(0)).alias("processed"),
        F.count_if(F.col("lang") != "en").alias("filtered"),
        F.lit(True).alias("ok"),
    )
    scanned = R.progress_scan(source, output, manifests)
    return scanned.withColumn("processed_pct", F.round("processed_pct", 6))


# --- graph edges that need no vectors ---------------------------------------------------


@query(
    "missing_vectors",
    f"""WITH {V.TAXONOMY} SELECT code, small FROM taxonomy
        WHERE code NOT IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings)""",
)
def missing_vectors(spark, sf):
    missing = G.missing_vectors(V.taxonomy(spark, sf), V.ref_vectors(spark, sf))
    return missing.select("code", "small")
