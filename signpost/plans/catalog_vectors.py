"""Queries: vectors, nearest neighbours, the graph and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from signpost.functions import vectors as E
from signpost.operators import graph as G
from signpost.operators import models as M
from signpost.operators import nearest as N
from signpost.operators import routing
from signpost.plans import classify as K
from signpost.plans import index as I
from signpost.plans import views as V
from signpost.plans.registry import query
from signpost.plans.views import clamp_sql
from signpost.schema import (
    GRAPH_USED,
    REJECT_BELOW,
    STATUS_FILTERED,
)
from signpost.session import materialize, scratch_dir

# --- vector functions -------------------------------------------------------------


def _weighted_sum(vector: str):
    """Sum of position times element: depends on every element and its place."""
    pairs = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x), 4)


_WEIGHTED = """round(list_sum(list_transform(v, lambda x, i: CAST(x AS DOUBLE) * i)), 4)"""


@query(
    "normalize_vector",
    f"WITH {V.QUERIES} SELECT mid, {_WEIGHTED} AS checksum FROM queries",
)
def normalize_vector(spark, sf):
    zero = V.query_vectors(spark, sf).select(
        "mid", F.transform("embedding", lambda x: x * F.lit(0.0).cast("float")).alias("embedding")
    )
    rows = V.query_vectors(spark, sf).unionByName(zero)
    unit = rows.withColumn("embedding", E.normalize_vector("embedding"))
    return unit.filter(F.col("embedding").isNotNull()).select(
        "mid", _weighted_sum("embedding").alias("checksum")
    )


@query(
    "dot_product",
    """SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]),
         CAST(list_reverse(embedding) AS DOUBLE[])), 6) AS dot, 0.0::DOUBLE AS uneven
       FROM embeddings""",
)
def dot_product(spark, sf):
    rows = V.table(spark, sf, "embeddings")
    shorter = F.slice("embedding", 1, F.size("embedding") - 1)
    return rows.select(
        "vec_id",
        F.round(E.dot_product("embedding", F.reverse("embedding")), 6).alias("dot"),
        E.dot_product("embedding", shorter).alias("uneven"),
    )


@query(
    "distance_to_score",
    f"""SELECT l_orderkey, l_linenumber,
          round({clamp_sql('1 - (l_quantity / 20 - 0.5)')}, 6) AS score FROM lineitem""",
)
def distance_to_score(spark, sf):
    score = E.distance_to_score(F.col("l_quantity") / 20 - 0.5)
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(score, 6).alias("score")
    )


def _entries(spark, sf):
    """A vector table with repeated codes, blank codes and zero vectors."""
    own = V.ref_vectors(spark, sf)
    shared = V.table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("code"),
        "embedding",
        (F.col("vec_id") + V.BLOCK).alias("ordinal"),
    )
    blank = own.select(F.lit(" ").alias("code"), "embedding", "ordinal")
    zero = own.select(
        F.concat(F.lit("z"), "code").alias("code"),
        F.transform("embedding", lambda x: x * F.lit(0.0).cast("float")).alias("embedding"),
        "ordinal",
    )
    return own.unionByName(shared).unionByName(blank).unionByName(zero)


@query(
    "scan_vectors",
    f"""WITH first AS (SELECT code, arg_min(embedding, ordinal) AS embedding,
            min(ordinal) AS ordinal FROM (
            SELECT CAST(vec_id AS VARCHAR) AS code, embedding, vec_id AS ordinal FROM embeddings
            UNION ALL SELECT CAST(label AS VARCHAR), embedding, vec_id + {V.BLOCK}
            FROM embeddings) GROUP BY code),
          {V.unit_sql('units', 'first', 'code', 'embedding')}
        SELECT u.code, f.ordinal, {_WEIGHTED} AS checksum
        FROM units u JOIN first f ON f.code = u.code""",
)
def scan_vectors(spark, sf):
    scanned = N.scan_vectors(_entries(spark, sf))
    return scanned.select("code", "ordinal", _weighted_sum("embedding").alias("checksum"))


# --- nearest neighbours -----------------------------------------------------------

_TOP = f"WITH {V.REFS}, {V.QUERIES}, {V.ranked_sql('top', 5)}"
_CLAMPED = clamp_sql("cosine")


_TOP_ROWS = f"""{_TOP} SELECT mid, CAST(rank AS INT) AS rank, code, 1 - cosine AS distance,
  {_CLAMPED} AS similarity FROM top"""


@query("topk_candidates", _TOP_ROWS)
def topk_candidates(spark, sf):
    return N.topk_candidates(V.query_vectors(spark, sf), V.ref_vectors(spark, sf))


@query(
    "best_match",
    f"""{_TOP} SELECT mid, code, {_CLAMPED} AS similarity FROM top WHERE rank = 1""",
)
def best_match(spark, sf):
    top = N.topk_candidates(V.query_vectors(spark, sf), V.ref_vectors(spark, sf))
    return N.best_match(top)


@query(
    "reject_low_similarity",
    f"""{_TOP} SELECT mid, code, {_CLAMPED} AS similarity FROM top
        WHERE rank = 1 AND {_CLAMPED} >= {REJECT_BELOW}""",
)
def reject_low_similarity(spark, sf):
    top = N.topk_candidates(V.query_vectors(spark, sf), V.ref_vectors(spark, sf))
    return routing.reject_low_similarity(N.best_match(top))


@query(
    "neighbor_graph",
    f"WITH {V.REFS}, {V.GRAPH} SELECT job_id, neighbor_id, score FROM edges",
)
def neighbor_graph(spark, sf):
    return N.neighbor_graph(V.ref_vectors(spark, sf))


@query(
    "graph_neighbors",
    f"""WITH {V.REFS}, {V.GRAPH} SELECT job_id, neighbor_id, CAST(rank AS INT) AS rank,
          score FROM edges WHERE rank <= {GRAPH_USED}""",
)
def graph_neighbors(spark, sf):
    return G.graph_neighbors(N.neighbor_graph(V.ref_vectors(spark, sf)))


@query(
    "edge_count",
    f"""WITH {V.REFS}, {V.GRAPH}, ends AS (
          SELECT job_id AS code, 1 AS o, 0 AS i FROM edges
          UNION ALL SELECT neighbor_id, 0, 1 FROM edges)
        SELECT code, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree
        FROM ends GROUP BY code""",
)
def edge_count(spark, sf):
    return G.edge_count(N.neighbor_graph(V.ref_vectors(spark, sf)))


@query(
    "graph_correction",
    f"""{_TOP}, {V.GRAPH},
        best AS (SELECT mid, code, {_CLAMPED} AS similarity FROM top WHERE rank = 1),
        better AS (SELECT b.mid, t.code, {clamp_sql('t.cosine')} AS similarity
          FROM best b JOIN edges e ON e.job_id = b.code AND e.rank <= {GRAPH_USED}
          JOIN top t ON t.mid = b.mid AND t.code = e.neighbor_id
          WHERE {clamp_sql('t.cosine')} > b.similarity),
        won AS (SELECT mid, arg_max(code, similarity) AS code, max(similarity) AS similarity
          FROM better GROUP BY mid)
        SELECT b.mid, coalesce(w.code, b.code) AS code,
          coalesce(w.similarity, b.similarity) AS similarity,
          w.code IS NOT NULL AS changed FROM best b LEFT JOIN won w ON w.mid = b.mid""",
)
def graph_correction(spark, sf):
    refs = V.ref_vectors(spark, sf)
    attached = N.attach_candidates(V.query_vectors(spark, sf), refs)
    graph = materialize(N.neighbor_graph(refs), "graph")
    corrected = G.graph_correction(attached, graph)
    return corrected.select("mid", "code", "similarity", "changed")


@query(
    "attach_taxonomy",
    f"""{_TOP}, {V.TAXONOMY} SELECT mid, top.code, big, middle, small, code_meaning, tasks
        FROM top LEFT JOIN taxonomy t ON t.code = top.code WHERE rank = 1""",
)
def attach_taxonomy(spark, sf):
    top = N.topk_candidates(V.query_vectors(spark, sf), V.ref_vectors(spark, sf))
    joined = G.attach_taxonomy(N.best_match(top), V.taxonomy(spark, sf))
    names = ["big", "middle", "small", "code_meaning", "tasks"]
    return joined.select("mid", "code", *[F.col(f"tx_{n}").alias(n) for n in names])


@query(
    "match_summary",
    f"""{_TOP}, {V.TAXONOMY}, best AS (SELECT small AS code, {_CLAMPED} AS similarity
          FROM top LEFT JOIN taxonomy t ON t.code = top.code WHERE rank = 1)
        SELECT code, count(*) AS matched,
          count(*) FILTER (similarity < {REJECT_BELOW}) AS low_conf,
          min(similarity) AS min_similarity, round(avg(similarity), 6) AS avg_similarity,
          max(similarity) AS max_similarity FROM best GROUP BY code""",
)
def match_summary(spark, sf):
    top = N.topk_candidates(V.query_vectors(spark, sf), V.ref_vectors(spark, sf))
    joined = G.attach_taxonomy(N.best_match(top), V.taxonomy(spark, sf))
    summary = G.match_summary(
        joined.select(F.col("tx_small").alias("code"), "similarity"), REJECT_BELOW
    )
    return summary.withColumn("avg_similarity", F.round("avg_similarity", 6))


@query("topk_candidates_blocked", _TOP_ROWS)
def topk_candidates_blocked(spark, sf):
    """The same candidates with the references in many small blocks."""
    refs, queries = V.ref_vectors(spark, sf), V.query_vectors(spark, sf)
    return N.topk_candidates(queries, refs, ref_bytes=8_000)


@query(
    "union_backfilled_vectors",
    f"""WITH {V.TAXONOMY} SELECT code, coalesce(len(embedding), 512) AS dim
        FROM taxonomy t FULL JOIN
          (SELECT CAST(vec_id AS VARCHAR) AS code, embedding FROM embeddings) e USING (code)""",
)
def union_backfilled_vectors(spark, sf):
    stored = V.ref_vectors(spark, sf).select("code", "embedding")
    missing = G.missing_vectors(V.taxonomy(spark, sf), stored)
    extra = I.embed_taxonomy(missing).select("code", "embedding")
    joined = G.union_backfilled_vectors(stored, extra)
    return joined.select("code", F.size("embedding").cast("long").alias("dim"))


# --- approximate candidates -----------------------------------------------------------


def _buckets_sql(name: str, source: str, key: str) -> str:
    """CTE `name(key, tab, bucket)`: the bucket of each vector in each hash table."""
    return f"""{name}_whole AS (SELECT {key}, v, list_transform(v, lambda x: floor(CAST(x AS DOUBLE) /
      CAST(list_max(list_transform(v, lambda y: abs(y))) AS DOUBLE) * {N._SCALE} + 0.5)) AS w FROM {source}),
  {name}_signs AS (SELECT {key}, tab, bit, list_dot_product(w, ws) > 0 AS sign FROM {name}_whole, planes),
  {name} AS (SELECT {key}, tab, sum(CASE WHEN sign THEN 1 << bit ELSE 0 END) AS bucket
    FROM {name}_signs GROUP BY {key}, tab)"""


_LSH = f"""WITH {V.REFS}, {V.QUERIES},
  bits AS (SELECT CAST(greatest(1, least({N.LSH_MOST_BITS}, ceil(log2(greatest(1, count(*) / {N.LSH_ROWS}))))) AS BIGINT) AS bits
    FROM ref_rows),
  planes AS (SELECT tab, bit, list_transform(range(64), lambda p: CAST({N.weight_sql('tab', 'bit', 'p')} AS DOUBLE)) AS ws
    FROM range({N.LSH_TABLES}) t(tab), range({N.LSH_MOST_BITS}) b(bit), bits WHERE bit < bits),
  {_buckets_sql('rb', "(SELECT code, embedding AS v FROM ref_rows)", 'code')},
  {_buckets_sql('qb', "(SELECT mid, embedding AS v FROM query_rows)", 'mid')},
  probes AS (SELECT mid, tab, bucket FROM qb UNION ALL
    SELECT mid, tab, xor(bucket::BIGINT, 1 << bit) FROM qb, range({N.LSH_MOST_BITS}) b(bit), bits WHERE bit < bits),
  mates AS (SELECT DISTINCT mid, code FROM probes JOIN rb USING (tab, bucket)),
  scored AS (SELECT mid, code, round(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])), 9) AS cosine
    FROM mates JOIN queries q USING (mid) JOIN refs r USING (code)),
  lsh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY cosine DESC, code) AS rank FROM scored)
    WHERE rank <= 5)"""


@query(
    "lsh_candidates",
    f"""{_LSH} SELECT mid, CAST(rank AS INT) AS rank, code, 1 - cosine AS distance, {_CLAMPED} AS similarity
        FROM query_rows LEFT JOIN lsh USING (mid)""",
)
def lsh_candidates(spark, sf):
    return N.lsh_candidates(V.query_vectors(spark, sf), V.ref_vectors(spark, sf))


@query(
    "lsh_candidates_graph_expand",
    f"""{_LSH}, {V.GRAPH},
        first AS (SELECT mid, code FROM lsh WHERE rank = 1),
        pool AS (SELECT mid, code FROM first UNION
          SELECT mid, neighbor_id FROM first JOIN edges ON job_id = code),
        rescored AS (SELECT mid, code, round(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])), 9) AS cosine
          FROM pool JOIN queries q USING (mid) JOIN refs r USING (code)),
        best AS (SELECT mid, code, cosine FROM (SELECT *, row_number() OVER (PARTITION BY mid
          ORDER BY cosine DESC, code) AS n FROM rescored) WHERE n = 1)
        SELECT b.mid, b.code, {clamp_sql('b.cosine')} AS similarity, b.code <> f.code AS changed
        FROM best b JOIN first f ON f.mid = b.mid""",
)
def lsh_candidates_graph_expand(spark, sf):
    refs, queries = V.ref_vectors(spark, sf), V.query_vectors(spark, sf)
    found = N.lsh_candidates(queries, refs)
    units = refs.withColumn("embedding", E.normalize_vector("embedding"))
    return N.expand_and_rescore(found, queries, units, N.neighbor_graph(refs))


# --- text to vector ----------------------------------------------------------------


def trigram_sql(name: str, source: str, key: str, text: str) -> str:
    """CTE `name(key, bucket, n)`: how often each hashed trigram of a text occurs."""
    step, spread = M.HashingEmbedder.STEP, M.HashingEmbedder.SPREAD
    return f"""{name}_cp AS (SELECT {key}, list_transform(
      string_split(chr(2) || {text} || chr(3), ''), lambda c: CAST(unicode(c) AS BIGINT)) AS cp
      FROM {source}),
  {name}_tri AS (SELECT {key}, unnest(list_zip(cp[:-3], cp[2:-2], cp[3:])) AS t FROM {name}_cp
    WHERE len(cp) > 2),
  {name} AS (SELECT {key}, bucket, count(*) AS n FROM (
    SELECT {key}, ((((t[1] * {step} + t[2]) * {step} + t[3]) * {spread}) & 4294967295) >> 23
      AS bucket FROM {name}_tri) GROUP BY ALL)"""


def _vector_summary(rows, key: str):
    counts = F.transform("embedding", lambda x: x.cast("long"))

    def total(values):
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)

    return rows.select(
        key,
        total(counts).alias("trigrams"),
        total(F.transform(counts, lambda x, i: x * (i + 1).cast("long"))).alias("checksum"),
        total(F.transform(counts, lambda x: x * x)).alias("squares"),
    )


_SUMMARY = """CAST(sum(n) AS BIGINT) AS trigrams, CAST(sum(n * (bucket + 1)) AS BIGINT)
  AS checksum, CAST(sum(n * n) AS BIGINT) AS squares"""


@query(
    "embed_texts",
    f"""WITH {trigram_sql('tri', 'documents', 'doc_id', 'text')}
        SELECT doc_id, {_SUMMARY} FROM tri GROUP BY doc_id""",
)
def embed_texts(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    rows = M.embed_texts(docs.repartition(spark.sparkContext.defaultParallelism), "text")
    return _vector_summary(rows.filter(F.col("error").isNull()), "doc_id")


_TALK_SUMMARY = f"""WITH {trigram_sql('tri', 'conversations', 'conv_id, turn', 'text')}
        SELECT conv_id * 1000 + turn AS id, {_SUMMARY} FROM tri GROUP BY conv_id, turn"""


def _talk(spark, sf):
    return V.table(spark, sf, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))


@query("embed_distinct", _TALK_SUMMARY)
def embed_distinct(spark, sf):
    return _vector_summary(M.embed_distinct(_talk(spark, sf), "text"), "id")


@query("embed_kept", _TALK_SUMMARY)
def embed_kept(spark, sf):
    """The users' texts are embedded in an earlier run; this one asks the model for the others."""
    kept = M.vector_store(spark, scratch_dir(spark, "kept-vectors"), parts=8)
    talk = _talk(spark, sf)
    earlier = M.embed_distinct(talk.filter("role = 'user'"), "text", kept=kept, model="trigrams")
    earlier.write.format("noop").mode("overwrite").save()
    return _vector_summary(M.embed_distinct(talk, "text", kept=kept, model="trigrams"), "id")


# --- classification -----------------------------------------------------------------

_RESULT_FIELDS = """coalesce(big, '') AS "大类", coalesce(big_meaning, '') AS "大类含义",
  coalesce(middle, '') AS "中类", coalesce(middle_meaning, '') AS "中类含义",
  coalesce(small, '') AS "小类", coalesce(small_meaning, '') AS "小类含义",
  coalesce(b.code, '') AS "细类职业", coalesce(code_meaning, '') AS "细类含义",
  coalesce(replace(tasks, chr(10), ' '), '') AS "细类主要工作任务" """


def _cut_sql(text: str) -> str:
    flat = V.trim_sql(f"translate(replace({text}, '\r\n', ' '), '\n\r\t', '   ')")
    return f"CASE WHEN length({flat}) > 500 THEN left({flat}, 500) || '...' ELSE {flat} END"


_PENDING = f"""{V.POSTINGS}, {V.RESULTS}, {V.RESULT_IDS}, todo AS (
  SELECT * FROM postings WHERE status <> '{STATUS_FILTERED}' AND job_intro <> ''
    AND mid NOT IN (SELECT mid FROM result_ids))"""


def _result_sql(best: str, having: str = "todo") -> str:
    return f"""SELECT p.mid AS job_id, {_cut_sql('p.job_intro')} AS job_intro,
      round(coalesce({clamp_sql('b.cosine')}, 0), 4) AS similarity_score, {_RESULT_FIELDS}
    FROM {having} p LEFT JOIN {best} b ON b.mid = p.mid AND b.rank = 1
    LEFT JOIN taxonomy t ON t.code = b.code"""


@query(
    "classify",
    f"""{_TOP}, {V.TAXONOMY}, {_PENDING}, ready AS (
          SELECT * FROM todo WHERE mid IN (SELECT mid FROM queries))
        {_result_sql('top', 'ready')}""",
)
def classify(spark, sf):
    """All pending postings with a vector -> result rows; the others stay pending."""
    refs = V.ref_vectors(spark, sf)
    graph = materialize(N.neighbor_graph(refs), "graph")
    todo = K.pending_postings(V.postings(spark, sf), V.results(spark, sf))
    ready = todo.join(V.query_vectors(spark, sf), "mid", "left")
    return K.classify_vectors(ready, refs, graph, V.taxonomy(spark, sf))


_FULL_TEXT = """concat_ws(chr(10), '岗位描述: ' || job_intro, '来源: ' || source,
  '状态: ' || status, '分类: ' || category)"""
_CODE_TEXT = """CASE WHEN overview <> '' THEN concat_ws(chr(10), '岗位概述: ' || overview,
    '典型职责: ' || array_to_string(duties, '；'), '关联关键词: ' || array_to_string(keywords, '、'),
    '典型岗位: ' || array_to_string(titles, '、'))
  ELSE concat_ws(chr(10), '大类: ' || big, '大类含义: ' || big_meaning, '中类: ' || middle,
    '小类: ' || small, '职业: ' || code, '职业含义: ' || code_meaning, '工作任务: ' || tasks) END"""


def _sparse_unit(name: str, counts: str, key: str) -> str:
    return f"""{name} AS (SELECT c.{key}, c.bucket,
      CAST(CAST(CAST(n AS FLOAT) * f AS FLOAT) AS DOUBLE) AS x
    FROM {counts} c JOIN (SELECT {key}, CAST(1.0 / sqrt(CAST(sum(n * n) AS DOUBLE)) AS FLOAT) AS f
      FROM {counts} GROUP BY {key}) u ON u.{key} = c.{key})"""


SPARSE_TOP = f"""{_sparse_unit('qu', 'qt', 'mid')}, {_sparse_unit('ru', 'rt', 'code')},
  pairs AS (SELECT q.mid, r.code, round(sum(q.x * r.x), 9) AS cosine
    FROM qu q JOIN ru r ON r.bucket = q.bucket GROUP BY q.mid, r.code),
  top AS (SELECT mid, code, cosine, row_number() OVER (PARTITION BY mid
    ORDER BY cosine DESC, code) AS rank FROM pairs)"""


@query(
    "classify_text",
    f"""WITH {V.TAXONOMY}, {_PENDING},
      todo_text AS (SELECT mid, {_FULL_TEXT} AS body FROM todo),
      code_text AS (SELECT code, {_CODE_TEXT} AS body FROM taxonomy),
      {trigram_sql('qt', 'todo_text', 'mid', 'body')},
      {trigram_sql('rt', 'code_text', 'code', 'body')},
      {SPARSE_TOP} {_result_sql('top')}""",
)
def classify_text(spark, sf):
    """Pending postings -> result rows, from their text alone."""
    codes = V.taxonomy(spark, sf)
    entries = I.embed_taxonomy(codes).select("code", "embedding", "ordinal")
    refs = materialize(entries, "vectors")
    graph = I.build_graph(codes, refs)
    store = V.postings(spark, sf).withColumn("structured_json", F.lit(None).cast("string"))
    tasks = spark.sparkContext.defaultParallelism
    return K.classify_texts(store, V.results(spark, sf), refs, graph, codes, tasks=tasks)


@query(
    "classify_rejecting",
    f"""{_TOP}, {V.TAXONOMY}, {V.POSTINGS}, todo AS (SELECT * FROM postings WHERE job_intro <> '')
        {_result_sql('top')} WHERE {clamp_sql('b.cosine')} >= {REJECT_BELOW}""",
)
def classify_rejecting(spark, sf):
    """All postings with a text, whatever their status; those without a good match are dropped."""
    refs = V.ref_vectors(spark, sf)
    ready = routing.all_matchable(V.postings(spark, sf)).join(
        V.query_vectors(spark, sf), "mid", "left"
    )
    return K.classify_vectors(
        ready,
        refs,
        materialize(N.neighbor_graph(refs), "graph"),
        V.taxonomy(spark, sf),
        reject_below=REJECT_BELOW,
    )
