"""The data model laid over the given tables, and the same views as SQL.

Every view reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signpost.functions.text import clean_taxonomy_text, parse_list_field
from signpost.operators.routing import route_short, valid_rows
from signpost.operators.sizing import KNOWN_IDS, broadcast_if_bounded
from signpost.schema import STATUS_DONE, STATUS_FILTERED, STATUS_PENDING, WHITE_SPACE

# The given documents are longer than real short postings: the limit is a parameter.
SHORT_CHARS = 200
EXTRA_ID = 1_000_000_000
BLOCK = 10_000_000_000


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its schema is inferred once; that is a job of its own."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _mid(name: str):
    return F.col(name).cast("string").alias("mid")


def raw_postings(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(
        _mid("doc_id"),
        F.col("text").alias("job_intro"),
        "source",
        F.col("lang").alias("category"),
        "n_chars",
        F.col("doc_id").alias("ordinal"),
    )


def routed_postings(spark: SparkSession, sf: str) -> DataFrame:
    return route_short(valid_rows(raw_postings(spark, sf)), SHORT_CHARS)


def postings(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("ordinal"), "quality")
    rows = routed_postings(spark, sf).join(broadcast_if_bounded(labels, KNOWN_IDS), "ordinal", "left")
    return rows.select(
        "mid",
        "job_intro",
        "source",
        F.when(F.col("is_filtered"), STATUS_FILTERED)
        .when(F.col("quality") == 1, STATUS_DONE)
        .otherwise(STATUS_PENDING)
        .alias("status"),
        "category",
        F.timestamp_seconds(F.lit(1704067200) + F.col("n_chars")).alias("updated_at"),
        F.when(F.col("quality") == 1, F.col("source"))
        .when(F.col("quality") == 0, F.lit(""))
        .alias("structured_summary"),
        "ordinal",
    )


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Result ids with repeats, ids the store does not know, and blank ones."""
    labels = table(spark, sf, "labels")

    def part(rows: DataFrame, mid, copy: int, number: str) -> DataFrame:
        return rows.select(
            mid.alias("mid"),
            F.lit(copy).cast("long").alias("copy"),
            (F.col(number) + F.lit(copy * BLOCK)).alias("ordinal"),
        )

    own = F.col("doc_id").cast("string")
    rows = (
        part(labels, own, 0, "doc_id")
        .unionByName(part(labels.filter("toxic = 1"), own, 1, "doc_id"))
        .unionByName(
            part(
                table(spark, sf, "benchmark"),
                (F.col("item_id") + EXTRA_ID).cast("string"),
                2,
                "item_id",
            )
        )
        .unionByName(part(table(spark, sf, "region"), F.lit(" "), 3, "r_regionkey"))
    )
    files = table(spark, sf, "documents").select(_mid("doc_id"), "source")
    return rows.join(files, "mid", "left").select(
        "mid", "copy", "ordinal", F.coalesce("source", F.lit("src0")).alias("file")
    )


def taxonomy_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Taxonomy rows as they could stand in a file: marks and lists as text."""
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    )
    enriched = F.col("c_acctbal") >= 0

    def when_enriched(*parts):
        return F.when(enriched, F.concat(*parts))

    return joined.select(
        F.col("r_name").alias("big"),
        F.concat(F.lit("**"), "r_name", F.lit("** ")).alias("big_meaning"),
        F.col("n_name").alias("middle"),
        F.lit("").alias("middle_meaning"),
        F.col("c_mktsegment").alias("small"),
        F.lit("").alias("small_meaning"),
        F.col("c_custkey").cast("string").alias("code"),
        F.col("c_name").alias("code_meaning"),
        F.concat(F.lit(" **"), "c_mktsegment", F.lit("**\n"), "c_name").alias("tasks"),
        F.lit("").alias("included_jobs"),
        (F.col("c_custkey") + 2).cast("string").alias("source_row"),
        when_enriched("c_name", F.lit(" "), "n_name").alias("overview"),
        when_enriched("c_mktsegment", F.lit("；"), "n_name", F.lit(","), "r_name").alias("duties"),
        when_enriched(F.lit('["'), "n_name", F.lit('","**'), "r_name", F.lit('**"," "]')).alias(
            "keywords"
        ),
        when_enriched("n_name", F.lit(";")).alias("titles"),
        F.col("c_custkey").alias("ordinal"),
    )


def taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    raw = taxonomy_raw(spark, sf)
    lists = {c: parse_list_field(c) for c in ("duties", "keywords", "titles")}
    texts = {
        c: clean_taxonomy_text(F.coalesce(c, F.lit("")))
        for c in raw.columns
        if c not in (*lists, "ordinal")
    }
    return raw.withColumns({**texts, **lists})


def ref_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("code"), "embedding", F.col("vec_id").alias("ordinal")
    )


def query_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """A vector per posting: an embedding blended with its own reverse."""
    blended = F.zip_with("embedding", F.reverse("embedding"), lambda x, y: x + y)
    return table(spark, sf, "embeddings").select(_mid("vec_id"), blended.alias("embedding"))


def files(spark: SparkSession, sf: str) -> DataFrame:
    from signpost.operators.progress import file_counts

    return file_counts(table(spark, sf, "documents"), "lang", "source")


SPLIT_AT = "2024-01-16"


def progress_half(spark: SparkSession, sf: str, late: bool) -> DataFrame:
    """Progress figures per user as if each user were a file; `late` is the second scan.

    A second scan of someone with sign-ups is authoritative, one without any
    purchase or error has no output.
    """
    events = table(spark, sf, "events")
    half = F.col("ts") >= F.lit(SPLIT_AT).cast("timestamp")
    kind = F.col("event_type")
    result = F.count_if(kind.isin("purchase", "view"))
    ignore = F.count_if(kind == "error")
    return (
        events.filter(half if late else ~half)
        .groupBy(F.col("user_id").cast("string").alias("file"))
        .agg(
            F.count("*").alias("source_lines"),
            result.alias("result_lines"),
            ignore.alias("ignore_lines"),
            (result + ignore > 0).alias("has_output"),
            (F.count_if(kind == "signup") > 8).alias("authoritative"),
        )
    )


# --- the same views for the SQL check -------------------------------------------


def trim_sql(text: str) -> str:
    return f"trim({text}, '{WHITE_SPACE}')"


POSTINGS = f"""postings AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS mid, {trim_sql('d.text')} AS job_intro, d.source,
         CASE WHEN length({trim_sql('d.text')}) < {SHORT_CHARS} THEN '{STATUS_FILTERED}'
              WHEN l.quality = 1 THEN '{STATUS_DONE}' ELSE '{STATUS_PENDING}' END AS status,
         d.lang AS category,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(d.n_chars) AS updated_at,
         CASE WHEN l.quality = 1 THEN d.source WHEN l.quality = 0 THEN '' END
           AS structured_summary,
         d.doc_id AS ordinal
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

RESULTS = f"""results AS (
  SELECT r.mid, r.copy, r.ordinal, coalesce(d.source, 'src0') AS file FROM (
    SELECT CAST(doc_id AS VARCHAR) AS mid, 0::BIGINT AS copy, doc_id AS ordinal FROM labels
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 1, doc_id + {BLOCK} FROM labels WHERE toxic = 1
    UNION ALL
    SELECT CAST(item_id + {EXTRA_ID} AS VARCHAR), 2, item_id + {2 * BLOCK} FROM benchmark
    UNION ALL
    SELECT ' ', 3, r_regionkey + {3 * BLOCK} FROM region) r
  LEFT JOIN documents d ON CAST(d.doc_id AS VARCHAR) = r.mid)"""

ELIGIBLE = f"""eligible AS (
  SELECT DISTINCT mid FROM postings WHERE status <> '{STATUS_FILTERED}' AND job_intro <> '')"""

RESULT_IDS = f"""result_ids AS (
  SELECT DISTINCT {trim_sql('mid')} AS mid FROM results WHERE {trim_sql('mid')} <> '')"""

TAXONOMY = f"""taxonomy AS (
  SELECT r_name AS big, r_name AS big_meaning, n_name AS middle, '' AS middle_meaning,
         c_mktsegment AS small, '' AS small_meaning, CAST(c_custkey AS VARCHAR) AS code,
         c_name AS code_meaning, c_mktsegment || chr(10) || c_name AS tasks,
         '' AS included_jobs, CAST(c_custkey + 2 AS VARCHAR) AS source_row,
         CASE WHEN c_acctbal >= 0 THEN c_name || ' ' || n_name ELSE '' END AS overview,
         CASE WHEN c_acctbal >= 0 THEN [c_mktsegment, n_name, r_name] ELSE [] END AS duties,
         CASE WHEN c_acctbal >= 0 THEN [n_name, r_name] ELSE [] END AS keywords,
         CASE WHEN c_acctbal >= 0 THEN [n_name || ';'] ELSE [] END AS titles,
         c_custkey AS ordinal
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey)"""


def unit_sql(name: str, source: str, key: str, vector: str) -> str:
    """CTE `name(key, v)` of unit vectors in single precision."""
    return f"""{name} AS (
  SELECT {key}, list_transform(e, lambda x: CAST(x * f AS FLOAT)) AS v FROM (
    SELECT {key}, {vector} AS e,
      CAST(1.0 / sqrt(list_sum(list_transform({vector},
        lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))) AS FLOAT) AS f
    FROM {source}))"""


REF_ROWS = "ref_rows AS (SELECT CAST(vec_id AS VARCHAR) AS code, embedding FROM embeddings)"
QUERY_ROWS = """query_rows AS (
  SELECT CAST(vec_id AS VARCHAR) AS mid,
    list_transform(list_zip(embedding, list_reverse(embedding)), lambda z: z[1] + z[2])
      AS embedding
  FROM embeddings)"""
REFS = f"{REF_ROWS}, {unit_sql('refs', 'ref_rows', 'code', 'embedding')}"
QUERIES = f"{QUERY_ROWS}, {unit_sql('queries', 'query_rows', 'mid', 'embedding')}"


def ranked_sql(name: str, k: int, queries: str = "queries", refs: str = "refs") -> str:
    """CTE `name(mid, code, cosine, rank)` of the k nearest."""
    return f"""{name} AS (
  SELECT mid, code, cosine, rank FROM (
    SELECT mid, code, cosine,
      row_number() OVER (PARTITION BY mid ORDER BY cosine DESC, code) AS rank
    FROM (SELECT q.mid, r.code, round(list_dot_product(CAST(q.v AS DOUBLE[]),
            CAST(r.v AS DOUBLE[])), 9) AS cosine FROM {queries} q, {refs} r))
  WHERE rank <= {k})"""


GRAPH = """edges AS (
  SELECT job_id, neighbor_id, score, rank FROM (
    SELECT job_id, neighbor_id, score,
      row_number() OVER (PARTITION BY job_id ORDER BY score DESC, neighbor_id) AS rank
    FROM (SELECT a.code AS job_id, b.code AS neighbor_id,
            round(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])), 9) AS score
          FROM refs a, refs b WHERE a.code <> b.code))
  WHERE rank <= 10)"""


def clamp_sql(cosine: str) -> str:
    # least and greatest skip nulls there too.
    return f"CASE WHEN {cosine} IS NOT NULL THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, {cosine})) END"
