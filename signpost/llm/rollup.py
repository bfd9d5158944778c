"""Token counts kept up to date by deltas.

A rollup is a folder of committed batches. A batch takes change events: documents inserted,
deleted, or counted again (with another text, source, language or tokenizer version). Each event
becomes signed rows, minus what was counted and plus what now counts, and a batch commits the sum
of its signed rows by source, language and tokenizer version. Totals are the sum over all
committed batches, so they never need the documents again.

A batch is idempotent: it is written under its number, so a batch that failed half-way or is sent
again replaces itself, and only folders that were committed as a whole are read. Batches are
numbered from 0. `compact` folds the batches up to the first number not committed into one snapshot; batches up to that number are then neither read nor
written again.

Sums are partial before they are shuffled, so a source that holds most events costs one row per
task. Events' rows carry a handful of numbers, no texts.

Defined results: null source, language or version are groups of their own; a null text has 0
tokens; an insert has no old side and a delete no new one, whatever its columns hold; events that
repeat a document count each; groups whose documents and tokens are all taken back disappear;
an empty batch commits nothing; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signpost.llm.tables import materialize, read
from signpost.session import scratch_dir

KEYS = ["source", "lang", "version"]
TOTALS = "source string, lang string, version string, documents bigint, tokens bigint"

# Counting by version: runs of anything but white space; words and single marks apart.
VERSIONS = {"spaces-1": r"[^\x20\x09-\x0D]+", "marks-2": r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"}


def token_count(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def side(source: Column, lang: Column, version: Column | str, tokens: Column) -> Column:
    """What is counted of a document on one side of an event."""
    named = F.lit(version) if isinstance(version, str) else version
    return F.struct(
        source.cast("string").alias("source"), lang.cast("string").alias("lang"), named.alias("version"), tokens.cast("long").alias("tokens")
    )


def signed(events: DataFrame) -> DataFrame:
    """Signed rows of events with columns kind (insert, delete, revise), old and new (see `side`)."""
    minus = F.array(F.struct(F.lit(-1).cast("long").alias("sign"), F.col("old").alias("of")))
    plus = F.array(F.struct(F.lit(1).cast("long").alias("sign"), F.col("new").alias("of")))
    rows = F.when(F.col("kind") == "insert", plus).when(F.col("kind") == "delete", minus).when(
        F.col("kind") == "revise", F.concat(minus, plus)
    )
    # An unknown kind must not be lost in silence.
    known = F.when(rows.isNull(), F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null"))))).otherwise(rows)
    return events.select(F.explode(known).alias("row")).select(
        *[F.col(f"row.of.{k}").alias(k) for k in KEYS],
        F.col("row.sign").alias("documents"),
        (F.col("row.sign") * F.col("row.of.tokens")).alias("tokens"),
    )


def added(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    return sums.where("documents <> 0 or tokens <> 0")


class Rollup:
    """Totals by source, language and tokenizer version in a folder all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entries(self) -> list[tuple[str, int]]:
        """(kind, number) of the folders that were committed as a whole."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(conf)
        if not files.exists(root):
            return []
        found = []
        for status in files.listStatus(root):
            kind, _, number = status.getPath().getName().rpartition("-")
            done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if kind in ("batch", "upto") and number.isdigit() and files.exists(done):
                found.append((kind, int(number)))
        return found

    def committed(self) -> tuple[int, list[int]]:
        """The number up to which batches are folded (-1: none), and the batches after it."""
        entries = self._entries()
        upto = max((n for kind, n in entries if kind == "upto"), default=-1)
        return upto, sorted(n for kind, n in entries if kind == "batch" and n > upto)

    def commit(self, batch: int, events: DataFrame) -> None:
        """Add a batch of events, or replace it by the same number; one that is folded is ignored."""
        if batch <= self.committed()[0]:
            return
        # The sums of a batch are few: one row per source, language and version.
        added(signed(events)).write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")

    def totals(self) -> DataFrame:
        return self._sums(*self.committed())

    def _sums(self, upto: int, batches: list[int]) -> DataFrame:
        paths = [f"{self.path}/batch-{n}" for n in batches] + ([f"{self.path}/upto-{upto}"] if upto >= 0 else [])
        if not paths:
            return self.spark.createDataFrame([], TOTALS)
        return added(self.spark.read.schema(TOTALS).parquet(*paths))

    def compact(self) -> None:
        """Fold the committed batches up to the first missing number, which may still come, into one snapshot."""
        upto, batches = self.committed()
        whole = [n for k, n in enumerate(batches, upto + 1) if n == k]
        if whole:
            self._sums(upto, whole).write.mode("overwrite").parquet(f"{self.path}/upto-{whole[-1]}")


def corpus_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a life of the given tables in four batches, one of them sent twice.

    All documents are inserted, counted by spaces. Those of odd id are counted again by marks.
    Those that `labels` calls toxic are deleted as they then stand. Those of quality 1 that remain
    move to the source `curated`. The second batch comes again at the end, and the first two are
    folded in between.
    """
    old, new = "spaces-1", "marks-2"
    text = F.col("text")
    # Texts are counted where they are read; from then on only numbers travel.
    docs = materialize(
        read(spark, sf_dir, "documents").select(
            "doc_id", "source", "lang", token_count(text, old).alias("by_old"), token_count(text, new).alias("by_new")
        ),
        "rollup-counts",
    )
    labels = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    odd = F.coalesce(F.col("doc_id") % 2 != 0, F.lit(False))
    source, lang = F.col("source"), F.col("lang")
    rollup = Rollup(spark, scratch_dir(spark, "rollup"))

    plain = side(source, lang, old, F.col("by_old"))
    marked = side(source, lang, new, F.col("by_new"))
    standing = F.when(odd, marked).otherwise(plain)
    none = F.lit(None).cast("struct<source: string, lang: string, version: string, tokens: bigint>")
    curated = standing.withField("source", F.lit("curated"))

    inserted = docs.select(F.lit("insert").alias("kind"), none.alias("old"), plain.alias("new"))
    revised = docs.where(odd).select(F.lit("revise").alias("kind"), plain.alias("old"), marked.alias("new"))
    named = docs.join(labels, "doc_id")
    deleted = named.where("toxic = 1").select(F.lit("delete").alias("kind"), standing.alias("old"), none.alias("new"))
    moved = named.where("quality = 1 and coalesce(toxic, 0) <> 1").select(
        F.lit("revise").alias("kind"), standing.alias("old"), curated.alias("new")
    )
    rollup.commit(0, inserted)
    rollup.commit(1, revised)
    rollup.compact()
    rollup.commit(2, deleted)
    rollup.commit(3, moved)
    rollup.commit(1, revised)
    return rollup.totals()


SQL = r"""
WITH marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
standing AS (
  SELECT CASE WHEN m.quality = 1 THEN 'curated' ELSE d.source END AS source, d.lang,
    CASE WHEN d.doc_id % 2 <> 0 THEN 'marks-2' ELSE 'spaces-1' END AS version,
    CASE WHEN d.doc_id % 2 <> 0
      THEN coalesce(len(regexp_extract_all(d.text, '[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]')), 0)
      ELSE coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) END AS tokens
  FROM documents d LEFT JOIN marks m USING (doc_id)
  WHERE coalesce(m.toxic, 0) <> 1)
SELECT source, lang, version, count(*) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens
FROM standing GROUP BY ALL
"""
