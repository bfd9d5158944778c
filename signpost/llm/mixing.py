"""Mixing sources to target weights with DataFrame functions only.

Every document gets a hash-random key. Within a source the keys are cut into ranges; the
prefix sums of the range totals say in which range the source's budget ends, and only the rows
of that one range are summed one by one. What a document contributes then depends on its own
key and one small row per source, so no long row is ever shuffled and a source that holds most
rows costs no more than the others.

Defined results: a null text has size 0 and takes nothing; a null source is a source of its
own, the last; rows that repeat an id and a text share what their key takes; an empty table
gives no rows; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signpost.llm.tables import materialize, unique_name

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null, ordered as the sources by code point with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def random_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws("|", doc_id.cast("string"), F.md5(F.encode(text, "UTF-8"))))


def sized(docs: DataFrame) -> DataFrame:
    """Narrow rows: doc_id, source key, random key, size."""
    return docs.select(
        "doc_id",
        source_key(F.col("source")).alias("src"),
        random_key(F.col("doc_id"), F.col("text")).alias("key"),
        word_count(F.col("text")).alias("size"),
    )


def source_targets(totals: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """src, source_size, target from one row per source (src, source_size).

    A target stops at `max_epochs` times its source; the excess is shared again by weight. With
    the sources in order of size by weight, those that stop are the first ones, and a source
    stops if its share of what the earlier ones left is above its limit.
    """
    rank = F.row_number().over(Window.orderBy("src"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        totals.withColumn("weight", weight)
        .withColumn("most", F.col("source_size").cast("double") * max_epochs)
        .withColumn("size_all", F.sum(F.col("source_size").cast("double")).over(everything))
        .withColumn("weight_all", F.sum("weight").over(everything))
        .withColumn("most_before", F.coalesce(F.sum("most").over(by_ratio), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0)))
        .withColumn(
            "stops",
            (F.col("size_all") - F.col("most_before")) * F.col("weight")
            > F.col("most") * (F.col("weight_all") - F.col("weight_before")),
        )
        .withColumn("most_stopped", F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0.0)).over(everything))
        .withColumn("weight_free", F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))).over(everything))
    )
    share = F.col("weight") * ((F.col("size_all") - F.col("most_stopped")) / F.col("weight_free"))
    return rows.select("src", "source_size", F.when(F.col("stops"), F.col("most")).otherwise(share).alias("target"))


def source_cuts(
    rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, rows_per_range: int = 50_000
) -> DataFrame:
    """One row per source: src, source_size, target, epochs, cut_key, cut_copies, cut_rest.

    `rows` are those of `sized`, read several times. All epochs but the last are whole; in the
    last, keys below `cut_key` are taken and the `cut_copies` rows of that key share `cut_rest`.
    """
    count = rows.count()
    bits = min(16, max(0, math.ceil(math.log2(max(1, count / rows_per_range)))))
    key_range = F.shiftright(F.conv(F.substring("key", 1, 4), 16, 10).cast("int"), 16 - bits)
    ranged = rows.select("src", "key", "size", key_range.alias("part"))
    sums = materialize(ranged.groupBy("src", "part").agg(F.sum("size").alias("part_size")), "mix-sums")
    totals = sums.groupBy("src").agg(F.sum("part_size").alias("source_size"))
    budgets = materialize(
        source_targets(totals, weights, max_epochs)
        .withColumn("budget", F.floor("target"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")),
        "mix-budgets",
    )
    before = F.coalesce(
        F.sum("part_size").over(
            Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    ends = (
        sums.withColumn("before", before)
        .join(budgets.select("src", "rest"), "src")
        .where("before < rest and before + part_size >= rest")
        .select("src", "part", F.col("rest") - F.col("before"))
        .toDF("src", "part", "left")
    )
    keys = (
        ranged.join(F.broadcast(ends) if _few(budgets) else ends, ["src", "part"])
        .groupBy("src", "part", "key", "left")
        .agg(F.sum("size").alias("key_size"), F.count("*").alias("copies"))
    )
    upto = Window.partitionBy("src", "part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        keys.withColumn("key_before", F.coalesce(F.sum("key_size").over(upto), F.lit(0)))
        .where("key_before < left and key_before + key_size >= left")
        .select(
            "src",
            F.col("key").alias("cut_key"),
            F.col("copies").alias("cut_copies"),
            (F.col("left") - F.col("key_before")).alias("cut_rest"),
        )
    )
    return budgets.join(cuts, "src", "left").select(
        "src", "source_size", "target", "epochs", "cut_key", "cut_copies", "cut_rest"
    )


def _few(sources: DataFrame, most: int = 100_000) -> bool:
    """Whether a table of one short row per source is small enough to broadcast."""
    return sources.count() <= most


def in_last_epoch(key: Column, size: Column) -> Column:
    """Words that the last, partial epoch takes of a row joined with its source's cut."""
    return (
        F.when(F.col("cut_key").isNull() | (key > F.col("cut_key")), F.lit(0))
        .when(key < F.col("cut_key"), size)
        .otherwise(F.expr("cut_rest div cut_copies"))
        .cast("long")
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, rows_per_range: int = 50_000
) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words the mix takes of each document."""
    rows = materialize(sized(docs), "mix-rows")
    cuts = materialize(source_cuts(rows, weights, max_epochs, rows_per_range), "mix-cuts")
    joined = rows.join(F.broadcast(cuts) if _few(cuts) else cuts, "src")
    taken = F.col("epochs") * F.col("size") + in_last_epoch(F.col("key"), F.col("size"))
    return joined.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, rows_per_range: int = 50_000
) -> DataFrame:
    """The mixed corpus: rows of `docs`, each as often as epochs take words of it.

    The document in which a budget ends stays whole. Columns are those of `docs`.
    """
    rows = materialize(sized(docs), "mix-rows")
    cuts = materialize(source_cuts(rows, weights, max_epochs, rows_per_range), "mix-cuts")
    src, key, again = (unique_name(docs, n) for n in ("mix_src", "mix_key", "mix_again"))
    renamed = cuts.select(
        F.col("src").alias(src),
        F.struct("epochs", "cut_key").alias(again),
    )
    keyed = docs.withColumn(src, source_key(F.col("source"))).withColumn(
        key, random_key(F.col("doc_id"), F.col("text"))
    )
    times = F.col(again)["epochs"] + F.when(F.col(key) <= F.col(again)["cut_key"], 1).otherwise(0)
    joined = keyed.join(F.broadcast(renamed) if _few(cuts) else renamed, src)
    out = joined.withColumn(again, F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return out.select(*docs.columns)


SQL = r"""
WITH base AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
    md5(concat_ws('|', CAST(doc_id AS VARCHAR), md5(text))) AS key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
totals AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY src),
weighed AS (
  SELECT *, CAST((row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS DOUBLE) AS weight,
    CAST(source_size AS DOUBLE) * 3 AS most FROM totals),
summed AS (
  SELECT *, sum(CAST(source_size AS DOUBLE)) OVER () AS size_all, sum(weight) OVER () AS weight_all,
    coalesce(sum(most) OVER w, 0.0) AS most_before, coalesce(sum(weight) OVER w, 0.0) AS weight_before
  FROM weighed
  WINDOW w AS (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (
  SELECT *, (size_all - most_before) * weight > most * (weight_all - weight_before) AS stops FROM summed),
shared AS (
  SELECT src, source_size,
    CASE WHEN stops THEN most ELSE weight * ((size_all - sum(CASE WHEN stops THEN most ELSE 0.0 END) OVER ())
      / sum(CASE WHEN stops THEN 0.0 ELSE weight END) OVER ()) END AS target
  FROM flagged),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs,
    CAST(floor(target) AS BIGINT) AS budget FROM shared),
keyed AS (SELECT src, key, sum(size) AS key_size, count(*) AS copies FROM base GROUP BY src, key),
prefixed AS (
  SELECT *, coalesce(sum(key_size) OVER (PARTITION BY src ORDER BY key
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS key_before FROM keyed)
SELECT b.doc_id, b.size, s.source_size, CAST(s.target AS DOUBLE) AS target,
  CAST(s.epochs * b.size + greatest(0, least(p.key_size, s.budget - s.epochs * s.source_size - p.key_before))
    // p.copies AS BIGINT) AS taken
FROM base b JOIN budgets s USING (src) JOIN prefixed p USING (src, key)
"""
