"""The pipeline stage by stage, on the smallest tables and on odd rows."""

import __spark_entry__ as driver
import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from signpost.session import materialize
from test_chosen_path import brute

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    """name -> (what went in, what came out)."""
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), name)
        seen[name] = docs, out
        docs = out
    return seen


@pytest.fixture(scope="module")
def seen(spark):
    return stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_languages(seen):
    docs, out = seen["language_id"]
    assert out.columns == docs.columns and out.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_one_of_each_group(seen):
    docs, out = seen["near_duplicates"]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, c, _ in brute(rows) if d == c)


def test_pseudonyms(seen):
    docs, out = seen["pseudonyms"]
    old = {r.doc_id: r.text for r in docs.collect()}
    new = {r.doc_id: r.text for r in out.collect()}
    assert set(old) == set(new)
    private = r"[0-9]{13,19}|@|[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+|[+(][0-9]|token"
    plain = docs.where(~F.col("text").rlike(private)).collect()
    assert plain and all(new[r.doc_id] == r.text for r in plain)
    assert any(old[d] != new[d] for d in old)


def test_mix_and_pack(spark, seen):
    docs, out = seen["mix_sources"]
    assert out.columns == docs.columns and 0 < out.count() <= 3 * docs.count()
    docs, out = seen["pack"]
    lengths = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert lengths.where("n > 1024").isEmpty() and lengths.where("n < 1024").count() <= 1
    assert out.where("start = 0").count() == docs.count()


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = [(None, None, None, None, None), (None, "", None, "x", 1), (5000, "words to be kept", None, None, 1), (5001, "12 !", None, None, 1)]
    rows = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame(odd, docs.schema))
    rows = materialize(rows.withColumns({"lang_pred": F.lit(1), "_near_key": F.lit("z"), "src": F.lit(2), "part": F.lit(3)}), "odd")
    seen = stages(spark, rows)
    assert seen["mix_sources"][1].columns == rows.columns
    assert seen["near_duplicates"][1].where("doc_id = 5000").count() == 1
    assert seen["pack"][1].where("doc_id = 5000").count() > 0


def test_empty_table(spark):
    seen = stages(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(0))
    assert all(out.count() == 0 for _, out in seen.values())


def test_registered(spark):
    assert {"pipeline", *(n for n in driver.queries() if n.startswith("op"))} <= set(driver.queries())
    assert sum(n.startswith("op") and n[2].isdigit() for n in driver.queries()) == 10
    assert driver.queries()["pipeline"](spark, SF).count() > 0
