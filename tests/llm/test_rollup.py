"""Rollups: deltas against counting anew, and batches sent again."""

import oracle
import pytest
from signpost.llm import rollup
from signpost.llm.queries import QUERIES, SQL
from signpost.session import scratch_dir

SF = "/root/testdata/sf0.001"
SIDE = "struct<source: string, lang: string, version: string, tokens: bigint>"
KIND = f"kind string, old {SIDE}, new {SIDE}, source int"


@pytest.fixture
def store(spark):
    return rollup.Rollup(spark, scratch_dir(spark, "rollup-test"))


def events(spark, rows):
    return spark.createDataFrame([(k, o, n, 0) for k, o, n in rows], KIND)


def totals(store):
    return sorted((tuple(r) for r in store.totals().collect()), key=str)


def test_deltas(spark, store):
    assert totals(store) == []
    a, b, c = ("s", "en", "v1", 5), ("s", "en", "v1", 7), (None, None, "v1", 3)
    store.commit(0, events(spark, [("insert", None, a), ("insert", None, b), ("insert", None, c), ("insert", None, c)]))
    assert totals(store) == sorted([("s", "en", "v1", 2, 12), (None, None, "v1", 2, 6)], key=str)
    store.commit(1, events(spark, [("delete", b, None), ("revise", a, ("s", "en", "v2", 9)), ("delete", c, None)]))
    want = sorted([("s", "en", "v2", 1, 9), (None, None, "v1", 1, 3)], key=str)
    assert totals(store) == want
    store.commit(2, events(spark, []))
    assert totals(store) == want


def test_batches_are_idempotent(spark, store):
    first = events(spark, [("insert", None, ("s", "en", "v1", 5))])
    second = events(spark, [("insert", None, ("s", "en", "v1", 2))])
    for batch, rows in ((0, first), (1, second), (1, second), (0, first)):
        store.commit(batch, rows)
    assert totals(store) == [("s", "en", "v1", 2, 7)]
    store.compact()
    store.commit(0, first)
    store.commit(1, second)
    store.commit(2, second)
    assert totals(store) == [("s", "en", "v1", 3, 9)]
    store.compact()
    store.compact()
    assert totals(store) == [("s", "en", "v1", 3, 9)] and store.committed() == (2, [])


def test_unfinished_batches_do_not_count(spark, store):
    rows = events(spark, [("insert", None, ("s", "en", "v1", 5))])
    store.commit(0, rows)
    rollup.added(rollup.signed(rows)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{store.path}/batch-1")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{store.path}/batch-1/_SUCCESS")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
    assert totals(store) == [("s", "en", "v1", 1, 5)]
    store.commit(1, rows)
    assert totals(store) == [("s", "en", "v1", 2, 10)]


def test_unknown_kinds_fail(spark, store):
    with pytest.raises(Exception, match="unknown kind of event"):
        store.commit(0, events(spark, [("upsert", None, ("s", "en", "v1", 5))]))


def test_query_against_sql(spark):
    assert oracle.compare(QUERIES["op9_token_rollup"](spark, SF), oracle.connect(SF), SQL["op9_token_rollup"]) > 0


def test_late_batches_count(spark, store):
    row = lambda n: events(spark, [("insert", None, ("s", "en", "v1", n))])
    for batch in (0, 1, 3):
        store.commit(batch, row(10**batch))
    store.compact()
    assert store.committed() == (1, [3]) and totals(store) == [("s", "en", "v1", 3, 1011)]
    store.commit(2, row(100))
    assert totals(store) == [("s", "en", "v1", 4, 1111)]
    store.compact()
    assert store.committed() == (3, []) and totals(store) == [("s", "en", "v1", 4, 1111)]
