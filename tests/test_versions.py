import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from signpost.operators import store
from signpost.operators.models import HashingEmbedder, embed_distinct, vector_store
from signpost.sources import sinks as W
from signpost.sources.taxonomy import read_taxonomy
from signpost.sources.versions import Conflict, VersionedTable, read_table, replace_table

STORE = "mid string, job_intro string, source string, status string, category string, updated_at string"


def stored(spark, tmp_path, n=200):
    rows = [(f"m{i}", f"text {i}", "s", "待处理", "", "t0") for i in range(n)]
    table = VersionedTable(spark, str(tmp_path / "store"), key="mid", parts=16)
    table.replace(spark.createDataFrame(rows, STORE))
    return table, rows


def files(table, parts=None):
    return {os.path.join(f, n) for f in table.folders(parts) for n in os.listdir(f) if n.endswith(".parquet")}


def test_load_rewrites_only_touched_parts(spark, tmp_path):
    table, rows = stored(spark, tmp_path)
    before = files(table)
    load = spark.createDataFrame(
        [("m3", "new text", "n", False, 0), ("new", "more text", "n", False, 1)],
        "mid string, job_intro string, source string, is_filtered boolean, ordinal long",
    )
    want = store.upsert_postings(spark.createDataFrame(rows, STORE), load, F.lit("t1"))
    store.load_postings(table, load, F.lit("t1"))
    assert sorted(table.read().collect()) == sorted(want.collect())
    gone = before - files(table)
    touched = {r[0] for r in load.select(table.part()).collect()}
    assert 0 < len(gone) <= len(touched)
    assert {int(os.path.dirname(f).rpartition("=")[2]) for f in gone} <= touched
    assert all(os.path.exists(f) for f in before)  # still readable for those who began before


def test_updates_of_stored_rows(spark, tmp_path):
    table, rows = stored(spark, tmp_path)
    before = files(table)
    store.mark_stored(table, spark.createDataFrame([(" m1 ",), ("other",)], "mid string"))
    store.update_stored(table, spark.createDataFrame([("m2", "c")], "mid string, category string"), ["category"])
    got = {r.mid: r for r in table.read().collect()}
    assert len(got) == len(rows) and got["m1"].status == "处理完成" and got["m2"].category == "c"
    assert sum(r.status == "处理完成" for r in got.values()) == 1
    assert len(before - files(table)) <= 3


def test_failure_before_the_switch_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "edges")
    edges = spark.createDataFrame([("a", "b", 0.5)], "job_id string, neighbor_id string, score double")
    W.write_neighbors(edges, path)

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_switch", die)
        with pytest.raises(OSError):
            W.write_neighbors(edges.withColumn("job_id", F.lit("z")), path)
    assert [r.job_id for r in read_table(spark, path).collect()] == ["a"]
    broken = edges.withColumn("score", F.raise_error(F.lit("bad")).cast("double"))
    with pytest.raises(Exception, match="bad"):
        W.write_neighbors(broken, path)
    assert [r.job_id for r in read_table(spark, path).collect()] == ["a"]
    W.write_neighbors(edges.withColumn("job_id", F.lit("z")), path)
    assert [r.job_id for r in read_table(spark, path).collect()] == ["z"]


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    row = spark.createDataFrame([("a", 1)], "k string, n int")
    replace_table(row, path)
    table = VersionedTable(spark, path)
    number, record = table._current()
    replace_table(row.withColumn("n", F.lit(2)), path)
    with pytest.raises(Conflict):
        table._commit(number, record, row, {}, None)
    assert read_table(spark, path).first().n == 2


def test_appends_meet(spark, tmp_path, monkeypatch):
    """Another writer is first: the append extends its record, and no row is lost."""
    table = VersionedTable(spark, str(tmp_path / "t"), key="k", parts=4)
    row = spark.createDataFrame([("a", 1)], "k string, n int")
    table.replace(row.limit(0))
    assert table.read().count() == 0
    old = table._current()
    table.append(row)
    answers = [old]
    current = VersionedTable._current
    monkeypatch.setattr(VersionedTable, "_current", lambda t: answers.pop() if answers else current(t))
    table.append(row.withColumn("n", F.lit(2)))
    assert sorted(r.n for r in table.read().collect()) == [1, 2]


def test_versions_are_pruned_and_batches_applied_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), key="k", parts=4, keep=2)
    row = spark.createDataFrame([("a", 1), (None, 5)], "k string, n int")
    for n in range(5):
        table.replace(row.withColumn("n", F.lit(n)), ("stream", n))
    assert len(os.listdir(tmp_path / "t" / "log")) >= 2 and len(table._numbers()) == 2
    assert sum(bool(d) for _, _, d in os.walk(tmp_path / "t" / "data")) >= 1
    held = [f for _, _, names in os.walk(tmp_path / "t" / "data") for f in names if f.endswith(".parquet")]
    assert len(held) <= 4  # two kept versions of at most two parts
    table.replace(row, ("stream", 4))
    assert {r.n for r in table.read().collect()} == {4}
    table.replace(row, ("another", 0))
    assert {r.n for r in table.read().collect()} == {1, 5}
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, str(tmp_path / "none")).read()


class Counting(HashingEmbedder):
    """Says in a file how many texts it was asked for."""

    log = ""

    def embed(self, texts):
        with open(self.log, "a") as out:
            out.write("x" * len(texts))
        if any("fails" in t for t in texts):
            raise ConnectionError("down")
        return super().embed(texts)


def test_second_run_makes_no_model_call(spark, tmp_path):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    log = str(tmp_path / "asked")
    open(log, "w").close()
    factory = type("Logged", (Counting,), {"log": log})
    rows = spark.createDataFrame([(i, f"text {i % 7}") for i in range(70)] + [(70, None)], "id int, text string")
    kept = vector_store(spark, str(tmp_path / "kept"), parts=4)

    def run(texts, model="m"):
        got = embed_distinct(texts, "text", factory, kept=kept, model=model).collect()
        return {r.id: r.embedding for r in got}

    plain = {r.id: r.embedding for r in embed_distinct(rows, "text").collect()}
    first = run(rows.filter("id < 3"))
    assert first == {i: plain[i] for i in range(3)} and os.path.getsize(log) == 3
    good = rows.filter("text is not null")
    assert run(good) == {i: v for i, v in plain.items() if i < 70} and os.path.getsize(log) == 7
    assert run(good) == {i: v for i, v in plain.items() if i < 70} and os.path.getsize(log) == 7
    run(good, "other model")
    assert os.path.getsize(log) == 14
    # A failure is not kept: it is tried again.
    bad = spark.createDataFrame([(1, "this fails")], "id int, text string")
    assert run(bad) == {1: None} and run(bad) == {1: None} and os.path.getsize(log) >= 16


def test_array_of_odd_elements_and_broken_files(spark, tmp_path):
    code = {"细类（职业）": "1-01", "大类": "B"}
    path = tmp_path / "t.json"
    path.write_text(json.dumps([code, 5, None, "s", [code], {**code, "细类（职业）": "1-02"}], ensure_ascii=False))
    assert [r.code for r in read_taxonomy(spark, str(path)).orderBy("ordinal").collect()] == ["1-01", "1-02"]
    path.write_text("[]")
    assert read_taxonomy(spark, str(path)).count() == 0
    path.write_text('[{"a": 1}, {"b"')
    with pytest.raises(Exception, match="MALFORMED"):
        read_taxonomy(spark, str(path)).collect()


def test_array_larger_than_a_variant(spark, tmp_path):
    """A pretty-printed array of over 200 MB, more than one VARIANT may hold."""
    path, n = tmp_path / "t.json", 2100
    with open(path, "w") as out:
        out.write("[\n")
        for i in range(n):
            out.write(json.dumps({"细类（职业）": f"{i:06}", "源行号": "x" * 100_000}, ensure_ascii=False, indent=1))
            out.write(",\n" if i + 1 < n else "\n]")
    assert os.path.getsize(path) > 200_000_000
    got = read_taxonomy(spark, str(path)).select("code", F.length("source_row").alias("n"), "ordinal")
    got = got.agg(F.count("*"), F.min("n"), F.max("n"), F.count_distinct("code")).first()
    assert tuple(got) == (n, 100_000, 100_000, n)
