"""What is left on disk, and what goes through shuffles."""

import os
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from signpost import session
from signpost.operators import packed as P
from signpost.operators import store
from signpost.plans import classify as K
from signpost.plans import index as I
from signpost.plans import views as V
from signpost.schema import RESULT_TEXT_CHARS


def plan(rows):
    return rows._jdf.queryExecution().toString()


def test_packed_vectors_keep_every_bit():
    rng = np.random.default_rng(1)
    counts = (rng.poisson(0.3, 512) * np.float32(0.0371)).astype(np.float32)
    rows = [None, [], [0.0, -0.0, 1.5], [float("nan"), float("inf")], rng.normal(size=512), counts, list(range(300))]
    vectors = pa.array([None if r is None else list(map(float, r)) for r in rows], pa.list_(pa.float32()))
    for part in (vectors, vectors.slice(2, 3), vectors.slice(0, 0)):
        back = P.unpack(P.pack(part))
        assert back.is_valid().to_pylist() == part.is_valid().to_pylist()
        for x, y in zip(part, back):
            assert not x.is_valid or np.asarray(x.values).tobytes() == np.asarray(y.values).tobytes()
    sizes = [len(x) for x in P.pack(vectors).to_pylist() if x is not None]
    assert sizes[4] < 512 and max(sizes) <= 5 + 4 * 512


def test_a_written_table_leaves_no_shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def files():
        return {f for d in dirs for _, _, names in os.walk(str(d)) for f in names if f.startswith("shuffle_")}

    before = files()
    rows = session.materialize(spark.range(20_000).repartition(4).groupBy(F.col("id") % 7).count(), "counts")
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left
    assert rows.count() == 7
    assert spark.conf.get(session._DROP_SHUFFLES) == "false"


def test_a_graph_leaves_only_its_edges(spark, tmp_path, monkeypatch):
    codes = V.taxonomy(spark, "/root/testdata/sf0.001")
    refs = session.materialize(I.embed_taxonomy(codes).select("code", "embedding", "ordinal"), "vectors")
    labels = iter(range(99))
    monkeypatch.setattr(session, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}-{next(labels)}")
    edges = I.build_graph(codes, refs, 3)
    assert edges.count() == 3 * codes.count()
    assert [d.rsplit("-", 1)[0] for d in os.listdir(tmp_path)] == ["graph"]


def test_vectors_of_codes_listed_once_are_not_shuffled(spark):
    codes = V.taxonomy(spark, "/root/testdata/sf0.001")
    assert "Window" not in plan(I.embed_taxonomy(codes))
    twice = codes.unionByName(codes.limit(1).withColumns({"code": F.lit(" 5 "), "ordinal": F.lit(-1).cast("long")}))
    entries = I.embed_taxonomy(twice)
    assert "Window" in plan(entries)
    assert entries.filter("code = '5'").select("ordinal").collect() == [(-1,)]
    assert entries.count() == codes.count()


def test_known_ids_go_to_the_texts(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "mid string, job_intro string")
    done = spark.createDataFrame([(" a ",), (None,)], "mid string")
    todo = store.backfill_missing(rows, done)
    assert "strategy=broadcast" in plan(todo)
    assert sorted(r.job_intro for r in todo.collect()) == ["y", "z"]


def test_only_what_a_result_needs_of_a_text_is_kept(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(K, "match_vectors", lambda rows, *a, f=K.match_vectors, **o: (seen.append(rows), f(rows, *a, **o))[1])
    text = "  x\r\ny " + "ab " * 400
    rows = spark.createDataFrame([("1", text, "s", [1.0, 0.0])], "mid string, job_intro string, source string, embedding array<float>")
    refs = spark.createDataFrame([("0", [1.0, 0.0])], "code string, embedding array<float>")
    graph = spark.createDataFrame([], "job_id string, neighbor_id string, score double")
    result = K.classify_vectors(rows, refs, graph, V.taxonomy(spark, "/root/testdata/sf0.001")).first()
    assert seen[0].columns == ["mid", "job_intro", "embedding"]
    assert result["job_intro"] == ("x y " + "ab " * 400)[:RESULT_TEXT_CHARS] + "..."
