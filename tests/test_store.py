import hashlib
import itertools

import pytest
from pyspark.sql import functions as F

from signpost.operators import progress as R
from signpost.operators import reconcile as C
from signpost.operators import routing, store
from signpost.operators.models import HashingEmbedder, embed_distinct
from signpost.streaming.jobs import reduce_scans

PENDING, FILTERED, DONE = "待处理", "过滤", "处理完成"
STORE = "mid string, job_intro string, source string, status string, category string, updated_at string"


def sequential_status(old, shorts):
    """Apply the rows of one id one after the other."""
    status = old
    for short in shorts:
        if short:
            status = FILTERED
        elif status in (None, FILTERED):
            status = PENDING
    return status


def test_upsert_in_every_order(spark):
    olds = [None, PENDING, FILTERED, DONE]
    orders = [s for n in (1, 2, 3) for s in itertools.product([True, False], repeat=n)]
    rows, load, want = [], [], {}
    for i, (old, shorts) in enumerate(itertools.product(olds, orders)):
        mid = f"m{i}"
        if old:
            rows.append((mid, "old", "s", old, "cat", "t0"))
        load += [(mid, f"new{j}", "n", s, j) for j, s in enumerate(shorts)]
        want[mid] = (f"new{len(shorts) - 1}", sequential_status(old, shorts), "cat" if old else "")
    rows.append(("kept", "old", "s", DONE, "cat", "t0"))
    want["kept"] = ("old", DONE, "cat")
    new = spark.createDataFrame(
        load, "mid string, job_intro string, source string, is_filtered boolean, ordinal int"
    )
    for parts in (1, 5):
        merged = store.upsert_postings(
            spark.createDataFrame(rows, STORE), new.repartition(parts), F.lit("t1")
        )
        got = {r.mid: (r.job_intro, r.status, r.category) for r in merged.collect()}
        assert got == want


def test_ids_get_a_salt_on_collision(spark):
    def key(text):
        return hashlib.sha256(text.encode()).hexdigest()[:32]

    taken = key("1|x|intro|src")
    rows = [(1, " x ", "intro", "src"), (2, taken, "other", "src"), (3, "y", None, "src")]
    df = spark.createDataFrame(rows, "ordinal long, mid string, job_intro string, source string")
    got = {r.ordinal: (r.source_mid, r.mid) for r in store.normalize_job_ids(df, "ordinal").collect()}
    assert got == {
        1: (" x ", key("1|x|intro|src|1")),
        2: (taken, taken),
        3: ("y", key("3|y||src")),
    }


def test_updates_by_key(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    change = spark.createDataFrame([("a", None), ("c", 9)], "k string, v int")
    got = {r.k: r.v for r in store.update_by_key(table, change, "k", ["v"]).collect()}
    assert got == {"a": None, "b": 2}


@pytest.fixture
def case(spark):
    posts = spark.createDataFrame(
        [("a", "text a", PENDING), ("b", "text b", DONE), ("c", "x", FILTERED), ("d", "text d", PENDING)],
        "mid string, job_intro string, status string",
    ).withColumn("file", F.lit("f"))
    results = spark.createDataFrame(
        [(1, "a"), (2, " a "), (3, "b"), (4, "c"), (5, "zz"), (6, " ")], "ordinal int, mid string"
    ).withColumn("file", F.lit("f"))
    return posts, results


def test_reconcile_and_repair(case):
    posts, results = case
    source = posts.select("mid", "job_intro", "file")
    ignored = routing.ignored(posts).withColumn("file", F.lit("f"))
    before = C.reconcile(source, posts, results, ignored).first()
    assert not before.ok and before.need_rewrite and before.need_backfill
    assert (before.result_rows, before.unique_ids, before.valid_ids) == (6, 4, 2)
    diff = C.diff_result_store(results, posts).first()
    assert tuple(diff) == (2, 1, 2, "d")
    fixed = C.dedup_keep_first(C.drop_extras(results, posts))
    assert sorted((r.mid, r.ordinal) for r in fixed.collect()) == [("a", 1), ("b", 3)]
    again = C.dedup_keep_first(C.drop_extras(fixed, posts))
    assert sorted(again.collect()) == sorted(fixed.collect())
    missing = store.backfill_missing(routing.pending_match(posts), fixed).select("mid", "file")
    complete = fixed.select("mid", "file").unionByName(missing)
    after = C.reconcile(source, posts, complete, ignored)
    row = after.first()
    assert row.ok and not (row.need_rewrite or row.need_backfill or row.need_ignore_fix)
    assert C.manifest_rows(after).first().asDict() == {
        "file": "f", "total": 4, "processed": 3, "filtered": 1, "db": 4, "ok": True,
    }
    routes = {r.route: (r.ids, r.in_source) for r in C.routed_union(complete, ignored, source).collect()}
    assert routes == {"result": (3, 3), "ignored": (1, 1)}
    assert C.diff_result_store(complete, posts).first().missing_sample == ""


def test_dedup_of_a_hot_id(spark):
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("mid"),
        (-F.col("id")).alias("ordinal"),
    )
    got = C.dedup_keep_first(rows)
    assert got.count() == 20_001
    assert got.filter("mid = 'hot'").first().ordinal == -29_997


def sequential_merge(old, scans):
    """Apply scans (source, result, ignore, has_output, authoritative) to a stored state."""
    state = old
    for s in scans:
        done = s[1] + s[2]
        if state is None or s[4] or (s[3] and done >= state[1] + state[2]):
            state = s[:3]
    return state


def test_scans_reduce_to_what_applying_them_gives(spark):
    kinds = [(9, 0, 0, False, False), (9, 3, 1, True, False), (8, 2, 2, True, False),
             (9, 1, 0, True, True), (7, 5, 0, True, False)]
    olds = [None, (9, 2, 1), (9, 8, 1)]
    want, scans, stored = {}, [], []
    cases = itertools.product(olds, [c for n in (1, 2, 3) for c in itertools.product(kinds, repeat=n)])
    for i, (old, seq) in enumerate(cases):
        want[f"f{i}"] = sequential_merge(old, seq)
        scans += [(f"f{i}", *s, j) for j, s in enumerate(seq)]
        if old:
            stored.append((f"f{i}", *old))
    figures = "file string, source_lines long, result_lines long, ignore_lines long"
    new = spark.createDataFrame(
        scans, f"{figures}, has_output boolean, authoritative boolean, scan_no int"
    ).repartition(6)
    merged = R.merge_progress(spark.createDataFrame(stored, figures), reduce_scans(new))
    got = {r.file: (r.source_lines, r.result_lines, r.ignore_lines) for r in merged.collect()}
    assert got == want


def test_throughput_over_days(spark):
    rows = spark.createDataFrame(
        [("2024-01-01 23:59:50", 10), ("2024-01-01 23:59:55", 20), ("2024-01-02 00:00:05", 5)],
        "t string, n long",
    ).select(F.col("t").cast("timestamp").alias("window_start"), "n")
    got = R.throughput(rows, 5).orderBy("window_start").collect()
    assert [(r.per_second, r.avg_per_second) for r in got] == [(2.0, 2.0), (4.0, 3.0), (1.0, 1.75)]


def test_hot_text_is_embedded_once_and_every_row_kept(spark):
    rows = spark.range(0, 900, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    got = embed_distinct(rows, "text", salts=4, hot_rows=50).collect()
    model = HashingEmbedder()
    assert len(got) == 900 and len({r.id for r in got}) == 900
    assert all(r.embedding == model.embed_one(r.text).tolist() and r.error is None for r in got)


def test_ids_are_salted_until_none_is_contested(spark):
    """Valid ids planted on a row's hash and on its first two salted hashes; repeated rows too."""
    kind = "mid string, job_intro string, source string, n long"
    rows = [("x", "text", "s", 7), ("x", "text", "s", 7), ("y", "other", "s", 8)]
    for _ in range(3):
        got = store.normalize_job_ids(spark.createDataFrame(rows, kind), "n").collect()
        (mine,) = {r.mid for r in got if r.source_mid == "x"}
        assert mine not in {r[0] for r in rows} and len(got) == len(rows)
        rows.append((mine, "planted", "s", 100 + len(rows)))
    assert len({r[0] for r in rows[3:]}) == 3
    with pytest.raises(RuntimeError):
        store.normalize_job_ids(spark.createDataFrame(rows, kind), "n", most_salts=2)
