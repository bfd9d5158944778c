"""Mixing against a plain computation and against SQL."""

import hashlib
import re

import oracle
import pytest
from signpost.llm import mixing
from signpost.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(rows):
    """doc_id -> (size, source size, target, taken), one source after the other."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total = {s: sum(size(t) for _, t, x in rows if x == s) for s in names}
    target, open_, left = {}, set(names), sum(total.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * total[s]}
        if not above:
            break
        for s in above:
            target[s] = 3.0 * total[s]
            left -= 3 * total[s]
        open_ -= above
    target |= share
    out = []
    for s in names:
        mine = [(hashlib.md5(f"{d}|{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest(), d, size(t)) for d, t, x in rows if x == s and t is not None]
        budget = int(target[s] + 1e-9)
        epochs, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for _, d, n in sorted(mine):
            part = min(n, max(0, rest))
            rest -= n
            out.append((d, n, total[s], epochs * n + part))
    return sorted(out), target


@pytest.mark.parametrize("ranges", [1, 3, 50_000])
def test_against_plain(spark, ranges):
    rows = [(i, "w " * (i * 7 % 23 + 1), f"s{i % 5 if i % 3 else 0}") for i in range(200)]
    rows += [(900, "a b c", None), (901, "\xa0one word\t two", "s9"), (902, "", "s9")]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(frame, rows_per_range=ranges).collect()
    want, target = plain(rows)
    assert sorted((r.doc_id, r.size, r.source_size, r.taken) for r in got) == want
    source = {d: s for d, _, s in rows}
    assert all(abs(r.target - target[source[r.doc_id]]) < 1e-6 and r.taken <= 3 * r.size for r in got)


def test_nulls_repeats_and_empty(spark):
    kind = "doc_id long, text string, source string"
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, "s"), (None, "x y", None), (3, "", "t")]
    got = mixing.mix(spark.createDataFrame(rows, kind)).collect()
    assert len(got) == 5
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert len({r.taken for r in got if r.doc_id == 1}) == 1
    assert mixing.mix(spark.createDataFrame([], kind)).count() == 0
    assert mixing.mixed_documents(spark.createDataFrame([], kind)).count() == 0


def test_mixed_documents_follow_the_mix(spark):
    rows = [(i, "w " * (i % 5 + 1), "big" if i % 4 else "small", i) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, _mix_key long")
    taken = {r.doc_id: r for r in mixing.mix(frame).collect()}
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for d, r in taken.items():
        assert times.get(d, 0) == -(-r.taken // r.size)


def test_query_against_sql(spark):
    assert oracle.compare(QUERIES["op10_mix_sources"](spark, SF), oracle.connect(SF), SQL["op10_mix_sources"]) > 0
