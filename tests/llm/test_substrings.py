"""Repeated passages against a plain search of windows, and the automaton against plain substrings."""

import hashlib
import random
import re

import oracle
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from signpost.llm import substrings
from signpost.llm.queries import QUERIES, SQL

# Columns that clash with names used inside.
KIND = "doc_id long, text string, key string, first int, words string"


def brute(rows, length):
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    order = lambda d: float("inf") if d is None else d
    least = {}
    for d, words in split:
        for k in range(len(words) - length + 1):
            w = tuple(words[k : k + length])
            least[w] = min(order(d), least.get(w, float("inf")))
    out = []
    for d, words in split:
        gone = set()
        for k in range(len(words) - length + 1):
            if least[tuple(words[k : k + length])] < order(d):
                gone |= set(range(k, k + length))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((-1 if d is None else d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(frame):
    assert frame.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return sorted((-1 if r.doc_id is None else r.doc_id, *tuple(r)[1:]) for r in frame.collect())


def corpus():
    pick = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    passage = [pick.choice(words) for _ in range(40)]
    rows = [(i, " ".join(pick.choice(words) for _ in range(pick.randrange(0, 60)))) for i in range(40, 70)]
    # One passage in many texts, each time between other words and cut elsewhere.
    for i in range(80):
        a, b = sorted(pick.sample(range(41), 2))
        around = [pick.choice(words) for _ in range(12)]
        rows.append((100 + i, " ".join(around[:6] + passage[a:b] + around[6:])))
    rows += [(300 + i, rows[0][1] + " " + rows[5][1]) for i in range(5)]
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "w1 " * 50), (5, "w1 " * 33), (None, "w1 w1 " * 20)]
    rows += [(None, " ".join(passage)), (None, " ".join(passage)), (310, rows[1][1].replace(" ", "\n\t")), (20, rows[1][1])]
    rows += [(20, rows[1][1]), (311, "one two"), (312, "one two"), (6, "w1 w1 " * 20)]
    return rows


@pytest.mark.parametrize("length, gram, most, shard", [(8, 3, 256, 1 << 14), (8, 8, 2, 30), (5, 1, 0, 1), (12, 4, 5, 200)])
def test_brute(spark, length, gram, most, shard):
    rows = corpus()
    frame = spark.createDataFrame([(*r, "k", 1, "w") for r in rows], KIND).repartition(5)
    assert got(substrings.removed(frame, length, gram, most, shard)) == brute(rows, length)


def test_texts(spark):
    rows = [(1, "a b c d e f"), (2, "x a b c d y"), (3, "a b c")]
    frame = spark.createDataFrame([(*r, "k", 1, "w") for r in rows], KIND)
    found = {r.doc_id: r.text for r in substrings.without_repeats(frame, length=3, gram=2).collect()}
    assert found == {1: "a b c d e f", 2: "x y", 3: ""}


def test_long_text(spark):
    text = " ".join(f"{i % 977} {i * i % 1009}" for i in range(100_000))
    rows = [(1, text), (2, "before " + text + " after"), (3, "the " * 200_000)]
    frame = spark.createDataFrame([(*r, "k", 1, "w") for r in rows], KIND)
    found = {r.doc_id: tuple(r)[1:3] for r in substrings.removed(frame).collect()}
    assert found == {1: (200_000, 0), 2: (200_002, 200_000), 3: (200_000, 0)}


def test_empty(spark):
    assert substrings.removed(spark.createDataFrame([], KIND)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=12), min_size=1, max_size=5), st.text("abc", max_size=15), st.integers(1, 6))
def test_statistics(texts, text, most):
    automaton = substrings.Automaton()
    for k, t in enumerate(texts):
        automaton.add(list(t), 10 - k)
    automaton.settle()
    for end, (matched, first) in enumerate(automaton.statistics(list(text), most), 1):
        want = max(m for m in range(most + 1) if m <= end and any(text[end - m : end] in t for t in texts))
        assert matched == want
        if matched:
            assert first == min(10 - k for k, t in enumerate(texts) if text[end - matched : end] in t)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    assert oracle.compare(QUERIES["op12_substrings"](spark, sf), oracle.connect(sf), SQL["op12_substrings"]) > 0
