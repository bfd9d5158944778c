"""The chosen-path join against all pairs."""

import random
import re

import numpy as np
from pyspark import cloudpickle
from signpost.llm import chosen_path


def grams(text):
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """[(doc_id, class, links)] by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            shared = len(sets[i] & sets[j])
            if shared and shared / (len(sets[i]) + len(sets[j]) - shared) >= 0.8 - 1e-12:
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return sorted((d, min(groups[find(i)]), links[i]) for i, (d, _) in enumerate(rows))


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(40)]
    base = [word() for _ in range(90)]
    rows = []
    for k in range(120):  # one large group of near copies
        copy = [word() if rng.random() < 0.012 else w for w in base]
        rows.append(" ".join(copy))
    for k in range(60):  # a passage that unrelated texts share
        rows.append(" ".join([word() for _ in range(30)] + passage + [word() for _ in range(20 + k % 7)]))
    for k in range(25):  # pairs about the threshold
        one = [word() for _ in range(60)]
        other = list(one)
        for _ in range(k % 4):
            other[rng.randrange(60)] = word()
        rows += [" ".join(one), " ".join(other).upper() + "!"]
    rows += [rows[0]] * 5 + [rows[130]] * 30
    rows += ["", None, "...", "one two", "One, two", "one two three", " ".join(word() for _ in range(4000))]
    return list(enumerate(rows))


def answers(spark, rows, **more):
    frame = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, class_id int")
    return sorted(tuple(r) for r in chosen_path.near_copies(frame, **more).collect())


def test_against_all_pairs(spark, monkeypatch):
    # Small limits, so that nodes are split to the last depth and components span blocks.
    monkeypatch.setattr(chosen_path, "LEAF", 8)
    monkeypatch.setattr(chosen_path, "NODE_BLOCK", 16)
    monkeypatch.setattr(chosen_path, "BLOCK", 16)
    rows = corpus()
    assert answers(spark, rows) == brute(rows)


def test_repeated_rows_and_empty(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (2, text), (3, None)]
    assert answers(spark, rows) == [(1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 0)]
    assert answers(spark, []) == []


def test_one_of_each_group_stays(spark):
    text = "a b c d e f g h"
    rows = [(2, text, "x"), (1, text, "y"), (1, text, "y"), (3, None, "z"), (4, None, "z"), (None, text, "n"), (1, "another text", "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _near_key string")
    kept = chosen_path.without_near_copies(frame)
    assert kept.columns == frame.columns
    assert sorted(kept.collect(), key=str) == sorted(
        [(1, text, "y"), (3, None, "z"), (4, None, "z"), (1, "another text", "y")], key=str
    )


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (5, 700, 6000, 1)]
    sets.append(sets[1])
    got = chosen_path.shared_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))


def test_near_copies_without_ids(spark):
    long = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"other{i}" for i in range(80))
    rows = [(1, long), (None, long + " more"), (None, other), (None, other + " more"), (7, "nothing like any of them at all")]
    got = chosen_path.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 1, 1), (None, 1, 1), (None, None, 1), (None, None, 1), (7, 7, 0)], key=str)


def test_runs_end_by_the_estimate(spark, monkeypatch):
    runs, links = [], chosen_path.candidate_links
    monkeypatch.setattr(chosen_path, "candidate_links", lambda r, g, first, *more: runs.append(first) or links(r, g, first, *more))
    frame = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(4)], "doc_id long, text string")
    assert all(r.n_links == 0 for r in chosen_path.near_copies(frame).collect()) and runs == [0, 2]
    runs.clear()
    counts = iter([1, 2, 2, 3, 3, 3])
    monkeypatch.setattr(chosen_path, "_connections", lambda groups: next(counts))
    chosen_path.near_copies(frame, more_runs=16)
    assert runs == [0, 2, 18, 34]


def long_corpus(seed=11):
    """Sets of 200 to 2,000 shingles: groups and pairs on both sides of the threshold, shared passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(150)]
    rows = []
    for size in (204, 350, 600, 1000, 2000):
        base = [word() for _ in range(size)]
        # A replaced word changes five shingles: 0.8 is reached with about one in 45.
        for k in range(16):
            copy = list(base)
            for _ in range(round(size / 45 * k / 12)):
                copy[rng.randrange(size)] = word()
            rows.append(" ".join(copy))
        rows += [" ".join(base[: round(size * part)]) for part in (0.79, 0.81, 0.9)]
    for k in range(30):
        rows.append(" ".join([word() for _ in range(100 + k)] + passage + [word() for _ in range(100)]))
    return list(enumerate(rows))


def test_samples_of_long_sets_against_all_pairs(spark, monkeypatch):
    """The recursion meets samples, far smaller than the sets; links are those of the whole sets."""
    monkeypatch.setattr(chosen_path, "LEAF", 8)
    monkeypatch.setattr(chosen_path, "NODE_BLOCK", 16)
    monkeypatch.setattr(chosen_path, "BLOCK", 16)
    rows = long_corpus()
    want = brute(rows)
    assert sum(links for _, _, links in want) > 200
    assert min(len(grams(t)) for _, t in rows) > 150 and max(len(grams(t)) for _, t in rows) > 1900
    assert answers(spark, rows) == want
    # Workers must see the other size as well, so the module travels by value.
    monkeypatch.setattr(chosen_path, "SKETCH", 32)
    cloudpickle.register_pickle_by_value(chosen_path)
    try:
        assert answers(spark, rows) == want
    finally:
        cloudpickle.unregister_pickle_by_value(chosen_path)
