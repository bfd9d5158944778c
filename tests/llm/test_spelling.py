"""Spelling variants against a plain count and all pairs."""

import re
import zlib
from collections import Counter

import oracle
import pytest
from signpost.llm import spelling
from signpost.llm.queries import QUERIES, SQL

# Columns that clash with names used inside.
KIND = "doc_id long, text string, word string, n int, cell string"


def counted(rows, damage):
    held = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            mark = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if mark % damage == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            if len(run) >= 6:
                held[run] += 1
    return {w: n for w, n in held.items() if n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def brute(rows, damage):
    words = counted(rows, damage)
    out = {}
    for w, n in words.items():
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 5 * n else None
        out[w] = [form, w, n, len(near), words[form] if form else None]
    for w in out:
        while out[out[w][1]][0]:
            out[w][1] = out[out[w][1]][0]
    return {w: tuple(v) for w, v in out.items()}


def got(frame):
    rows = frame.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


ROWS = [
    (1, "Garden " * 700 + "gardem " * 40 + "gardm " * 9 + "gardens " * 130 + "gardenss " * 6),
    (2, None),
    (3, ""),
    (None, "garden GARDÉN gardén gardéns " * 6 + "éàèùôî " * 5 + "éàèùôï " * 5),
    (5, "short word " * 30 + "abcdefg abcdegf abcdef " * 7 + "bacdefg " * 8),
    (5, "short word " * 30 + "abcdefg abcdegf abcdef " * 7 + "bacdefg " * 8),
    (7, "x" * 3000 + " " + ("x" * 2999 + " ") * 5 + ("x" * 3000 + ",") * 5 + "y" + "x" * 2999),
    (8, "ſtrange İstanbul ÀÖØ×÷öøÿ " * 6),
    (9, "tangle tingle tongle " * 9 + "tungle " * 45 + "tengle " * 45 + "dangled tangled " * 5),
]


@pytest.mark.parametrize("groups, block, damage", [(6, 4096, 199), (2, 2, 3), (1, 1, 7)])
def test_brute(spark, groups, block, damage, monkeypatch):
    frame = spark.createDataFrame([(*r, "w", 1, "c") for r in ROWS], KIND).repartition(3)
    want = brute(ROWS, damage)
    assert any(v[0] and v[1] != v[0] for v in want.values()) or damage != 199
    words = spelling.word_counts(frame, damage=damage)
    assert {r.word: r.n for r in words.collect()} == counted(ROWS, damage)
    monkeypatch.setattr(spelling, "word_counts", lambda docs: words)
    assert got(spelling.variants(frame, groups=groups, block=block)) == want


def test_pairs_come_once_in_each_direction(spark):
    words = sorted({a + b + c for a in ("tes", "tse", "tess") for b in ("ting", "tinh", "tin") for c in ("", "s", "e")})
    frame = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    want = sorted((a, b, j) for a in words for j, b in enumerate(words) if one_edit(a, b))
    for block in (4, 1000):
        assert sorted(map(tuple, spelling.near_pairs(frame, block=block).collect())) == want


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], KIND)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    assert oracle.compare(QUERIES["op11_spelling"](spark, sf), oracle.connect(sf), SQL["op11_spelling"]) > 0
