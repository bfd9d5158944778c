"""Repairs against an exhaustive search, plain dynamic programming and SQL."""

import hashlib
import itertools
import random
import re
import zlib

import oracle
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from signpost.llm import repair
from signpost.llm.queries import QUERIES, SQL

# Columns that clash with names used inside.
KIND = "conv_id long, turn long, role string, text string, part int, audit string"


def judged(rows):
    """(role, text, must go, cut off) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        again = (role, text) in seen
        seen.add((role, text))
        out.append((role, text, not stripped or again, bool(stripped) and not again and stripped[-1] not in ".!?"))
    return out


def plain(rows):
    """(cost, audit, repaired lines): the least (cost, audit) by state, with whole strings."""
    best = {"": (0, "", ())}

    def offer(held, state, cost, audit, lines):
        if state not in held or (cost, audit) < held[state][:2]:
            held[state] = cost, audit, lines

    def inserted(held):
        for _ in range(3):
            for state, (cost, audit, lines) in list(held.items()):
                name = "assistant" if state == "u" else "user"
                offer(held, name[0], cost + 2, audit + "I", (*lines, f"{name}:"))
        return held

    for role, text, must_go, cut_off in judged(rows):
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            offer(after, state, cost + 3, audit + "D", lines)
            if must_go:
                continue
            name = "assistant" if state == "u" else "user"
            if role[:1] == name[0] or (role[:1] == "s" and state == ""):
                offer(after, role[:1], cost + cut_off, audit + "K", (*lines, f"{role}:{text}"))
            offer(after, name[0], cost + 2 + cut_off, audit + "R", (*lines, f"{name}:{text}"))
        best = after
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def exhaustive(rows):
    """The least of all edits with at most two rows inserted in one place."""
    gaps = [g for n in range(3) for g in itertools.product("ua", repeat=n)]
    rows = judged(rows)
    edits = [["D"] if must_go else ["D", "K", "Ru", "Ra"] for _, _, must_go, _ in rows]
    best = None
    for chosen in itertools.product(*edits):
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            audit, roles, cost = "", "", 0
            for k in range(len(rows) + 1):
                audit += "I" * len(inserts[k])
                roles += "".join(inserts[k])
                cost += 2 * len(inserts[k])
                if k < len(rows):
                    e = chosen[k]
                    audit += e[0]
                    cost += {"D": 3, "K": 0, "R": 2}[e[0]] + (e != "D" and rows[k][3])
                    roles += {"D": "", "K": rows[k][0][:1]}.get(e, e[1:])
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        left = damaged([r for r in rows if r[0] == conv])
        turns = {r[0] for r in left} - {None}
        lines = [r[1:] for r in left]
        marks = judged(lines)
        blank = sum(not t.strip(" \t\n\x0b\x0c\r") for _, t in lines)
        initials = [r[0][:1] for r in lines]
        cost, audit, fixed = plain(lines)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            blank,
            sum(m[2] for m in marks) - blank,
            sum(m[3] for m in marks),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(fixed).encode()).hexdigest(),
        )
    return out


def got(frame):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert frame.columns == names
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


ROLES = ["user", "assistant", "system", None, "", "user2", "tool", "User"]
TEXTS = ["Yes.", "Why?", "no end", " ", "", None, "Well!\n", "é  ", "a.b", "..."]


def conversations(seed, many):
    pick = random.Random(seed)
    rows = []
    for conv in range(many):
        for k in range(pick.randrange(1, 9)):
            turn = None if pick.random() < 0.1 else k + pick.randrange(3)
            role = ("user", "assistant")[k % 2] if pick.random() < 0.6 else pick.choice(ROLES)
            rows.append((conv, turn, role, pick.choice(TEXTS) if pick.random() < 0.5 else f"Text {k}."))
    return rows


@pytest.mark.parametrize("case", range(12))
def test_least_of_all(case):
    pick = random.Random(case)
    rows = [(pick.choice(["user", "assistant", "system", "tool"]), pick.choice(["A.", "B.", "c", " "])) for _ in range(3)]
    assert plain(rows)[:2] == exhaustive(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "x", ""]), st.sampled_from(["A.", "B.", "c", ""])), max_size=30))
def test_program(rows):
    seen, segment = set(), repair.Segment((repair.START,))
    for role, text in rows:
        segment.add(None, role, text, 1, (role, text) in seen)
        seen.add((role, text))
    cost, audit = repair._least(segment.best[repair.START])
    assert (cost, audit) == plain(rows)[:2]
    done = repair.Repaired()
    done.apply(audit, rows)
    assert done.digest.hexdigest() == hashlib.sha256("\n".join(plain(rows)[2]).encode()).hexdigest()


@pytest.mark.parametrize("mod", [(1 << 61) - 1, 7, 1])
def test_order_of_audits(monkeypatch, mod):
    """Also where hashes collide."""
    monkeypatch.setattr(repair, "_MOD", mod)
    pick = random.Random(mod)
    nodes = [repair.Audit()]
    for _ in range(300):
        nodes.append(repair.Audit(pick.choice("DIK"), pick.choice(nodes[-20:])))
    for _ in range(2000):
        a, b = pick.choice(nodes), pick.choice(nodes)
        assert a.before(b) == (str(a) < str(b))


def test_brute(spark):
    rows = conversations(1, 150) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hi."), (None, None, None, None)]
    rows += [r for r in conversations(2, 20)] * 2
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND).repartition(4)
    assert got(repair.repaired(frame)) == brute(rows)


def test_long_conversation(spark):
    """One that all tasks share, with rows repeated across them, among short ones."""
    pick = random.Random(3)
    rows = [r for r in conversations(4, 30)]
    for k in range(1500):
        role = pick.choice(ROLES) if pick.random() < 0.1 else ("user", "assistant")[k % 2]
        rows.append((12, k // 2 if k % 7 else None, role, pick.choice(TEXTS) if pick.random() < 0.1 else f"Text {k % 1200}."))
    rows += [(31, 5, "user", "Same.")] * 400
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND).repartition(4)
    assert got(repair.repaired(frame)) == brute(rows)


def test_dropped_and_empty(spark):
    dropped = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = [(c, 0, "user", "Hello.") for c in dropped[:5]]
    found = got(repair.repaired(spark.createDataFrame([(*r, 1, "x") for r in rows], KIND)))
    assert found == brute(rows) and all(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for v in found.values())
    assert repair.repaired(spark.createDataFrame([], KIND)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    assert oracle.compare(QUERIES["op13_repair"](spark, sf), oracle.connect(sf), SQL["op13_repair"]) > 0
