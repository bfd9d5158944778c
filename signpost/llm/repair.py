"""Repairing the structure of conversations by a dynamic program over edits that keeps its audit.

Rows are kept, given another role or deleted, and empty rows are inserted, at least cost, until the
roles read as an optional system row and pairs of user and assistant. The program's four states say
which role came last. Its partial audits are linked nodes that share their prefixes; a node knows its
ancestors at powers of two and a rolling hash, so two audits of equal cost are compared by a search
for their longest common prefix, and equal hashes are checked letter by letter.

Rows are sorted over all tasks by conversation and turn, so a conversation of any length is spread.
One that lies within a task is repaired there. One that touches a task's edge is cut there: each
segment yields its least audits from every state to every state, a conversation's segments are
joined from these, and its text is hashed in one stream.

Defined results: null roles and texts, and in the checksum null ids and turns, are one space; a null
conv_id is one conversation; rows of one turn stand by role, then text; equal rows are counted
before they are sorted; a conversation without rows has zeros, an empty audit and the empty text's
hash; an empty table gives no rows; other columns are not looked at. Repaired text passes in a
stream; an audit is one value and must fit a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.llm.spelling import NIBBLES, crc32_sql
from signpost.llm.streams import runs
from signpost.llm.tables import materialize

DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = ("su", "ua", "au")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_MOD, _BASE = (1 << 61) - 1, 911382323


class Audit:
    """The end of a string of edits; its prefix is shared with other audits."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, letter: str = "", before: Audit | None = None):
        self.letter = letter
        self.depth = 0 if before is None else before.depth + 1
        self.hash = 0 if before is None else (before.hash * _BASE + ord(letter)) % _MOD
        self.up: list[Audit] = [] if before is None else [before]
        level = 0
        while before is not None and level < len(self.up[level].up):
            self.up.append(self.up[level].up[level])
            level += 1

    def __str__(self) -> str:
        letters, at = [], self
        while at.depth:
            letters.append(at.letter)
            at = at.up[0]
        return "".join(reversed(letters))

    def prefix(self, depth: int) -> Audit:
        at = self
        while at.depth > depth:
            at = at.up[(at.depth - depth).bit_length() - 1]
        return at

    def before(self, other: Audit) -> bool:
        """Is this string less than `other`?"""
        if self is other:
            return False
        depth = min(self.depth, other.depth)
        a, b = self.prefix(depth), other.prefix(depth)
        if a.hash == b.hash:
            return self.depth < other.depth if _same(a, b) else str(self) < str(other)
        for level in range(len(a.up) - 1, -1, -1):
            if level < len(a.up) and a.up[level].hash != b.up[level].hash:
                a, b = a.up[level], b.up[level]
        if not _same(a.up[0], b.up[0]):
            return str(self) < str(other)
        return a.letter < b.letter


def _same(a: Audit, b: Audit) -> bool:
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


Best = list  # of (cost, Audit) or None, by state


def _offer(best: Best, state: int, cost: int, audit: Audit) -> None:
    held = best[state]
    if held is None or cost < held[0] or cost == held[0] and audit.before(held[1]):
        best[state] = cost, audit


def _inserted(best: Best) -> Best:
    """With rows inserted: at most one of each role is ever worth it."""
    for state in (START, SYSTEM, ASSISTANT):
        if best[state]:
            _offer(best, USER, best[state][0] + INSERT, Audit("I", best[state][1]))
    if best[USER]:
        _offer(best, ASSISTANT, best[USER][0] + INSERT, Audit("I", best[USER][1]))
    return best


def _step(best: Best, initial: str, must_go: bool, cut_off: bool) -> Best:
    after: Best = [None] * 4
    for state, held in enumerate(best):
        if held is None:
            continue
        cost, audit = held
        _offer(after, state, cost + DELETE, Audit("D", audit))
        if must_go:
            continue
        cost += CUT_OFF * cut_off
        if state == START and initial == "s":
            _offer(after, SYSTEM, cost, Audit("K", audit))
        wanted, following = ("a", ASSISTANT) if state == USER else ("u", USER)
        if initial == wanted:
            _offer(after, following, cost, Audit("K", audit))
        else:
            _offer(after, following, cost + REROLE, Audit("R", audit))
    return _inserted(after)


class Segment:
    """Counts and least audits of consecutive rows of one conversation, from the given states."""

    def __init__(self, starts: tuple[int, ...]):
        root = Audit()
        self.best = {s: _inserted([(0, root) if s == t else None for t in range(4)]) for s in starts}
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.opening = self.closing = None

    def add(self, turn: int | None, role: str, text: str, times: int, again: bool) -> None:
        """`times` equal rows; `again` if the same role and text came earlier."""
        if turn is not None and turn != self.high:
            self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        stripped = text.rstrip(SPACE)
        for _ in range(times):
            cut_off = False
            if not stripped:
                self.blank += 1
            elif again:
                self.duplicate += 1
            elif stripped[-1] not in ".!?":
                self.truncated += 1
                cut_off = True
            self.illegal += self.closing is not None and self.closing + role[:1] not in LEGAL
            if self.closing is None:
                self.opening = role[:1]
            self.closing = role[:1]
            must_go = not stripped or again
            for start, best in self.best.items():
                self.best[start] = _step(best, role[:1], must_go, cut_off)
            again = True


def _least(best: Best) -> tuple[int, str]:
    cost, audit = best[START] or (None, None)
    if best[ASSISTANT] and (audit is None or (best[ASSISTANT][0], 0) < (cost, 0)):
        cost, audit = best[ASSISTANT]
    elif best[ASSISTANT] and best[ASSISTANT][0] == cost and best[ASSISTANT][1].before(audit):
        cost, audit = best[ASSISTANT]
    return cost, str(audit)


class Repaired:
    """Applies audits to rows in order and hashes `role:text` lines."""

    def __init__(self) -> None:
        self.state, self.begun, self.digest = START, False, hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
        self.begun = True

    def apply(self, audit: str, rows: Iterable[tuple[str, str]]) -> None:
        rows = iter(rows)
        for edit in audit:
            following = ASSISTANT if self.state == USER else USER
            name = "assistant" if following == ASSISTANT else "user"
            if edit == "I":
                self._line(name, "")
                self.state = following
                continue
            role, text = next(rows)
            if edit == "K":
                self._line(role, text)
                self.state = _AFTER[role[:1]]
            elif edit == "R":
                self._line(name, text)
                self.state = following


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times: equal rows counted; dropped ones stay with 0 times."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(known("conv_id"), F.lit(":"), known("turn")), "UTF-8")) % 20
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(kind == 0, "").when(kind == 4, "user").otherwise(known("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    # Copies of one row become one row here, before anything is sorted.
    counted = marked.groupBy("conv_id", "turn", "role", "text", "copies").agg(F.count("*").alias("n"))
    times = (F.col("n") * F.col("copies")).alias("times")
    return counted.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text", times)


_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_PLACE = "part int, idx bigint, turn bigint, role string, text string, times bigint"
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def _within_tasks(rows: DataFrame, kind: str) -> DataFrame:
    """Results of the conversations that end within a task; the rows of others with their place."""
    names = ["conv_id", *[c.split()[0] for c in f"{_RESULT}, repaired_sha256 string, {_PLACE}".split(", ")]]

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, idx, first = TaskContext.get().partitionId(), 0, True
        out: list[tuple] = []
        held: list[tuple] = []
        id_type = None

        def flush() -> pa.RecordBatch:
            kinds = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            kinds += [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            columns = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def unfinished() -> None:
            nonlocal idx
            for conv, turn, role, text, times in held:
                out.append((conv, *[None] * 8, part, idx, turn, role, text, times))
                idx += 1

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "times")]):
                if held and held[-1][0] != row[0]:
                    if first:
                        unfinished()
                    else:
                        out.append((held[0][0], *_whole(held), *[None] * 6))
                    first = False
                    held = []
                held.append(row)
            if len(out) >= 5_000:
                yield flush()
        if held:
            unfinished()
        if out:
            yield flush()

    ordered = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role")]
    # A prefix decides the range and whole texts the order, so the driver's sample is narrow.
    spread = rows.repartitionByRange(*ordered, F.left("text", F.lit(64)))
    return spread.sortWithinPartitions(*ordered, "text").mapInArrow(
        repair, f"conv_id {kind}, {_RESULT}, repaired_sha256 string, {_PLACE}"
    )


def _whole(rows: list[tuple]) -> tuple:
    segment, repaired, seen = Segment((START,)), Repaired(), set()
    kept: list[tuple[str, str]] = []
    for _, turn, role, text, times in rows:
        if times:
            segment.add(turn, role, text, times, (role, text) in seen)
            seen.add((role, text))
            kept += [(role, text)] * times
    cost, audit = _least(segment.best[START])
    repaired.apply(audit, kept)
    counts = [getattr(segment, c) for c in _COUNTS]
    return (_gaps(segment.low, segment.high, segment.distinct), *counts, cost, audit, repaired.digest.hexdigest())


_SEGMENT = (
    "part int, low bigint, high bigint, distinct_turns bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, opening string, closing string, audits array<struct<start: int, end: int, cost: bigint, audit: string>>"
)


def _segments(rows: DataFrame, kind: str) -> DataFrame:
    """Counts and least audits of each task's part of the conversations that tasks share."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["conv_id", "part"]):
            segment = Segment((START, SYSTEM, USER, ASSISTANT))
            for row in zip(*[group.column(c).to_pylist() for c in ("turn", "role", "text", "times", "again")]):
                if row[3]:
                    segment.add(*row)
            audits = [
                {"start": s, "end": t, "cost": held[0], "audit": str(held[1])}
                for s, best in segment.best.items()
                for t, held in enumerate(best)
                if held
            ]
            numbers = [segment.low, segment.high, segment.distinct, *[getattr(segment, c) for c in _COUNTS]]
            struct = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
            yield pa.record_batch(
                [
                    group.column("conv_id").slice(0, 1).combine_chunks(),
                    group.column("part").slice(0, 1).combine_chunks(),
                    *[pa.array([v], pa.int64()) for v in numbers],
                    pa.array([segment.opening], pa.string()),
                    pa.array([segment.closing], pa.string()),
                    pa.array([audits], pa.list_(struct)),
                ],
                ["conv_id", *[c.split()[0] for c in _SEGMENT.split(", ")[:10]], "audits"],
            )

    # Role and text seen earlier, by the first place of each.
    same = ["conv_id", "role", "print"]
    marked = rows.withColumn("print", F.sha2("text", 256))
    firsts = marked.where("times > 0").groupBy(*same).agg(F.min(F.struct("part", "idx")).alias("at"))
    firsts = firsts.select(*[F.col(c).alias(f"first_{c}") for c in same], "at")
    on = [marked[c].eqNullSafe(firsts[f"first_{c}"]) for c in same]
    again = F.coalesce(F.struct("part", "idx") > F.col("at"), F.lit(False)).alias("again")
    marked = marked.join(firsts, on, "left").select("conv_id", "part", "idx", "turn", "role", "text", "times", again)
    marked = marked.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "idx")
    return marked.mapInArrow(summarise, f"conv_id {kind}, {_SEGMENT}")


def _joined(segments: DataFrame, kind: str) -> DataFrame:
    """Each shared conversation's result, and `cuts`, the audit of each of its segments."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [_composed(sorted(s, key=lambda x: x["part"])) for s in batch.column("segments").to_pylist()]
            columns = list(zip(*done)) or [()] * 8
            kinds = [*[pa.int64()] * 6, pa.string(), pa.list_(pa.struct([("part", pa.int32()), ("audit", pa.string())]))]
            yield pa.record_batch(
                [batch.column("conv_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["conv_id", *[c.split()[0] for c in _RESULT.split(", ")], "cuts"],
            )

    fields = [c.split()[0] for c in _SEGMENT.split(", ")[:10]]
    grouped = segments.groupBy("conv_id").agg(F.collect_list(F.struct(*fields, "audits")).alias("segments"))
    return grouped.mapInArrow(join, f"conv_id {kind}, {_RESULT}, cuts array<struct<part: int, audit: string>>")


def _composed(segments: list[dict]) -> tuple:
    best: dict[int, tuple[int, str]] = {START: (0, "")}
    trail: dict[int, tuple] = {START: ()}
    counts, low, high, distinct, closing = dict.fromkeys(_COUNTS, 0), None, None, 0, None
    for segment in segments:
        following: dict[int, tuple[int, str]] = {}
        ways: dict[int, tuple] = {}
        for a in segment["audits"]:
            if a["start"] in best:
                cost, audit = best[a["start"]]
                offer = cost + a["cost"], audit + a["audit"]
                if a["end"] not in following or offer < following[a["end"]]:
                    following[a["end"]] = offer
                    ways[a["end"]] = (trail[a["start"]], segment["part"], a["audit"])
        best, trail = following, ways
        for c in _COUNTS:
            counts[c] += segment[c]
        if segment["opening"] is not None:
            counts["illegal"] += closing is not None and closing + segment["opening"] not in LEGAL
            closing = segment["closing"]
        if segment["low"] is not None:
            distinct += segment["distinct_turns"] - (segment["low"] == high)
            low = segment["low"] if low is None else low
            high = segment["high"]
    end = min((s for s in (START, ASSISTANT) if s in best), key=best.__getitem__)
    cuts, way = [], trail[end]
    while way:
        cuts.append({"part": way[1], "audit": way[2]})
        way = way[0]
    return (_gaps(low, high, distinct), *counts.values(), *best[end], cuts[::-1])


def _hashed(rows: DataFrame, results: DataFrame, kind: str) -> DataFrame:
    """conv_id, repaired_sha256 of the shared conversations: a stream of rows, each segment after its audit."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, repaired = None, None
        names, ids, found = ["conv_id", "repaired_sha256"], [], []
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, audit, role, text, times in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "times")]):
                if audit is not None:
                    if repaired is None or conv != current:
                        if repaired is not None:
                            ids.append(current)
                            found.append(repaired.digest.hexdigest())
                        current, repaired = conv, Repaired()
                    left = _opened(repaired, audit)
                else:
                    for _ in range(times):
                        left = _one(repaired, left, role, text)
        if repaired is not None:
            ids.append(current)
            found.append(repaired.digest.hexdigest())
            yield pa.record_batch([pa.array(ids, id_type), pa.array(found, pa.string())], names)

    none = F.lit(None)
    audits = results.select("conv_id", F.explode("cuts").alias("c")).select(
        "conv_id", "c.part", F.lit(-1).cast("bigint").alias("idx"), "c.audit",
        none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).cast("bigint").alias("times"),
    )
    lines = rows.select("conv_id", "part", "idx", none.cast("string").alias("audit"), "role", "text", "times")
    ordered = audits.union(lines).repartition("conv_id").sortWithinPartitions("conv_id", "part", "idx")
    return ordered.mapInArrow(stream, f"conv_id {kind}, repaired_sha256 string")


def _opened(repaired: Repaired, audit: str) -> Iterator[str]:
    """The audit's edits still to come, inserts that stand before any row applied."""
    return _inserts(repaired, iter(audit))


def _inserts(repaired: Repaired, edits: Iterator[str]) -> Iterator[str]:
    for edit in edits:
        if edit != "I":
            return _chain(edit, edits)
        repaired.apply("I", ())
    return iter(())


def _chain(edit: str, edits: Iterator[str]) -> Iterator[str]:
    yield edit
    yield from edits


def _one(repaired: Repaired, edits: Iterator[str], role: str, text: str) -> Iterator[str]:
    repaired.apply(next(edits), [(role, text)])
    return _inserts(repaired, edits)


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 after the damage."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    first = materialize(_within_tasks(damaged(conversations), kind), "repair-tasks")
    columns = ["conv_id", *[c.split()[0] for c in _RESULT.split(", ")], "repaired_sha256"]
    rows = first.where("part IS NOT NULL").select("conv_id", *[c.split()[0] for c in _PLACE.split(", ")])
    shared = materialize(_joined(_segments(rows, kind), kind), "repair-shared")
    hashes = _hashed(rows, shared, kind).withColumnRenamed("conv_id", "hash_id")
    whole = shared.join(hashes, F.col("conv_id").eqNullSafe(F.col("hash_id")))
    return first.where("part IS NULL").select(*columns).union(whole.select(*columns))


def _plus(state: str, cost: str, edit: str) -> str:
    return f"lpad((left({state}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{edit}'"


def _after_sql() -> str:
    free = "NOT r.must_go AND"
    parts = {
        "n0": [_plus("x0", "3", "D")],
        "n1": [_plus("x1", "3", "D"), f"CASE WHEN {free} r.ini = 's' THEN {_plus('x0', 'r.cut_off', 'K')} END"],
        "n2": [_plus("x2", "3", "D")]
        + [f"CASE WHEN {free} r.ini = 'u' THEN {_plus(x, 'r.cut_off', 'K')} WHEN {free} true THEN {_plus(x, '2 + r.cut_off', 'R')} END" for x in ("x0", "x1", "x3")],
        "n3": [_plus("x3", "3", "D"), f"CASE WHEN {free} r.ini = 'a' THEN {_plus('x2', 'r.cut_off', 'K')} WHEN {free} true THEN {_plus('x2', '2 + r.cut_off', 'R')} END"],
    }
    return ", ".join(f"least({', '.join([*offers, 'NULL'])}) AS {name}" for name, offers in parts.items())


# States are nine digits of cost and the audit, so that the least string is the least audit of least cost.
SQL = rf"""
WITH RECURSIVE nibbles AS ({NIBBLES}),
raw AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {crc32_sql("encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS d
    FROM conversations, nibbles),
copies AS (
    SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
           CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM raw),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM copies),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS again,
           left(role, 1) AS ini, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final
    FROM ordered),
judged AS (
    SELECT *, final = '' OR again AS must_go, (final NOT IN ('', '.', '!', '?') AND NOT again)::INT AS cut_off,
           lag(ini) OVER (PARTITION BY conv_id ORDER BY rn) AS earlier
    FROM placed),
steps AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS rn, '000000000' AS x0, NULL::VARCHAR AS x1, '000000002I' AS x2, '000000004II' AS x3
    FROM conversations
    UNION ALL
    SELECT conv_id, rn, n0, n1, n2, least(n3, {_plus("n2", "2", "I")})
    FROM (SELECT conv_id, rn, n0, n1, n3,
                 least(n2, {_plus("n0", "2", "I")}, {_plus("n1", "2", "I")}, {_plus("n3", "2", "I")}) AS n2
          FROM (SELECT s.conv_id, r.rn, {_after_sql()}
                FROM steps s JOIN judged r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND r.rn = s.rn + 1))),
audits AS (
    SELECT conv_id, left(best, 9)::BIGINT AS cost, substr(best, 10) AS audit
    FROM (SELECT conv_id, arg_max(CASE WHEN rn = 0 THEN x0 ELSE least(x0, x3) END, rn) AS best FROM steps GROUP BY conv_id)),
letters AS (
    SELECT conv_id, k, substr(audit, k, 1) AS edit
    FROM (SELECT conv_id, audit, unnest(range(1, length(audit)::BIGINT + 1)) AS k FROM audits)),
edits AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS rn FROM letters),
output AS (
    SELECT e.conv_id, e.k, e.edit, CASE WHEN e.edit = 'I' THEN '' ELSE j.text END AS text, j.role, j.ini,
           row_number() OVER (PARTITION BY e.conv_id ORDER BY e.k) AS n
    FROM edits e LEFT JOIN judged j ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.rn = j.rn
    WHERE e.edit <> 'D'),
heads AS (SELECT conv_id, (edit = 'K' AND ini = 's')::BIGINT AS shift FROM output WHERE n = 1),
lines AS (
    SELECT o.conv_id, string_agg(CASE WHEN o.edit = 'K' THEN o.role WHEN (o.n - h.shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || o.text, chr(10) ORDER BY o.k) AS body
    FROM output o JOIN heads h ON o.conv_id IS NOT DISTINCT FROM h.conv_id GROUP BY o.conv_id),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (final = '') AS blank, count(*) FILTER (final <> '' AND again) AS duplicate,
           sum(cut_off)::BIGINT AS truncated,
           count(*) FILTER (earlier IS NOT NULL AND earlier || ini NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, a.cost, a.audit,
       sha256(coalesce(body, '')) AS repaired_sha256
FROM audits a LEFT JOIN counts c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN lines l ON a.conv_id IS NOT DISTINCT FROM l.conv_id
"""
