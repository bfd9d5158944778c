"""Spelling variants by blocked Gram matrices of letter counts.

One inserted, deleted or replaced letter moves a word's vector of letter counts by a squared
distance of 1 or 2. Words are dealt to cells: the length, cut further by how many letters of each
of `groups` fixed letter groups a word has. One edit leads to the same cell or to a neighbouring
one (one letter more in a group; or one more in a group and one less in another), so every pair
meets in exactly one cell, the larger of the two. There a NumPy product of the count matrices gives
all squared distances, pairs at most two apart stay, and their letters are compared.

Cells are cut into a grid of bounded blocks by the counted number of their words, so no task holds
a whole cell; the words themselves are aggregated before they are dealt.

Defined results: a null text has no runs; a null doc_id counts as an empty one in the checksum that
picks the runs to damage; repeated rows count each; equal largest counts are decided by code-point
order; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signpost.llm.streams import runs
from signpost.llm.tables import materialize
from signpost.operators.sizing import broadcast_if_bounded

SHORTEST = 6
SEEN = 5
RATIO = 5
DAMAGE = 199
GROUPS = 6
BLOCK = 4096
# Words that a task counts before it hands its counts on.
HELD = 200_000
# Numbers of a product held at once.
PRODUCT = 1 << 22
# Fixed value: English letters by falling frequency, dealt to the groups in turn.
FREQUENT = "etaoinshrdlcumwfgypbvkjxqz"
_RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")


def word_counts(docs: DataFrame, seen: int = SEEN, damage: int = DAMAGE) -> DataFrame:
    """word, n: the runs of letters of all texts, some damaged, with at least `seen` occurrences.

    Runs stand between other characters; only A to Z are lower-cased. Where `damage` divides the
    crc32 of `<doc_id>:<run>`, the letter at that number modulo the length is left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                # Bytes lower-case A to Z alone.
                found = _RUN.findall((text.as_py() or "").encode().lower().decode())
                start = zlib.crc32(f"{doc or ''}:".encode())
                for word, n in Counter(found).items():
                    mark = zlib.crc32(word.encode(), start)
                    if mark % damage == 0:
                        at = mark % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < SHORTEST:
                            continue
                    held[word] += n
                if len(held) >= HELD:
                    yield _counted(held)
                    held = Counter()
        yield _counted(held)

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= seen)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def _letter_groups(groups: int) -> bytes:
    """The group of each Latin-1 code: frequent letters dealt in turn, others by their code."""
    return bytes(FREQUENT.index(chr(c)) % groups if chr(c) in FREQUENT else c % groups for c in range(256))


def dealt(words: DataFrame, groups: int = GROUPS) -> DataFrame:
    """cell, role, word, n: each word at home (0), as its cell's visitor (1) and as one of larger neighbours (2)."""
    table = _letter_groups(groups)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, roles, rows = [], [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                marks = word.encode("latin-1").translate(table)
                have = [marks.count(g) for g in range(groups)]
                names = list(map(str, have))
                own = "-".join(names)
                cells += [own, own]
                roles += [0, 1]
                more = []
                for g in range(groups):
                    kept = names[g]
                    names[g] = str(have[g] + 1)
                    more.append("-".join(names))
                    # The first group that differs has one more: the larger cell.
                    for h in range(g + 1, groups):
                        if have[h]:
                            names[h] = str(have[h] - 1)
                            more.append("-".join(names))
                            names[h] = str(have[h])
                    names[g] = kept
                cells += more
                roles += [2] * len(more)
                rows += [row] * (2 + len(more))
            taken = pa.array(rows, pa.int32())
            yield pa.record_batch(
                [
                    pa.array(cells, pa.string()),
                    pa.array(roles, pa.int32()),
                    batch.column("word").take(taken),
                    batch.column("n").take(taken),
                ],
                ["cell", "role", "word", "n"],
            )

    return words.select("word", "n").mapInArrow(deal, "cell string, role int, word string, n bigint")


def near_pairs(words: DataFrame, groups: int = GROUPS, block: int = BLOCK) -> DataFrame:
    """word, near, near_n: all pairs of words that one edit separates, each in both directions."""
    rows = materialize(dealt(words, groups), "spell-cells")
    home = F.col("role") == 0
    sizes = rows.groupBy("cell").agg(F.count_if(home).alias("homes"), F.count_if(~home).alias("guests"))
    cut = [F.ceil(F.col(c) / block).cast("int").alias(f"{c}_cut") for c in ("homes", "guests")]
    large = sizes.where((F.col("homes") > 0) & (F.greatest("homes", "guests") > block)).select("cell", *cut)
    large = broadcast_if_bounded(materialize(large, "spell-large"))
    one = F.lit(1)
    rows = rows.join(large, "cell", "left").withColumns(
        {c: F.greatest(one, F.coalesce(c, one)) for c in ("homes_cut", "guests_cut")}
    )
    # A home block meets all guest blocks of its cell.
    own = F.pmod(F.xxhash64("word"), F.when(home, F.col("homes_cut")).otherwise(F.col("guests_cut"))).cast("int")
    others = F.sequence(F.lit(0), F.when(home, F.col("guests_cut")).otherwise(F.col("homes_cut")) - 1)
    rows = rows.select("cell", "role", "word", "n", home.alias("home"), own.alias("own"), F.explode(others).alias("other"))
    placed = rows.select(
        "cell",
        F.when(F.col("home"), F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("home"), F.col("other")).otherwise(F.col("own")).alias("j"),
        "role",
        "word",
        "n",
    )
    placed = placed.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "role")
    return placed.mapInArrow(_compare, "word string, near string, near_n bigint")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in runs(batches, ["cell", "i", "j"]):
        roles = np.asarray(group.column("role"))
        homes, first = int((roles == 0).sum()), int((roles <= 1).sum())
        if not homes or homes == len(roles):
            continue
        words = group.column("word").to_pylist()
        counts = np.asarray(group.column("n"))
        left, right = [], []
        length = len(words[0])
        shape = np.fromiter(map(len, words), np.int64, len(words))
        for at in (np.arange(homes, first), first + np.flatnonzero(shape[first:] == length), np.flatnonzero(shape < length)):
            if not len(at):
                continue
            for a, b in _edits(words[:homes], [words[k] for k in at]):
                b = at[b]
                if at[0] < first:
                    # Both at home here: once each.
                    once = np.array([words[x] < words[y] for x, y in zip(a, b)], bool)
                    a, b = a[once], b[once]
                left.append(a)
                right.append(b)
        if left:
            a, b = np.concatenate([*left, *right]), np.concatenate([*right, *left])
            column = group.column("word").combine_chunks()
            yield pa.record_batch([column.take(pa.array(a)), column.take(pa.array(b)), pa.array(counts[b])], ["word", "near", "near_n"])


def _edits(homes: list[str], guests: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs one edit apart; all homes have one length, all guests that or one less."""
    a, b = _letters(homes), _letters(guests)
    x, y = _letter_counts(a), _letter_counts(b)
    used = x.any(0) | y.any(0)
    # Whole numbers below 2^24 are exact in single precision.
    kind = np.float32 if a.shape[1] <= 2000 else np.float64
    x, y = x[:, used].astype(kind), y[:, used].astype(kind)
    norm_x, norm_y = (x * x).sum(1), (y * y).sum(1)
    step = max(1, PRODUCT // len(y))
    for start in range(0, len(x), step):
        gram = x[start : start + step] @ y.T
        squared = norm_x[start : start + step, None] + norm_y - 2 * gram
        i, j = np.nonzero(squared <= 2)
        i += start
        most = max(1, PRODUCT // a.shape[1])
        for at in range(0, len(i), most):
            p, q = i[at : at + most], j[at : at + most]
            near = _one_edit(a[p], b[q])
            yield p[near], q[near]


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _letter_counts(letters: np.ndarray) -> np.ndarray:
    counts = np.zeros((len(letters), 256), np.int32)
    rows = np.arange(len(letters))
    for column in letters.T:
        counts[rows, column] += 1
    return counts


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    head = np.cumprod(a[:, :-1] == b, axis=1).sum(1)
    tail = np.cumprod((a[:, 1:] == b)[:, ::-1], axis=1).sum(1)
    return head + tail >= b.shape[1]


def variants(docs: DataFrame, ratio: int = RATIO, groups: int = GROUPS, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of `word_counts`.

    The form is the near word with the largest n (ties: first in code-point order) if that is at
    least `ratio` times the word's; the root is where the forms lead.
    """
    words = materialize(word_counts(docs), "spell-words")
    best = (
        near_pairs(words, groups, block)
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.n")).alias("near_n"))
    )
    leads = F.col("near_n") >= ratio * F.col("n")
    joined = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(leads, F.col("near")).alias("form"),
        F.when(leads, F.col("near_n")).alias("form_n"),
    )
    joined = materialize(joined, "spell-forms")
    found = roots(joined.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return joined.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the links (word, root) end, by doubling.

    A form is more frequent than its word by a factor, so chains are short and without circles.
    """
    links = materialize(links, "spell-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(ahead.select("root"), "root", "left_semi").isEmpty():
            return links
        links = materialize(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spell-roots")


_CRC = """list_reduce(
    list_transform(range(2 * octet_length({b})::BIGINT), lambda i:
        (strpos('0123456789ABCDEF', substr(hex({b}), (i + 1 - 2 * (i % 2) + 1)::BIGINT, 1)) - 1)::BIGINT),
    lambda c, d: xor(c >> 4, nibble[(xor(c & 15, d) + 1)::BIGINT]), 4294967295::BIGINT)"""
# The checksum by half bytes, low half first; `nibble` holds the 16 remainders.
NIBBLES = """SELECT list(v ORDER BY i) AS nibble FROM (
    SELECT i, list_reduce(range(4), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
    FROM range(16) r(i))"""


def crc32_sql(blob: str) -> str:
    return f"xor({_CRC.format(b=blob)}, 4294967295)"


SQL = f"""
WITH RECURSIVE nibbles AS ({NIBBLES}),
found AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{6,}}')) AS run FROM documents)),
marked AS (
    SELECT run, c, {crc32_sql("encode(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h
    FROM (SELECT doc_id, run, count(*) AS c FROM found GROUP BY ALL), nibbles),
words AS (
    SELECT word, sum(c)::BIGINT AS n
    FROM (SELECT c, CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT)
                    ELSE run END AS word FROM marked)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word)::BIGINT + 1)) AS i FROM words),
masked AS (SELECT word, n, left(word, i - 1) || '*' || substr(word, i + 1) AS m FROM places),
cut AS (SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS short FROM places),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM masked a JOIN masked b ON a.m = b.m AND a.word <> b.word
    UNION ALL SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.short = w.word
    UNION ALL SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.short = w.word),
best AS (
    SELECT word, count(*)::BIGINT AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
    FROM pairs GROUP BY word),
forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
           CASE WHEN b.near_n >= 5 * w.n THEN b.near END AS form,
           CASE WHEN b.near_n >= 5 * w.n THEN b.near_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word),
led AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT l.word, f.word, f.form FROM led l JOIN forms f ON l.next = f.word)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n
FROM forms f JOIN led l ON f.word = l.word AND l.next IS NULL
"""
