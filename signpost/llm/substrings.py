"""Removing passages that an earlier document holds, by suffix automata of reference shards.

A window is `length` consecutive words. A document loses every word under a window that also
stands in a document with a smaller doc_id.

Of each window one gram of a few words, the one with the least hash, is its anchor, so equal
windows have equal anchors and meet under it. Anchors of one document only need no look. For the
others the stretch of windows around an anchor, its context, is the reference; equal contexts are
one. Contexts are dealt by anchor into shards of bounded size. Each shard becomes a suffix automaton
whose states know the first document of their words, and the shard's contexts stream past it: the
matching statistic at a word, cut at `length`, names the first document that holds the window which
ends there. Runs of such windows are the maximal spans, and every document with that context takes
those of them that began in an earlier one.

The shards are dealt to tasks, not sent to all: together they grow with the corpus. The contexts of
an anchor that has more than MOST of them are compared window by window instead, by their digests,
so no automaton and no task holds a hot anchor whole. Copies of one text are read once.

Defined results: a null text has no words; a null doc_id comes after all others, and rows with equal
ids are not earlier than each other, though each gets its own text's result; texts shorter than a
window keep all words; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.llm.tables import materialize
from signpost.session import scratch_dir

LENGTH = 50
GRAM = 12
# Contexts of one anchor that go into an automaton; those of others are compared by windows.
MOST = 256
# Words of contexts in one automaton, after which a new shard begins.
SHARD = 1 << 14
LAST = (1 << 63) - 1
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Automaton:
    """The suffix automaton of several word lists; states know the first document that holds them."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        self.first = [LAST]

    def add(self, words: list[str], first: int) -> None:
        steps, link, size, seen = self.next, self.link, self.size, self.first
        last = 0
        for word in words:
            known = steps[last].get(word)
            if known is not None:
                last = known if size[known] == size[last] + 1 else self._split(last, word, known)
            else:
                new = len(steps)
                steps.append({})
                size.append(size[last] + 1)
                link.append(0)
                seen.append(LAST)
                at = last
                while at >= 0 and word not in steps[at]:
                    steps[at][word] = new
                    at = link[at]
                if at >= 0:
                    known = steps[at][word]
                    link[new] = known if size[known] == size[at] + 1 else self._split(at, word, known)
                last = new
            if first < seen[last]:
                seen[last] = first

    def _split(self, at: int, word: str, known: int) -> int:
        """A state for the shorter words of `known` that `at` leads to."""
        steps, link = self.next, self.link
        new = len(steps)
        steps.append(dict(steps[known]))
        self.size.append(self.size[at] + 1)
        link.append(link[known])
        self.first.append(LAST)
        link[known] = new
        while at >= 0 and steps[at].get(word) == known:
            steps[at][word] = new
            at = link[at]
        return new

    def settle(self) -> None:
        """Carry first documents from longer words to their suffixes; call once after the last `add`."""
        link, seen = self.link, self.first
        for state in sorted(range(1, len(link)), key=self.size.__getitem__, reverse=True):
            shorter = link[state]
            if seen[state] < seen[shorter]:
                seen[shorter] = seen[state]

    def statistics(self, words: list[str], most: int) -> Iterator[tuple[int, int]]:
        """For each word: how many words up to it match, `most` at most, and the first document of that match."""
        steps, link, size, seen = self.next, self.link, self.size, self.first
        state, matched = 0, 0
        for word in words:
            while state and word not in steps[state]:
                state = link[state]
                matched = size[state]
            following = steps[state].get(word)
            if following is not None:
                state, matched = following, matched + 1
                if matched >= most:
                    while size[link[state]] >= most:
                        state = link[state]
                    matched = most
            yield matched, seen[state]


class _Ids(dict):
    """Words to 64-bit numbers, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


_IDS = _Ids()


def _numbers(text: str) -> np.ndarray:
    # Bytes split at 0x20 and 0x09 to 0x0D alone.
    words = text.encode().split()
    return np.fromiter(map(_IDS.__getitem__, words), np.uint64, len(words))


def anchors(numbers: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, first window, last window) of each anchor; a window's is its leftmost least gram."""
    count = len(numbers) - length + 1
    if count <= 0:
        return (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    grams = len(numbers) - gram + 1
    hashes = np.zeros(grams, np.uint64)
    for k in range(gram):
        hashes = hashes * _STEP + numbers[k : k + grams]
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(29)
    views = np.lib.stride_tricks.sliding_window_view(hashes, length - gram + 1)
    spots = np.arange(count)
    # Blocks bound the memory of long texts.
    for at in range(0, count, 1 << 16):
        spots[at : at + (1 << 16)] += views[at : at + (1 << 16)].argmin(axis=1)
    starts = np.flatnonzero(np.concatenate([[True], spots[1:] != spots[:-1]]))
    ends = np.append(starts[1:], count) - 1
    return hashes[spots[starts]], starts, ends


def _key(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _texts(docs: DataFrame) -> DataFrame:
    """key, first, text: each distinct text once with the smallest id, in buckets by key.

    The texts are shuffled here; later joins by key read the buckets and move only narrow rows.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("first"), text.alias("text"))
    rows = rows.select(_key(F.col("text")).alias("key"), "first", "text")
    rows = rows.groupBy("key").agg(F.min("first").alias("first"), F.first("text").alias("text"))
    name = f"repeat_texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, "key").option("path", scratch_dir(spark, "repeat-texts")).saveAsTable(name)
    return spark.table(name)


def _anchored(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """key, first, gram, context, span, places: the anchors of all texts, those with equal contexts in one row.

    A context's windows begin at each of `places` and at the `span` words after it.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, grams, marks, spans, places = [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                numbers = _numbers(text.as_py())
                hashes, lo, hi = anchors(numbers, length, gram)
                held = memoryview(numbers.tobytes())
                seen: dict[tuple[int, int], list[int]] = {}
                for g, a, b in zip(hashes.view(np.int64).tolist(), lo.tolist(), hi.tolist()):
                    mark = xxhash.xxh3_64_intdigest(held[8 * a : 8 * (b + length)])
                    if (g, mark) in seen:
                        seen[g, mark].append(a)
                        continue
                    seen[g, mark] = [a]
                    rows.append(row)
                    grams.append(g)
                    marks.append(mark)
                    spans.append(b - a)
                places += seen.values()
            yield pa.record_batch(
                [
                    batch.column("key").take(pa.array(rows, pa.int32())),
                    batch.column("first").take(pa.array(rows, pa.int32())),
                    pa.array(grams, pa.int64()),
                    pa.array(np.array(marks, np.uint64).view(np.int64)),
                    pa.array(spans, pa.int32()),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                ["key", "first", "gram", "context", "span", "places"],
            )

    return texts.select("key", "first", "text").mapInArrow(
        find, "key binary, first bigint, gram bigint, context bigint, span int, places array<int>"
    )


def _contexts(texts: DataFrame, owners: DataFrame, length: int) -> DataFrame:
    """gram, context, first, last and the context's words, or for hot anchors each window's place and digest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column("text"), batch.column("wanted")):
                text = text.as_py()
                words, held = text.encode().split(), None
                for w in wanted.as_py():
                    lo, span = w["place"], w["span"]
                    head = w["gram"], w["context"], w["first"], w["last"]
                    if not w["hot"]:
                        rows.append((*head, b" ".join(words[lo : lo + span + length]).decode(), None, None))
                        continue
                    held = memoryview(_numbers(text).tobytes()) if held is None else held
                    for at in range(lo, lo + span + 1):
                        mark = xxhash.xxh3_128_digest(held[8 * at : 8 * (at + length)])
                        rows.append((*head, None, at - lo, mark))
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    def _batch(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = ["gram", "context", "first", "last", "words", "place", "mark"]
    fields = F.struct("gram", "context", "first", "last", "place", "span", "hot")
    wanted = owners.groupBy("key").agg(F.collect_list(fields).alias("wanted"))
    return texts.join(wanted, "key").select("text", "wanted").mapInArrow(
        cut, "gram bigint, context bigint, first bigint, last bigint, words string, place int, mark binary"
    )


_RUNS = "gram bigint, context bigint, runs array<struct<a: int, b: int, first: bigint>>"


def _by_automata(contexts: DataFrame, length: int, shard: int) -> DataFrame:
    """gram, context, runs: of windows a to b, counted within the context, with their first document."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, list[str]]] = []
        words = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("gram", "context", "first", "words")]
            for gram, context, first, text in zip(*columns):
                if words >= shard and gram != held[-1][0]:
                    yield _searched(held, length)
                    held, words = [], 0
                held.append((gram, context, first, text.split(" ")))
                words += len(held[-1][3])
        if held:
            yield _searched(held, length)

    dealt = contexts.select("gram", "context", "first", "words").repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(search, _RUNS)


def _searched(held: list, length: int) -> pa.RecordBatch:
    automaton = Automaton()
    for _, _, first, words in held:
        automaton.add(words, first)
    automaton.settle()
    found = []
    for _, _, _, words in held:
        spans: list[dict] = []
        for end, (matched, first) in enumerate(automaton.statistics(words, length)):
            if matched < length:
                continue
            at = end - length + 1
            if spans and spans[-1]["b"] == at - 1 and spans[-1]["first"] == first:
                spans[-1]["b"] = at
            else:
                spans.append({"a": at, "b": at, "first": first})
        found.append(spans)
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("first", pa.int64())]))
    columns = [pa.array([h[k] for h in held], pa.int64()) for k in (0, 1)]
    return pa.record_batch([*columns, pa.array(found, kind)], ["gram", "context", "runs"])


def _by_windows(contexts: DataFrame) -> DataFrame:
    """The same for contexts of hot anchors, from the digests of those windows that several documents have."""
    firsts = contexts.groupBy("mark").agg(F.min("first").alias("least"), F.max("last").alias("largest"))
    joined = contexts.join(materialize(firsts.where("least < largest"), "repeat-windows"), "mark")
    run = F.struct(F.col("place").alias("a"), F.col("place").alias("b"), F.col("least").alias("first"))
    return joined.groupBy("gram", "context").agg(F.collect_list(run).alias("runs"))


def _kept(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """key, first, n_words, n_removed, kept: the words that no span covers, joined by a space."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, gone, kept = [], [], []
            for text, found in zip(batch.column("text"), batch.column("spans").to_pylist()):
                words = text.as_py().encode().split()
                covered = np.zeros(len(words) + 1, np.int64)
                for span in found or ():
                    for at in span["places"]:
                        covered[at + span["from"]] += 1
                        covered[at + span["to"]] -= 1
                left = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
                totals.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(words if len(left) == len(words) else [words[k] for k in left]).decode())
            yield pa.record_batch(
                [
                    batch.column("key"),
                    batch.column("first"),
                    pa.array(totals, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["key", "first", "n_words", "n_removed", "kept"],
            )

    rows = texts.join(spans, "key", "left").select("key", "first", "text", "spans")
    return rows.mapInArrow(keep, "key binary, first bigint, n_words bigint, n_removed bigint, kept string")


def _deduplicated(docs: DataFrame, length: int, gram: int, most: int, shard: int) -> DataFrame:
    texts = _texts(docs)
    gram = min(gram, length)
    found = materialize(_anchored(texts, length, gram), "repeat-anchors")
    ends = found.groupBy("gram").agg(F.min("first").alias("least"), F.max("first").alias("largest"))
    # A table of its own, so that hot anchors can be split where it is joined.
    ends = materialize(ends.where("least < largest").select("gram"), "repeat-grams")
    shared = materialize(found.join(ends, "gram", "left_semi"), "repeat-shared")
    # One owner per distinct context: its first document.
    owner = F.min(F.struct("first", "key", F.col("places")[0].alias("place"), "span")).alias("o")
    owners = shared.groupBy("gram", "context").agg(owner, F.max("first").alias("last"))
    owners = materialize(owners.select("gram", "context", "o.*", "last"), "repeat-owners")
    hot = owners.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > most)
    owners = owners.join(hot.select("gram", F.lit(True).alias("hot")), "gram", "left")
    owners = owners.withColumn("hot", F.coalesce("hot", F.lit(False)))
    contexts = materialize(_contexts(texts, owners, length), "repeat-contexts")
    runs = _by_automata(contexts.where("words IS NOT NULL"), length, shard).union(
        _by_windows(contexts.where("mark IS NOT NULL"))
    )
    begun = F.filter("runs", lambda r: r["first"] < F.col("first"))
    spans = (
        shared.join(runs, ["gram", "context"])
        .select("key", "places", F.explode(begun).alias("r"))
        .select("key", "places", F.col("r.a").alias("from"), (F.col("r.b") + length).alias("to"))
        .groupBy("key")
        .agg(F.collect_list(F.struct("places", "from", "to")).alias("spans"))
    )
    return _kept(texts, spans)


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST, shard: int = SHARD
) -> DataFrame:
    """doc_id, n_words, n_removed, text: all documents without the words that earlier ones hold."""
    return _joined(docs, _deduplicated(docs, length, gram, most, shard), F.col("kept"), F.lit(""), "text", length)


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST, shard: int = SHARD) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: the same with the kept text's digest."""
    kept = _deduplicated(docs, length, gram, most, shard).withColumn("kept", F.sha2("kept", 256))
    return _joined(docs, kept, F.col("kept"), F.lit(hashlib.sha256().hexdigest()), "kept_sha256", length)


def _joined(docs: DataFrame, results: DataFrame, kept: Column, none: Column, name: str, length: int) -> DataFrame:
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))
    rows = docs.select("doc_id", order.alias("order"), _key(F.coalesce("text", F.lit(""))).alias("key"))
    # A later copy of a whole text has all its windows in the first one.
    copy = (F.col("order") > F.col("first")) & (F.col("n_words") >= length)
    return rows.join(results, "key").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, none).otherwise(kept).alias(name),
    )


SQL = r"""
WITH listed AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
windows AS (
    SELECT doc_id, spot, array_to_string(words[spot:spot + 49], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words)::BIGINT - 48, 1))) AS spot FROM listed)),
firsts AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(spot, spot + 50)) AS place
    FROM windows JOIN firsts USING (w) WHERE least < doc_id),
gone AS (SELECT doc_id, list(place) AS places FROM covered GROUP BY doc_id)
SELECT l.doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN words
              ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM listed l LEFT JOIN gone g ON l.doc_id = g.doc_id
"""
