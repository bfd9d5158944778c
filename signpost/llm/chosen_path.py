"""Chosen-path similarity join of texts by the Jaccard likeness of their word n-grams.

A text is the set of its n-grams of lower-case words (of all its words, if it has fewer than n).
Texts with equal sets are one class of copies and take part once. In each run a set follows the
token that a run's hash likes best; sets that share the token meet in a node. A node that is too
large is split again by the tokens that the node's own hash likes best, down to small nodes whose
members are compared with each other. What still is too large at the last depth is compared in
blocks, and so is a node that hardly got smaller than its parent, as near copies' nodes don't.
Runs are independent, and more are made until hardly anything that they should connect is missed.

The recursion works on samples of the sets (the `SKETCH` tokens of least hash, whole sets if they
are smaller), so it carries less than a kilobyte per text, and it only connects: its links,
which allow for the samples' error, are joined to components. Within a component the whole sets
are then compared exactly, block by block, so all links counted are exact, every pair is counted
once, and no pair is ever a row: tasks return numbers of links per text and the edges of a
spanning forest.

Defined results: texts without words (null, empty) are alone with no links; copies link to each
other; a class is named by its smallest doc_id; repeated rows are copies; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.llm.components import connected_components
from signpost.llm.streams import binary_arrays, runs
from signpost.llm.tables import materialize, unique_name

WORDS = re.compile(r"\w+")
SKETCH = 96
LEAF = 96  # members of a node that are compared with each other
NODE_BLOCK = 512  # members of a larger node in one block, if it is not split
BLOCK = 192  # members of a component, with their whole sets, in one block
DEPTH = 5
CHILDREN = 2
DENSE = 0.6  # a node is not split if it has more than this share of its parent's members
_HELD_WORDS = 500_000


class _WordHashes(dict):
    """Hashes of words, kept while there are not too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _HELD_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def gram_set(text: str | None, n: int, hashes: dict[str, int]) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams."""
    words = WORDS.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    count = len(words) - width + 1
    with np.errstate(over="ignore"):
        total = np.full(count, width, np.uint64)
        for i in range(width):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[i : i + count])
    return np.unique(total)


def _run_seeds(first: int, count: int) -> np.ndarray:
    return _mixed(np.arange(first + 1, first + count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _roots(sketch: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each run the node that a set starts in."""
    likes = _mixed(sketch[None, :] ^ seeds[:, None])
    token = sketch[likes.argmin(axis=1)]
    return _mixed(token + seeds).view(np.int64)


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, digest (of the whole set), size (of the set), sketch."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            digests, sizes, samples = [], [], []
            for text in batch.column("text"):
                grams = gram_set(text.as_py(), n, hashes)
                digests.append(hashlib.md5(grams.tobytes()).digest())
                sizes.append(len(grams))
                samples.append(grams[:SKETCH].tobytes())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(digests), pa.array(sizes, pa.int32()), pa.array(samples)],
                ["doc_id", "digest", "size", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(make, f"doc_id {kind}, digest binary, size int, sketch binary")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """For each two of the sets the number of members that they share."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, place, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = seen[place] > 1
    owner, place = owner[keep], place[keep]
    # Columns of members seen once are left out; the others come in slices of bounded width.
    place = (np.cumsum(seen > 1) - 1)[place]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    counts = np.zeros((m, m), np.float64)
    width = 4096
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [start, start + width])
        x = np.zeros((m, width), np.float32)
        x[owner[a:b], place[a:b] - start] = 1
        counts += x @ x.T
    return counts


def _forest(linked: np.ndarray, digests: list[bytes]) -> list[tuple[int, int]]:
    """Edges from the least digest of what the boolean matrix `linked` connects to each other one."""
    parent = list(range(len(linked)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        a, b = find(i), find(j)
        if a != b:
            if digests[b] < digests[a]:
                a, b = b, a
            parent[b] = a
    return [(find(i), i) for i in range(len(linked)) if find(i) != i]


def _probably_linked(sets: list[np.ndarray], sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Which samples may come from sets of that likeness: four standard deviations of room."""
    shared = shared_counts(sets)
    most = np.maximum(sizes[:, None], sizes[None, :]).astype(np.float64)
    both = (sizes[:, None] + sizes[None, :]).astype(np.float64)
    portion = np.minimum(1.0, threshold / (1 + threshold) * both / most)
    sample = np.minimum(most, SKETCH)
    room = np.where(most > SKETCH, 4 * np.sqrt(sample * portion * (1 - portion)) + 1, 0)
    fits = np.minimum(sizes[:, None], sizes[None, :]) >= threshold * most - 1e-9
    return (shared >= sample * portion - room - 1e-6) & fits


def _node_links(threshold: float):
    """Edges of the small nodes, or of the pairs of blocks of the large ones."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node in runs(batches, ["path", "i", "j"]):
            digests = node.column("digest").to_pylist()
            if len(digests) < 2:
                continue
            sets = binary_arrays(node.column("sketch"), np.uint64)
            linked = _probably_linked(sets, np.asarray(node.column("size")), threshold)
            i, j = node.column("i")[0].as_py(), node.column("j")[0].as_py()
            if i != j:
                own = np.asarray(node.column("block"))
                linked &= own[:, None] != own[None, :]
            edges = _forest(linked, digests)
            if edges:
                yield pa.record_batch(
                    [pa.array([digests[x] for x, _ in edges]), pa.array([digests[y] for _, y in edges])], ["a", "b"]
                )

    return link


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each child that a set follows from a node."""
    for batch in batches:
        paths, rows = [], []
        parents = np.asarray(batch.column("path")).view(np.uint64)
        for k, sketch in enumerate(binary_arrays(batch.column("sketch"), np.uint64)):
            tokens = sketch[np.argsort(_mixed(sketch ^ parents[k]), kind="stable")[:CHILDREN]]
            paths.append(_mixed(tokens + parents[k]).view(np.int64))
            rows += [k] * len(tokens)
        kept = batch.select(["digest", "component", "members", "size", "sketch"]).take(pa.array(rows, pa.int32()))
        yield pa.record_batch(
            [pa.array(np.concatenate(paths) if paths else [], pa.int64()), *kept.columns],
            ["path", "digest", "component", "parent", "size", "sketch"],
        )


def _blocks(rows: DataFrame, count: str, most: Column) -> DataFrame:
    """`rows` once for each pair of blocks (i <= j) of their group that they belong to.

    `count` names the column with the size of a row's group; a group of at most `most` has one block.
    """
    parts = F.ceil(F.col(count) / most).cast("int")
    block = F.pmod(F.xxhash64("digest"), parts).cast("int")
    return (
        rows.withColumn("parts", parts)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("parts", "other")
    )


def _found(nodes: DataFrame, threshold: float) -> DataFrame:
    columns = ["path", "i", "j", "block", "digest", "size", "sketch"]
    dealt = nodes.select(*columns).repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")
    return dealt.mapInArrow(_node_links(threshold), "a binary, b binary")


NODES = "path bigint, digest binary, component binary, parent bigint, size int, sketch binary"


def candidate_links(reps: DataFrame, groups: DataFrame | None, first_run: int, count: int, threshold: float) -> DataFrame:
    """Edges (a, b) between the digests of `reps` that `count` runs of the recursion find.

    Only connections count, so a node whose members `groups` (node, component) has joined already
    is left alone.
    """
    seeds = _run_seeds(first_run, count)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_roots(sketch, seeds) for sketch in binary_arrays(batch.column("sketch"), np.uint64)]
            rows = pa.array(np.repeat(np.arange(len(found)), count), pa.int32())
            yield pa.record_batch(
                [pa.array(np.concatenate(found) if found else [], pa.int64()), batch.column("digest").take(rows)], ["path", "digest"]
            )

    starts = reps.select("digest", "sketch").mapInArrow(start, "path bigint, digest binary")
    if groups is None:
        starts = starts.withColumn("component", F.col("digest"))
    else:
        known = groups.select(F.col("node").alias("digest"), "component")
        starts = starts.join(known, "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    starts = materialize(starts, "path-starts")
    alone = starts.groupBy("path").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    members = starts.join(alone.select("path"), "path")
    nodes = materialize(
        members.join(reps, "digest").select("path", "digest", "component", F.lit(None).cast("long").alias("parent"), "size", "sketch"),
        "path-nodes",
    )
    edges = []
    for depth in range(DEPTH + 1):
        sizes = materialize(
            nodes.groupBy("path")
            .agg(F.count("*").alias("members"), F.min("component").alias("x"), F.max("component").alias("y"), F.max("parent").alias("of"))
            .where("x < y")
            .select("path", "members", (F.col("members") > DENSE * F.col("of")).alias("dense")),
            "path-sizes",
        )
        # A node that did not get much smaller than its parent would not do so further down.
        split = (F.col("members") > LEAF) & ~F.coalesce("dense", F.lit(False)) & F.lit(depth < DEPTH)
        sized = nodes.join(sizes, "path")
        small = F.when(F.col("members") <= LEAF, F.lit(LEAF)).otherwise(F.lit(NODE_BLOCK))
        edges.append(materialize(_found(_blocks(sized.where(~split), "members", small), threshold).distinct(), "path-edges"))
        if sizes.where(split).isEmpty():
            break
        nodes = materialize(
            sized.where(split).select("path", "digest", "component", "members", "size", "sketch").mapInArrow(_split, NODES),
            "path-nodes",
        )
    out = edges[0]
    for more in edges[1:]:
        out = out.union(more)
    return out


def _exact(threshold: float):
    """Numbers of linked documents and spanning edges of pairs of blocks, from whole sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["component", "i", "j"]):
            digests = group.column("digest").to_pylist()
            sets = binary_arrays(group.column("grams"), np.uint64)
            sizes = np.array([len(s) for s in sets], np.float64)
            shared = shared_counts(sets)
            linked = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
            np.fill_diagonal(linked, False)
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            if i != j:
                own = np.asarray(group.column("block"))
                linked &= own[:, None] != own[None, :]
            copies = np.asarray(group.column("copies"))
            counts = linked @ copies
            near: list = [None] * len(digests)
            for a, b in _forest(linked, digests):
                near[b] = digests[a]
            yield pa.record_batch(
                [pa.array(digests), pa.array(counts, pa.int64()), pa.array(near, pa.binary())],
                ["digest", "links", "near"],
            )

    return compare


def _whole_sets(docs: DataFrame, live: DataFrame, n: int) -> DataFrame:
    """`live` (digest, first_id, ...) with the whole set of each digest."""
    names = live.columns

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            grams = [gram_set(t.as_py(), n, hashes).tobytes() for t in batch.column("text")]
            # Rows that repeat an id may have other texts.
            same = [hashlib.md5(g).digest() == d.as_py() for g, d in zip(grams, batch.column("digest"))]
            out = pa.record_batch([*(batch.column(c) for c in names), pa.array(grams)], [*names, "grams"])
            yield out.filter(pa.array(same))

    small = live.count() <= 500_000
    texts = docs.select(F.col("doc_id").alias("first_id"), "text")
    joined = texts.join(F.broadcast(live) if small else live, "first_id")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in live.schema.fields)
    found = joined.select(*names, "text").mapInArrow(make, f"{kinds}, grams binary")
    # Classes of rows without an id have no other name than their digest.
    nameless = live.where("first_id is null")
    if nameless.isEmpty():
        return found

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            grams = [gram_set(t.as_py(), n, hashes).tobytes() for t in batch.column("text")]
            digests = [hashlib.md5(g).digest() for g in grams]
            yield pa.record_batch([pa.array(digests, pa.binary()), pa.array(grams, pa.binary())], ["digest", "grams"])

    named = docs.where("doc_id is null").select("text").mapInArrow(name, "digest binary, grams binary")
    return found.union(named.join(nameless, "digest").select(*names, "grams"))


def near_copies(
    docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999, first_runs: int = 2, more_runs: int = 6,
) -> DataFrame:
    """doc_id, class_id, n_links of every document.

    `n_links` counts the other documents of at least that likeness, copies included; classes are
    what links connect. After `first_runs`, runs are added `more_runs` at a time. What share of the
    connections the added ones had to make tells how likely a run is to miss one; runs end when
    all of them are likely to have found the share `recall`, or when the added ones leave none at all.
    """
    docs = docs.select("doc_id", "text")
    sets = materialize(sketches(docs, n), "path-sets")
    classes = materialize(
        sets.groupBy("digest").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.max("size").alias("size")
        ),
        "path-classes",
    )
    firsts = classes.where("size > 0").select("digest", "first_id")
    reps = materialize(
        sets.join(firsts, "digest")
        .where(F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("digest", "size", "sketch")
        .dropDuplicates(["digest"]),
        "path-reps",
    )
    made = first_runs
    edges = candidate_links(reps, None, 0, made, threshold)
    groups = materialize(connected_components(edges), "path-groups")
    while True:
        before = _connections(groups)
        fresh = candidate_links(reps, groups, made, more_runs, threshold)
        joined = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(fresh)
        groups = materialize(connected_components(joined), "path-groups")
        after = _connections(groups)
        missed = 1 - before / after if after else 0.0
        earlier, made = made, made + more_runs
        if missed ** (made / earlier) <= 1 - recall:
            break
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    live = materialize(
        groups.select(F.col("node").alias("digest"), "component")
        .join(sizes, "component")
        .join(classes.select("digest", "first_id", "copies"), "digest"),
        "path-live",
    )
    whole = _whole_sets(docs, live, n).dropDuplicates(["digest"])
    dealt = _blocks(whole, "members", F.lit(BLOCK)).select("component", "i", "j", "block", "digest", "copies", "grams")
    compared = materialize(
        dealt.repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j")
        .mapInArrow(_exact(threshold), "digest binary, links bigint, near binary"),
        "path-exact",
    )
    links = compared.groupBy("digest").agg(F.sum("links").alias("links"))
    exact = compared.where("near is not null").select(F.col("near").alias("a"), F.col("digest").alias("b"))
    named = connected_components(exact)
    heads = (
        classes.join(named.select(F.col("node").alias("digest"), "component"), "digest", "left")
        .join(links, "digest", "left")
        .select("digest", "copies", "size", "first_id", F.coalesce("component", "digest").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    heads = materialize(heads, "path-heads")
    firsts = heads.groupBy("component").agg(F.min("first_id").alias("class_first"))
    answers = heads.join(firsts, "component").select(
        "digest", "class_first", (F.col("links") + F.col("copies") - 1).cast("long").alias("all_links")
    )
    alone = F.col("size") == 0
    return (
        sets.select("doc_id", "digest", "size")
        .join(answers, "digest")
        .select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("class_first")).alias("class_id"),
            F.when(alone, F.lit(0)).otherwise(F.col("all_links")).cast("long").alias("n_links"),
        )
    )


def _connections(groups: DataFrame) -> int:
    """Edges of a spanning forest."""
    return groups.where("node <> component").count()


def without_near_copies(docs: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """`docs` with one row of each class: the one of the smallest doc_id (null last), then of the least text digest."""
    key, drop = unique_name(docs, "near_key"), unique_name(docs, "near_drop")
    ident = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.md5(F.encode("text", "UTF-8")).alias("t"))
    found = materialize(near_copies(docs.select(ident.alias("doc_id"), "text"), n, threshold), "near-classes")
    kept = docs.withColumn(key, ident)
    if not found.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").isEmpty():
        kept = kept.dropDuplicates([key])
    other = found.where("doc_id <> class_id").select(F.col("doc_id").alias(drop)).distinct()
    small = other.count() <= 200_000
    kept = kept.join(F.broadcast(other) if small else other, F.col(key) == F.col(drop), "left_anti")
    return kept.select(*docs.columns)
