"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search.

A tree of centres is fitted on a bounded sample: each node's vectors are split by k-means until
a node is small. Every vector is filed in the leaf that its nearest centres lead to. A query
walks the tree with a priority queue: of all branches left aside, the one whose centre is nearest
is opened next, so leaves come in the order of how promising they are. How many leaves a query
visits is calibrated: for sample queries the exact neighbours among all vectors are computed, and
the visits are widened until the leaves visited hold the target share of them. A query goes on as
long as its leaves hold fewer vectors than are asked for.

Leaves are searched by Spark tasks: a leaf's vectors are cut into blocks of bounded size, each
query goes to all blocks of its leaves, and a task returns a query's nearest of a block. A task
holds a block's vectors and takes the queries as they come. Of equal vectors only as many of the
smallest ids are searched as a query can return, for ties go to those.

Defined results: vectors that are null, zero, of another length than most, or hold a null or
non-finite component take no part, nor do those without an id; a query's own row is not a
candidate; rows that repeat an id count once, with their least vector; ties go to the smaller id; with fewer candidates than asked for all are returned; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signpost.llm.streams import runs
from signpost.llm.tables import materialize

SAMPLE = 20_000  # vectors that the tree is fitted on, at most
BRANCHES = 8
LEAF_SAMPLE = 100  # sampled vectors at which a node is not split
CALIBRATION = 200  # queries whose exact neighbours are computed
BLOCK = 4_096  # vectors of a leaf in one block


@dataclass
class Node:
    centres: np.ndarray | None = None  # of the branches
    branches: list["Node"] = field(default_factory=list)
    leaf: int = -1


def k_means(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centres and the nearest one's number for each row."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        nearest = distances(rows, centres).argmin(axis=1)
        used = np.unique(nearest)
        centres = np.stack([rows[nearest == c].mean(axis=0) for c in used])
    return centres, distances(rows, centres).argmin(axis=1)


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, for choosing; not for results."""
    return np.maximum((left**2).sum(1)[:, None] - 2 * left @ right.T + (right**2).sum(1)[None, :], 0)


def fit(rows: np.ndarray, seed: int = 1) -> tuple[Node, int]:
    """The tree and its number of leaves."""
    count = 0

    def build(part: np.ndarray, seed: int) -> Node:
        nonlocal count
        if len(part) > LEAF_SAMPLE:
            centres, nearest = k_means(part, BRANCHES, seed)
            if len(np.unique(nearest)) > 1:
                return Node(centres, [build(part[nearest == c], seed * BRANCHES + c + 1) for c in range(len(centres))])
        count += 1
        return Node(leaf=count - 1)

    return build(rows, seed), count


def file_all(tree: Node, rows: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    out = np.zeros(len(rows), np.int64)

    def walk(node: Node, at: np.ndarray) -> None:
        if not node.branches:
            out[at] = node.leaf
            return
        nearest = distances(rows[at], node.centres).argmin(axis=1)
        for c, branch in enumerate(node.branches):
            mine = at[nearest == c]
            if len(mine):
                walk(branch, mine)

    walk(tree, np.arange(len(rows)))
    return out


def leaves_by_promise(tree: Node, query: np.ndarray) -> Iterator[int]:
    """Leaves in best-bin-first order."""
    heap: list[tuple[float, int, Node]] = [(0.0, 0, tree)]
    pushed = 0
    while heap:
        _, _, node = heapq.heappop(heap)
        while node.branches:
            away = ((node.centres - query) ** 2).sum(axis=1)
            best = int(away.argmin())
            for c, branch in enumerate(node.branches):
                if c != best:
                    pushed += 1
                    heapq.heappush(heap, (float(away[c]), pushed, branch))
            node = node.branches[best]
        yield node.leaf


def usable(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles) of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), "n").limit(1).select("n")
    same = rows.join(F.broadcast(usual), F.size("vector") == F.col("n"))
    return same.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _nearest(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query's place, ids, exact distances) of each query's k nearest rows, ties to smaller ids."""
    rough = distances(queries, rows)
    # Room for the rounding of the rough distances.
    scale = 1e-9 * ((queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :]).max()
    found = []
    for q in range(len(queries)):
        away = np.where(ids == own[q], np.inf, rough[q])
        count = int(np.isfinite(away).sum())
        if not count:
            continue
        bound = np.partition(away, min(k, count) - 1)[min(k, count) - 1] + 2 * scale
        near = np.flatnonzero(away <= bound)
        exact = np.sqrt(((rows[near] - queries[q]) ** 2).sum(axis=1))
        order = np.lexsort((ids[near], exact))[:k]
        found.append((q, ids[near][order], exact[order]))
    return found


RESULT = "query_id bigint, vec_id bigint, score double"


def _result(found: list[tuple[int, np.ndarray, np.ndarray]], own: np.ndarray) -> pa.RecordBatch:
    query = np.concatenate([np.full(len(i), own[q]) for q, i, _ in found]) if found else np.empty(0, np.int64)
    ids = np.concatenate([i for _, i, _ in found]) if found else np.empty(0, np.int64)
    score = np.concatenate([s for _, _, s in found]) if found else np.empty(0)
    return pa.record_batch([pa.array(query, pa.int64()), pa.array(ids, pa.int64()), pa.array(score)], ["query_id", "vec_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, from at most k per query and block."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_neighbours(rows: DataFrame, own: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """query_id, vec_id, score, rank by comparing a bounded set of queries with all rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = np.asarray(batch.column("vec_id"))
                yield _result(_nearest(queries, own, ids, _matrix(batch.column("vector")), k), own)

    return _best(rows.select("vec_id", "vector").mapInArrow(scan, RESULT), k)


def calibrated_visits(tree: Node, own: np.ndarray, queries: np.ndarray, neighbours: list[tuple[int, int]], recall: float) -> int:
    """The least number of leaves whose visit finds that share of `neighbours` (query id, leaf)."""
    wanted: dict[int, list[int]] = {}
    for query, leaf in neighbours:
        wanted.setdefault(query, []).append(leaf)
    depths = []
    for query, vector in zip(own.tolist(), queries):
        if query in wanted:
            place = {leaf: n for n, leaf in enumerate(leaves_by_promise(tree, vector), 1)}
            depths += [place[leaf] for leaf in wanted[query]]
    return int(np.sort(depths)[math.ceil(recall * len(depths)) - 1]) if depths else 1


def nearest(
    table: DataFrame, every: int = 100, k: int = 10, recall: float = 0.97, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id `every` divides."""
    rows = materialize(usable(table, id_column, vector_column), "tree-rows")
    total = rows.count()
    # A sample by hash of the id, so that it is the same again.
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE / max(1, total))))
    sample = drawn.limit(2 * SAMPLE).toArrow()
    tree = fit(_matrix(sample.column("vector")))[0] if sample.num_rows else Node(leaf=0)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = file_all(tree, _matrix(batch.column("vector")))
                yield pa.record_batch([batch.column("vec_id"), batch.column("vector"), pa.array(leaf)], ["vec_id", "vector", "leaf"])

    index = materialize(rows.mapInArrow(file, "vec_id bigint, vector array<double>, leaf bigint"), "tree-index")
    copy = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = materialize(index.withColumn("copy", copy).where(F.col("copy") <= k + 1).drop("copy"), "tree-distinct")
    # One row per leaf, a number that the sample bounds.
    sizes = {r["leaf"]: r["n"] for r in distinct.groupBy("leaf").agg(F.count("*").alias("n")).collect()}

    queries = index.where(F.col("vec_id") % every == 0).select("vec_id", "vector")
    probes = queries.orderBy(F.xxhash64("vec_id", F.lit("calibrate"))).limit(CALIBRATION).toArrow()
    if not probes.num_rows:
        return queries.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    own, vectors = np.asarray(probes.column("vec_id")), _matrix(probes.column("vector"))
    truth = exact_neighbours(distinct, own, vectors, k).join(distinct.select("vec_id", "leaf"), "vec_id")
    known = [(r["query_id"], r["leaf"]) for r in truth.select("query_id", "leaf").collect()]
    visits = calibrated_visits(tree, own, vectors, known, recall)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, opened, blocks = [], [], []
            for n, vector in enumerate(_matrix(batch.column("vector")) if batch.num_rows else ()):
                seen = met = 0
                for leaf in leaves_by_promise(tree, vector):
                    if seen >= visits and met > k:
                        break
                    seen, met = seen + 1, met + sizes.get(leaf, 0)
                    for block in range(math.ceil(sizes.get(leaf, 0) / BLOCK)):
                        taken.append(n)
                        opened.append(leaf)
                        blocks.append(block)
            rows = batch.take(pa.array(taken, pa.int32()))
            yield pa.record_batch(
                [rows.column("vec_id"), rows.column("vector"), pa.array(opened, pa.int64()), pa.array(blocks, pa.int32())],
                ["vec_id", "vector", "leaf", "block"],
            )

    asked = queries.mapInArrow(walk, "vec_id bigint, vector array<double>, leaf bigint, block int").withColumn("asks", F.lit(True))
    blocks_of = F.create_map(*[F.lit(x) for leaf, n in sizes.items() for x in (leaf, math.ceil(n / BLOCK))])
    block = F.pmod(F.xxhash64("vec_id"), blocks_of[F.col("leaf")]).cast("int")
    filed = distinct.select("vec_id", "vector", "leaf", block.alias("block"), F.lit(False).alias("asks"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each block the vectors come first, then the queries.
        block, ids, matrix = None, [], []
        for batch in batches:
            for part in runs(iter([batch]), ["leaf", "block", "asks"]):
                now = part.column("leaf")[0].as_py(), part.column("block")[0].as_py()
                if now != block:
                    block, ids, matrix = now, [], []
                own, vectors = np.asarray(part.column("vec_id")), _matrix(part.column("vector"))
                if not part.column("asks")[0].as_py():
                    ids.append(own)
                    matrix.append(vectors)
                    continue
                if not ids:
                    continue
                ids, matrix = [np.concatenate(ids)], [np.concatenate(matrix)]
                for start in range(0, len(own), 1024):
                    some = slice(start, start + 1024)
                    yield _result(_nearest(vectors[some], own[some], ids[0], matrix[0], k), own[some])

    dealt = filed.unionByName(asked).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "asks")
    found = _best(dealt.mapInArrow(search, RESULT), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
