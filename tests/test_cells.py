import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from signpost.operators import cells as C
from signpost.operators import nearest as N
from signpost.plans import index as I
from signpost.plans import views as V

VEC = "embedding array<float>"


def clustered(n, clusters, dim, seed, noise=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dim))
    rows = middle[np.arange(n) % clusters] + noise * rng.normal(size=(n, dim))
    return (rows / np.linalg.norm(rows, axis=1)[:, None]).astype(np.float32)


def rows_of(vectors, letter):
    return [(f"{letter}{i:05d}", [float(x) for x in v]) for i, v in enumerate(vectors)]


def plain(queries, refs, k, own=False):
    """Every reference of every query, as one matrix product in double precision."""
    codes = np.array([c for c, _ in refs])
    matrix = np.array([v for _, v in refs], np.float32)
    unit, usable = N._unit_rows(matrix)
    out = {}
    for mid, v in queries:
        if v is None or not np.any(v):
            out[mid] = None
            continue
        if len(v) == matrix.shape[1]:
            q = N._unit_rows(np.array([v], np.float32))[0][0]
            cos = np.round(unit.astype(np.float64) @ q.astype(np.float64), 9)
        else:
            cos = np.zeros(len(refs))
        keep = usable & ((codes != mid) if own else True)
        order = np.lexsort((codes[keep], -cos[keep]))[:k]
        out[mid] = list(zip(codes[keep][order], cos[keep][order]))
    return out


def agree(got, want):
    assert set(got) == set(want)
    for mid, pairs in want.items():
        if pairs is None:
            assert got[mid] is None
            continue
        assert [g[0] for g in got[mid]] == [p[0] for p in pairs], mid
        assert np.allclose([g[1] for g in got[mid]], [p[1] for p in pairs], atol=2e-9)


def attached(spark, queries, refs, k, monkeypatch, **options):
    """Candidates by cells; fails if the plain grid was taken."""
    monkeypatch.setattr(N, "_grid_lists", lambda *a, **o: pytest.fail("plain grid"))
    q = spark.createDataFrame(queries, f"mid string, {VEC}")
    r = spark.createDataFrame(refs, f"code string, {VEC}")
    rows = N.attach_candidates(q, r, k, ref_bytes=2_000, mark_undirected=True, **options).collect()
    return {x.mid: None if x.candidates is None else [(c.code, c.cosine) for c in x.candidates] for x in rows}


@pytest.mark.parametrize("held", [N._GROUP_BYTES, 4_000])
@pytest.mark.parametrize("noise", [0.05, 5.0])
@pytest.mark.parametrize("k", [3, 60])
def test_cells_find_what_all_pairs_find(spark, monkeypatch, held, noise, k):
    """Clustered and scattered vectors, ties, zero and null vectors, ones of another length."""
    monkeypatch.setattr(N, "_GROUP_BYTES", held)
    refs = rows_of(clustered(500, 12, 8, 1, noise), "r")
    refs += [(f"t{i}", [2 * x for x in refs[7][1]]) for i in range(9)] + [("z", [0.0] * 8)]
    queries = rows_of(clustered(900, 17, 8, 2, noise), "q")
    queries += [("same", refs[7][1]), ("zero", [0.0] * 8), ("null", None), ("short", [1.0, 2.0])]
    agree(attached(spark, queries, refs, k, monkeypatch), plain(queries, refs, k))


@pytest.mark.parametrize("held", [N._GROUP_BYTES, 4_000])
def test_cells_leave_out_the_vector_itself(spark, monkeypatch, held):
    """One cell holds most rows and is cut; another holds copies only."""
    monkeypatch.setattr(N, "_GROUP_BYTES", held)
    vectors = np.concatenate([clustered(900, 1, 8, 3), clustered(300, 9, 8, 4), np.repeat(clustered(1, 1, 8, 5), 60, 0)])
    rows = rows_of(vectors, "r")
    got = attached(spark, rows, rows, 5, monkeypatch, exclude_self=True)
    agree(got, plain(rows, rows, 5, own=True))


@pytest.mark.parametrize("noise", [0.05, 5.0])
def test_queries_meet_groups_in_turn_without_copies(spark, monkeypatch, noise):
    """Where queries would be copied to many groups, each group goes to them: the same lists."""
    monkeypatch.setattr(N, "_GROUP_BYTES", 4_000)
    monkeypatch.setattr(N, "_MOST_COPIES", 0)
    monkeypatch.setattr(N, "_LEAST_COPIED", 0)
    made = []
    monkeypatch.setattr(N.HeldGroup, "__init__", lambda self, table, f=N.HeldGroup.__init__: made.append(f(self, table)))
    refs = rows_of(clustered(500, 12, 8, 1, noise), "r") + [("z", [0.0] * 8)]
    queries = rows_of(clustered(900, 17, 8, 2, noise), "q")
    queries += [("zero", [0.0] * 8), ("null", None), ("short", [1.0, 2.0])]
    agree(attached(spark, queries, refs, 3, monkeypatch), plain(queries, refs, 3))
    rows = rows_of(clustered(1_100, 30, 8, 3, noise), "r")
    edges = N.neighbor_graph(spark.createDataFrame(rows, f"code string, {VEC}"), 4, ref_bytes=2_000).collect()
    got = {}
    for e in sorted(edges, key=lambda e: (-e.score, e.neighbor_id)):
        got.setdefault(e.job_id, []).append((e.neighbor_id, e.score))
    agree(got, plain(rows, rows, 4, own=True))
    assert len(made) > 10


def test_few_scores_are_made_of_clustered_vectors(spark, monkeypatch):
    """Of clusters that lie apart, a vector is compared with a small part of all."""
    monkeypatch.setattr(N, "_GROUP_BYTES", 20_000)
    made = spark.sparkContext.accumulator(0)
    matmul, blocks = N.RefMatrix._top_part, N.RefMatrix.top_of_blocks

    def counted(self, part, k, own, wanted, floor, of):
        sizes = np.bincount(of, minlength=int(wanted[1].max(initial=0)) + 1)
        made.add(int(sizes[wanted[1]].sum()))
        return blocks(self, part, k, own, wanted, floor, of)

    def counted_plain(self, part, k, own, wide):
        made.add(len(part) * len(self.codes))
        return matmul(self, part, k, own, wide)

    lists = N._candidate_lists

    def candidate_lists(*args, **options):
        N.RefMatrix.top_of_blocks, N.RefMatrix._top_part = counted, counted_plain
        try:
            return lists(*args, **options)
        finally:
            N.RefMatrix.top_of_blocks, N.RefMatrix._top_part = blocks, matmul

    monkeypatch.setattr(N, "_candidate_lists", candidate_lists)
    n = 3_000
    rows = spark.createDataFrame(rows_of(clustered(n, 40, 16, 6), "r"), f"code string, {VEC}")
    assert N.neighbor_graph(rows, 4, ref_bytes=2_000).count() == 4 * n
    assert 0 < made.value < n * n / 8


def test_a_code_listed_twice_takes_the_grid(spark, monkeypatch):
    monkeypatch.setattr(N, "_cell_lists", lambda *a, **o: pytest.fail("cells"))
    rows = rows_of(clustered(600, 5, 8, 7), "r")
    r = spark.createDataFrame(rows + rows[:1], f"code string, {VEC}")
    assert N.neighbor_graph(r, 2, ref_bytes=2_000).count() == 2 * 601


def test_groups_are_bounded_and_hold_every_block():
    vectors = clustered(4_000, 30, 16, 8)
    centers = C.fit_centers(vectors[::2], C.cell_count(len(vectors)))
    cell, near = C.nearest_center(vectors, centers)
    counts = np.bincount(cell, minlength=len(centers))
    least = np.ones(len(centers))
    np.minimum.at(least, cell, near)
    cells = C.Cells(centers, counts, least, 100)
    assert set(cells.cell) == set(np.flatnonzero(counts)) and (np.diff(cells.group) >= 0).all()
    loads = np.bincount(cells.group, weights=cells.members)
    assert loads.max() <= 100 and loads.min() > 0
    where = cells.block_of(cell, np.arange(len(cell)))
    assert (cells.cell[where] == cell).all()
    assert cells.lists(np.array([1]), np.ones((1, len(cells.cell)), bool), 3).is_null().to_pylist() == [True, False, True]
    assert isinstance(cells.lists(np.empty(0, np.int64), np.zeros((0, len(cells.cell)), bool), 2), pa.ListArray)


def test_graph_works_out_stored_vectors_once(spark):
    """Their scan is looked up for missing codes, measured and compared, but made once."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def code(number):
        read.add(1)
        return f"c{number:03d}"

    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(clustered(60, 4, 8, 9))], f"ordinal long, {VEC}")
    vectors = rows.select(code.asNondeterministic()("ordinal").alias("code"), "embedding", "ordinal")
    taxonomy = V.taxonomy(spark, "/root/testdata/sf0.001").limit(1).withColumn("code", F.lit("c007"))
    edges = I.build_graph(taxonomy, vectors, 3)
    assert edges.count() == 180
    assert read.value == 60
