"""Nearest neighbours against brute force: edge rows, ties, copies, and recall on all embeddings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbmart.llm import nndescent, queries

NAN, INF = float("nan"), float("inf")


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, wanted, k=5):
    """{query: [(id, cosine)]} with ties to the smaller id."""
    vectors = {i: np.asarray(v, float) / np.abs(v).max() for i, v in rows if i is not None and usable(v)}
    out = {}
    for q, x in vectors.items():
        if wanted(q):
            near = [(-round(float(x @ y / np.sqrt(x @ x) / np.sqrt(y @ y)), 12), i) for i, y in vectors.items() if i != q and len(y) == len(x)]
            out[q] = [(i, -c) for c, i in sorted(near)[:k]]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def assert_same(got, want):
    assert got.keys() == {q for q, near in want.items() if near}
    for q, near in got.items():
        assert [i for i, _ in near] == [i for i, _ in want[q]], q
        assert [c for _, c in near] == pytest.approx([c for _, c in want[q]], abs=1e-12)


def edge_rows():
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(80)]
    rows += [(i, rows[0][1]) for i in range(200, 230)]  # copies: ties
    rows += [(300, None), (301, []), (302, [0.0] * 6), (303, [None] + [1.0] * 5), (304, [NAN] + [1.0] * 5), (305, [INF] + [1.0] * 5), (None, [1.0] * 6)]
    rows += [(400, [1.0, 2.0]), (405, [2.0, 1.0]), (410, [1e200, -1e200]), (420, [1.0])]
    return [*rows, rows[5], rows[82]]


@pytest.mark.parametrize("cluster", [400, 20])
def test_edge_rows_as_brute_force(spark, monkeypatch, cluster):
    monkeypatch.setattr(nndescent, "CLUSTER", cluster)
    rows = edge_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, SCORE int")
    out = nndescent.nearest(df, F.col("id") % 5 == 0, recall=1.0)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert_same(found(out), brute(rows, lambda q: q % 5 == 0))


def test_fewer_candidates_than_neighbours(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert_same(found(nndescent.nearest(df, F.col("id") % 50 == 0)), brute(rows, lambda q: q % 50 == 0))
    assert nndescent.nearest(df.where("vec_id = 0"), F.lit(True)).count() == 0
    assert nndescent.nearest(df.limit(0), F.lit(True)).count() == 0


def test_recall_of_the_query_on_all_embeddings(spark):
    sf = "/root/testdata/sf0.01"
    got = found(queries.op8_nearest_neighbours(spark, sf))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, lambda q: q % 50 == 0)
    assert got.keys() == want.keys()
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_a_tight_group_of_distinct_near_copies(spark):
    """One-byte codes cannot rank these; a third of the rows are within a cosine of 0.99999."""
    rng = np.random.default_rng(4)
    centre = rng.normal(size=32)
    centre /= np.sqrt(centre @ centre)
    rows = [(i, (centre + rng.normal(size=32) * 0.0022 / np.sqrt(32) if i % 3 == 0 else rng.normal(size=32)).tolist()) for i in range(2400)]
    got = found(nndescent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0))
    want = brute(rows, lambda q: q % 20 == 0)
    for tight in (True, False):
        some = [q for q in want if (q % 3 == 0) == tight]
        assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in some) >= 0.9 * 5 * len(some)


def test_multiples_of_one_vector_are_ties(spark):
    """Their cosines differ in the last bits only; the smaller ids come first."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=16)
    rows = [(i, (base * (1 + i) if i % 5 < 3 else rng.normal(size=16)).tolist()) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert_same(found(nndescent.nearest(df, F.col("id") % 20 == 0, recall=1.0)), brute(rows, lambda q: q % 20 == 0))
    single = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(nndescent.nearest(single, F.col("id") % 20 == 0))
    want = brute([(r.vec_id, r.embedding) for r in single.collect()], lambda q: q % 20 == 0)
    near = [c >= want[q][-1][1] - 1e-11 for q in want for _, c in got[q]]
    assert len(near) == 5 * len(want) and sum(near) >= 0.95 * len(near)


def test_an_audit_that_fails_at_the_full_width_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "audited", lambda *_: (0.5, 1.0))
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall 0.500"):
        nndescent.nearest(df, F.lit(True))


def test_tables_written_do_not_grow_with_the_search(spark, monkeypatch):
    """Directions spread evenly need wide beams, in every shard; rounds and beams stay within tasks all the same."""
    for name, value in (("LEAST", 500), ("SPREAD", 1), ("SLICE", 10)):
        monkeypatch.setattr(nndescent, name, value, raising=False)
    written = {}

    def stored(df, label, store=nndescent.stored):
        out = store(df, label)
        written.setdefault(label, []).append(out)
        return out

    monkeypatch.setattr(nndescent, "stored", stored)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 64))
    x[1000:1060] = x[1000] + rng.normal(size=(60, 64)) * 0.01  # linked with nothing else
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(nndescent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0))
    want = brute(rows, lambda q: q % 20 == 0)
    assert got.keys() == want.keys()
    for some in (want.keys(), range(1000, 1060, 20)):
        assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in some) >= 0.9 * 5 * len(some)
    assert sum(map(len, written.values())) <= 16, {k: len(v) for k, v in written.items()}
    assert written["graph"][0].select("size", "cluster", "block").distinct().count() >= 4
    assert written["shards"][0].count() == written["graph"][0].count() == 3000


def test_a_search_can_begin_in_every_part_of_a_graph():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 32))
    for a in range(0, 300, 60):
        x[a : a + 60] = x[a] + rng.normal(size=(60, 32)) * 0.01
    x /= np.sqrt((x * x).sum(1))[:, None]
    vertex, other, starts = nndescent.graph_of(x)
    reached, before = np.isin(np.arange(len(x)), starts), 0
    while reached.sum() > before:
        before = reached.sum()
        reached[other[reached[vertex]]] = True
    assert reached.all()
    near = np.argsort(-(x @ x.T), axis=1)[:, 1:6]
    links = set(zip(vertex.tolist(), other.tolist(), strict=True))
    assert sum((v, o) in links for v in range(len(x)) for o in near[v].tolist()) >= 0.95 * near.size


def test_what_single_precision_cannot_rank_is_not_searched_wider(spark, monkeypatch):
    used = []

    def search(*args, run=nndescent.search):
        used.append(args[-2:])
        return run(*args)

    monkeypatch.setattr(nndescent, "search", search)
    rng = np.random.default_rng(10)
    x = rng.normal(size=(2100, 64))
    x[::3] = x[0] + rng.normal(size=(700, 64)) * 0.0003
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(nndescent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0))
    want = brute(rows, lambda q: q % 20 == 0)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)
    assert used[-1][1] == "float64" and max(width for width, _ in used) == nndescent.BEAM, used
