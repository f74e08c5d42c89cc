"""Near-duplicate vectors against brute force: edge rows, overlapping shards, large groups of near copies."""

import numpy as np
import pandas as pd
import pytest

from plumbmart.llm import queries, vecgraph, vectors

NAN, INF = float("nan"), float("inf")


def edge_rows():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4, 8))
    rows = [(i, (base[i % 4] + rng.normal(size=8) * 0.1).tolist(), i % 2) for i in range(60)]
    rows += [(100, base[0].tolist(), 0), (101, base[0].tolist(), 0), (102, (base[0] * 7).tolist(), 0), (103, base[0].tolist(), 1), (104, base[0].tolist(), None)]
    rows += [(110, None, 0), (111, [], 0), (112, [0.0] * 8, 0), (113, [1.0, None] + [0.0] * 6, 0), (114, [NAN] + [1.0] * 7, 0), (115, [INF] + [1.0] * 7, 0), (116, [1.0, 2.0], 0), (117, [2.0, 4.0], 0)]
    return rows


def brute(rows):
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {i: set() for i, _, _ in rows}
    for i, v, a in rows:
        for j, w, b in rows:
            if i < j and a == b and a is not None and usable(v) and usable(w) and len(v) == len(w):
                x, y = np.array(v), np.array(w)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((i, len(links[i]), min(seen), min(seen) == i))
    return sorted(out)


@pytest.mark.parametrize("cluster, block", [(1000, 800), (12, 800), (30, 7)])
def test_edge_rows_as_brute_force(spark, monkeypatch, cluster, block):
    monkeypatch.setattr(vecgraph, "CLUSTER", cluster)
    monkeypatch.setattr(vecgraph, "BLOCK", block)
    monkeypatch.setattr(vecgraph, "RECALL", 1.0)
    rows = edge_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, KEPT int")
    got = vecgraph.near_duplicates(df, recall=1.0)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(vecgraph, "BLOCK", 60)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * (0.15 if i < 300 else 1)).tolist(), 0) for i in range(400)]
    got = vecgraph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).toPandas().sort_values("vec_id")
    x = np.array([np.float32(v) for _, v, _ in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.93).sum(1) - 1
    assert got["n_links"].sum() >= 0.98 * links.sum() and (got["n_links"].to_numpy() <= links).all()


def test_query_as_its_sql(spark, oracle, same):
    same(queries.op4_embedding_dedup(spark, "/root/testdata/sf0.001").toPandas(), oracle("op4_embedding_dedup"))


def test_repeated_rows_null_ids_and_nothing(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, [1.0, 0.01], 1), (None, None, 1), (3, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((tuple(r) for r in vecgraph.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 2, 5, True)] * 2 + [(None, 2, 5, False), (None, 0, None, False), (3, 0, 3, True)], key=str)
    assert vecgraph.near_duplicates(df.limit(0)).count() == 0


def test_pruning_keeps_the_nearest_and_edges_both_ways():
    x = np.random.default_rng(5).normal(size=(80, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = vecgraph.pruned(x)
    cosine = x @ x.T - 2 * np.eye(80)
    for i, row in enumerate(near):
        assert cosine[i].argmax() in row and i not in row
        assert all(i in near[j] for j in row)


def test_frames_of_pandas(spark, oracle):
    rows = [r for r in edge_rows() if r[1] and len(r[1]) == 8 and all(x is not None for x in r[1])]
    frame = pd.DataFrame(rows, columns=["vec_id", "embedding", "label"]).astype({"label": "Int64"})
    want = sorted(oracle("op4_embedding_dedup", embeddings=frame)[["vec_id", "n_links", "component_id", "kept"]].itertuples(index=False, name=None))
    assert want == brute(rows)


def test_a_pair_at_the_threshold_shares_a_shard():
    rng = np.random.default_rng(6)
    x, u, c = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.normal(size=(3, 1000, 64)))
    u -= (u * x).sum(1, keepdims=True) * x
    y = x * 0.93 + u / np.linalg.norm(u, axis=1, keepdims=True) * np.sqrt(1 - 0.93**2)
    for deviations, share in ((vecgraph.DEVIATIONS, 0.99), (8, 1)):
        a, b = (vectors.within_reach(v, c, 0.93, deviations, 2) for v in (x, y))
        assert np.mean([bool(set(i) & set(j)) for i, j in zip(a, b, strict=True)]) >= share
    nearest = [set(np.argsort(-(c @ v[k]))[:2]) for k in range(1000) for v in (x, y)]
    assert np.mean([bool(i & j) for i, j in zip(nearest[::2], nearest[1::2], strict=True)]) < 0.9


def test_the_audit_sees_rare_lost_links(spark):
    rng = np.random.default_rng(7)
    rows = [(bytes([i // 250, i % 250]), rng.normal(size=16).tolist(), 0, 1) for i in range(600)]
    pairs = [(bytes([9, i]), (np.asarray(rows[i][1]) * 2 + 0.01).tolist(), 0, 1) for i in range(20)]
    classes = spark.createDataFrame([*rows, *pairs], "key binary, vector array<double>, label int, weight long")
    some = spark.createDataFrame([(bytes([9, i]), 1, b"") for i in range(4)], "key binary, links long, root binary")
    assert vecgraph.audited(classes, some, 0.93) < 0.7
    assert vecgraph.audited(classes.where("substr(key, 1, 1) <> X'09'"), some, 0.93) is None
