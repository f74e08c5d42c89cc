"""The Jaccard join against brute force in SQL, and with small blocks, copies and odd rows."""

import random

import pandas as pd
import pytest

from plumbmart.llm import minhash, queries


def near_copies(n, words, change, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, change)):
            copy[rng.randrange(words)] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


ODD = [None, "", " \n", "one", "ONE", "one two three four", "one two three  four", "a b c d e", "a b c d e f", "A b c d e", "same " * 40, "same " * 300, "é ß " * 5]


@pytest.fixture(scope="module")
def rows():
    texts = [*ODD, *ODD[3:6], *near_copies(60, 90, 5), *near_copies(40, 60, 9, 2), *near_copies(4, 3000, 90, 3)]
    random.Random(4).shuffle(texts)
    return list(enumerate(texts))


def test_band_plan_meets_the_recall():
    for recall, hashes in ((0.9, 64), (0.9999, 128), (minhash.RECALL, minhash.HASHES)):
        bands, rows = minhash.band_plan(0.8, recall, hashes)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= hashes
    with pytest.raises(ValueError):
        minhash.band_plan(0.8, 0.999999, 2)


@pytest.mark.parametrize("block", [1000, 7])
def test_edge_rows_as_sql(spark, oracle, same, rows, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", block)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class_id int")
    docs = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"text": "string"})
    same(minhash.similar(df).toPandas(), oracle("op7_jaccard_join", documents=docs))


def test_query_as_its_sql(spark, oracle, same):
    same(queries.op7_jaccard_join(spark, "/root/testdata/sf0.001").toPandas(), oracle("op7_jaccard_join"))


def test_counts_of_common_runs_by_matrix_and_by_pair():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    left, right = np.arange(10), np.arange(5, 30)
    want = [[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left]
    assert minhash.common_counts(sets, left, right).tolist() == want


def test_one_of_each_keeps_the_smallest_id_once(spark, rows):
    df = spark.createDataFrame([*rows, rows[0], rows[5], (None, "a b c d e"), (None, "quite alone here"), (None, "quite alone here")], "doc_id long, text string")
    kept = minhash.one_of_each(df).collect()
    classes = {r.doc_id: r.class_id for r in minhash.similar(df).collect() if r.doc_id is not None}
    wordless = [i for i, t in rows if not (t or "").strip()]
    ids = [r.doc_id for r in kept if (r.text or "").strip()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i in set(classes.values()) if i not in wordless)
    assert [r.text for r in kept if r.doc_id is None] == ["quite alone here"]
    assert sum(not (r.text or "").strip() for r in kept) == len(wordless) + sum(r[0] in wordless for r in (rows[0], rows[5]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.similar(df).count() == 0 and minhash.one_of_each(df).count() == 0
