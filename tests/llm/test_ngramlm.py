"""Language-model scores against a plain model, Elias-Fano codes against their input, and held-out gain."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbmart.llm import eftrie, ngramlm, queries


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], [0, 1, 2, 3], [7, 2**40, 2**40 + 1, 2**63], list(range(0, 9000, 7))])
def test_elias_fano_round_trip(values):
    data = eftrie.ef_encode(np.array(values, np.uint64))
    assert eftrie.ef_decode(data).tolist() == values


def test_elias_fano_is_compact():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 10_000).astype(np.uint64))
    assert len(eftrie.ef_encode(values)) * 8 < len(values) * (40 - math.log2(len(values)) + 4)


def test_trie_finds_what_was_put_in():
    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(1, 60, (900, 2)).astype(np.uint64), axis=0)
    n = rng.integers(1, 5, len(pairs))
    trie = eftrie.Trie.map(eftrie.Trie.build(pairs[:, 0], pairs[:, 1], n).to_bytes())
    search = trie.lookup()
    probe = np.array([(a, b) for a in range(62) for b in range(62)], np.uint64)
    got = eftrie.PROBABILITY[search.codes(probe[:, 0], probe[:, 1])]
    known = {tuple(p): c for p, c in zip(pairs.tolist(), n.tolist(), strict=True)}
    total = Counter()
    for (a, _), c in known.items():
        total[a] += c
    once, twice = int((n == 1).sum()), int((n == 2).sum())
    discount = min(0.95, max(0.05, once / (once + 2 * twice)))
    for (a, b), p in zip(probe.tolist(), got, strict=True):
        assert p == pytest.approx((known[a, b] - discount) / total[a] if (a, b) in known else 0, rel=0.05)
    sums = defaultdict(float)
    for (a, _), p in zip(probe.tolist(), got, strict=True):
        sums[a] += p
    for a, mass in zip(range(62), eftrie.PROBABILITY[trie.backoffs(np.arange(62, dtype=np.uint64))], strict=True):
        assert sums[a] + mass == pytest.approx(1, abs=0.05) and (a in total or mass == 1)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


ROWS = [(1, "the cat sat on the mat", True), (2, "The cat ran\tover É", True), (2, "The cat ran\tover É", True), (3, None, True), (4, "", False), (5, "the dog sat " * 40, False), (None, "\n", False), (6, "É é unknown", False)]


@pytest.mark.parametrize("chunk", [24_000_000, 60])
def test_counts_and_base_scores_as_a_plain_model(spark, chunk):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, t boolean")
    got = ngramlm.score(df, F.col("t"), chunk=chunk).collect()
    taught = Counter(w for _, text, t in ROWS if t for w in tokens(text))
    total, distinct = sum(taught.values()), len(taught)
    want = []
    for i, text, t in ROWS:
        ws = tokens(text)
        base = sum(math.log10((taught[w] + 1) / (total + distinct + 1)) for w in ws)
        want.append((i, t, len(ws), sum(w in taught for w in ws), total, round(base, 9)))
    plain = lambda rows: sorted(rows, key=str)
    assert plain((r.doc_id, r.training, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in got) == plain(want)
    # An exact model has the same discounts; codes are within a twentieth of it.
    pairs, firsts = Counter(), Counter()
    for _, text, t in ROWS:
        ws = tokens(text)
        for a, b in zip([None, *ws], ws, strict=False):
            if t:
                pairs[a, b] += 1
                firsts[a] += 1
    if chunk > 1000:
        once, twice = (sum(c == k for c in pairs.values()) for k in (1, 2))
        discount = min(0.95, max(0.05, once / (once + 2 * twice)))
        for r, (_, text, _) in zip(sorted(got, key=lambda r: str((r.doc_id, r.n_tokens))), sorted(ROWS, key=lambda r: str((r[0], len(tokens(r[1]))))), strict=True):
            ws, score = tokens(text), 0.0
            for a, b in zip([None, *ws], ws, strict=False):
                alone = (taught[b] + 1) / (total + distinct + 1)
                kinds = sum(x == a for x, _ in pairs)
                score += math.log10((max(pairs[a, b] - discount, 0) + discount * kinds * alone) / firsts[a] if firsts[a] else alone)
            assert r.score == pytest.approx(score, abs=0.021 * len(ws))


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = ngramlm.score(df, F.lit(False)).collect()
    assert all((r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0, 0) for r in got)
    assert ngramlm.score(df.limit(0), F.lit(True)).count() == 0


def test_held_out_documents_gain(spark):
    got = queries.op5_lm_scoring(spark, "/root/testdata/sf0.01").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and (got.score < 0).all()
    assert held.score.sum() > held.base_score.sum() and (held.score > held.base_score).mean() > 0.8
