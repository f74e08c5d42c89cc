"""Packing against brute force, the tokenizers library and the rules of a packing."""

import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbmart.llm import packing, queries
from tests.llm.test_bpe import odd_texts

PATH = queries.tokenizer_path()
SF = "/root/testdata/sf0.001"


def fewest(lengths, capacity):
    """The least number of bins, over all subsets of pieces."""
    n = len(lengths)

    @lru_cache(None)
    def best(left):
        if not left:
            return (0, 0)
        found = (n + 1, 0)
        for k in range(n):
            if left >> k & 1:
                bins, used = best(left & ~(1 << k))
                used += lengths[k]
                found = min(found, (bins, used) if used <= capacity and bins else (bins + 1, lengths[k]))
        return found

    return best((1 << n) - 1)[0]


def histogram(lengths):
    return {x: lengths.count(x) for x in set(lengths)}


def check(hist, packed, capacity):
    used = {}
    for filling, times in packed.fillings:
        assert times > 0 and sum(x * n for x, n in filling) <= capacity
        for x, n in filling:
            used[x] = used.get(x, 0) + n * times
    assert used == hist
    assert packed.count >= packed.bound


def test_small_packings_are_the_best():
    rng = random.Random(3)
    better = 0
    for _ in range(150):
        capacity = rng.choice([20, 50, 100])
        lengths = [rng.randint(max(1, capacity // rng.choice([3, 6, 20])), capacity * 2 // 3) for _ in range(rng.randint(1, 11))]
        hist = histogram(lengths)
        packed = packing.fillings(hist, capacity)
        check(hist, packed, capacity)
        want = fewest(tuple(lengths), capacity)
        assert packed.count == want, (lengths, capacity)
        assert packing.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity) <= want
        counts = np.bincount(lengths, minlength=capacity + 1)
        better += packed.count < sum(t for _, t in packing.best_fit(counts, capacity))
    assert better > 0  # the search, not only the incumbent, finds them


def test_repeated_fillings_where_best_fit_fails():
    """Thirds and halves that best fit decreasing mixes badly, a thousand times each."""
    capacity = 100
    hist = {44: 1000, 24: 1000, 22: 1000, 10: 1000, 51: 2000, 27: 2000, 18: 2000, 4: 2000}
    packed = packing.fillings(hist, capacity)
    check(hist, packed, capacity)
    assert packed.count == packed.bound == 3000


def test_many_rows_cost_as_much_as_few():
    rng = random.Random(4)
    hist = {x: rng.randint(1, 10**9) for x in range(1, 4097)}
    packed = packing.fillings(hist, 4096)
    check(hist, packed, 4096)
    assert packed.count <= packed.bound * 1.01
    assert len(packed.fillings) < 40_000


def test_dominance():
    assert packing.dominates((50, 30), (50, 20, 10))
    assert packing.dominates((50, 30), (40, 30))
    assert not packing.dominates((50, 30), (60,))
    assert not packing.dominates((50, 30), (40, 35))


def test_best_fit_equals_one_by_one():
    rng = random.Random(6)
    for _ in range(100):
        capacity = 60
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        bins = []
        for x in sorted(lengths, reverse=True):
            open_bins = [b for b in bins if b[0] >= x]
            if open_bins:
                min(open_bins, key=lambda b: b[0])[0] -= x
            else:
                bins.append([capacity - x])
        packed = packing.best_fit(np.bincount(lengths, minlength=capacity + 1) if lengths else np.zeros(61, np.int64), capacity)
        assert sum(t for _, t in packed) == len(bins)


def test_ids_are_those_of_the_library(monkeypatch):
    library = Tokenizer.from_file(PATH)
    monkeypatch.setattr(packing, "BLOCK", 300)
    monkeypatch.setattr(packing, "MEMORY", 5_000)
    words = packing.Words(open(PATH, encoding="utf-8").read())
    points = [c for c in map(chr, range(1, 0x3200)) if not 0xD800 <= ord(c) < 0xE000]
    texts = odd_texts() + ["".join(f"a{c}b {c} " for c in points[k : k + 16]) for k in range(0, len(points), 16)]
    latin = "aEé ÄßñÇøŒſİªµ²½¹3'_-.,\xa0\x85\u02afÞ÷×"
    texts += ["".join(random.Random(k).choice(latin) for _ in range(50)) for k in range(300)]
    texts += ["J̌ ǰ İ", "x" * 5000 + " y", "the quick brown foxes' " * 60]
    for text, got in zip(texts, words.encode(texts), strict=True):
        assert got == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def valid(rows, capacity=4096):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query(spark):
    rows = queries.op13_best_fit_packing(spark, SF).collect()
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d in docs:
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[d.doc_id, n] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    total = sum(x for _, x, _ in want.values())
    assert valid(rows) == -(-total // 4096)
    assert dict(queries.op13_best_fit_packing(spark, SF).dtypes) == {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"
    }


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "word " * 9000, None), (3, "it's here", "c"), (4, "x" * 30000, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Offset string")
    pieces = packing.token_pieces(df, PATH)
    placed = packing.pack(pieces.withColumn("length", F.expr("octet_length(ids) div 4")), "length", ["doc_id", "piece"])
    assert placed.columns == ["doc_id", "piece", "start", "ids", "length", "sequence_id", "offset"]
    got = placed.collect()
    assert valid(got) == -(-sum(r.length for r in got) // 4096)
    assert sorted(r.length for r in got if r.doc_id in (1, 2)) == [1, 1, 1]
    assert sorted((r.piece, r.start, r.length) for r in got if r.doc_id is None) == [(0, 0, 4096), (1, 4096, 4096), (2, 8192, 809)]
    joined = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    for r in got:
        assert joined[r.sequence_id][4 * r.offset :][: 4 * r.length] == r.ids
    assert not packing.pack(placed.where("false"), "length", ["doc_id"]).count()


def test_lengths_must_fit(spark):
    for bad in (0, 11, None):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(1, bad)], "k int, length int"), "length", ["k"], 10)
