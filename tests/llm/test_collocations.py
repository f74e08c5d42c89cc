"""Collocations against brute force and SQL."""

import random
import re
from collections import Counter

import pandas as pd
import pytest

from plumbmart.llm import collocations, queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, top, least, longest):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(len(words)):
                for m in range(1, longest + 1):
                    if k + m <= len(words):
                        f[lang, tuple(words[k : k + m])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = {}
    for (lang, p), a in candidates.items():
        for m in range(2, len(p)):
            for s in range(len(p) - m + 1):
                key = lang, p[s : s + m]
                inside[key] = max(inside.get(key, 0), a)
    out = {}
    for (lang, p), a in candidates.items():
        if inside.get((lang, p), 0) < a:
            score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return [
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    ]


def corpus(seed, docs=300):
    rng = random.Random(seed)
    letters = [f"{a}{b}" for a in "abcdé" for b in "xyzß"]
    weights = [1 / (k + 1) for k in range(len(letters))]
    fixed = ["Red  Green\tblue", "green blue", "one two three four five six", "two three", "la la la"]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(letters, weights, k=rng.randint(1, 9))))
            parts.append(rng.choice([" ", ". ", ", ", "\n", "! ", " ", "\x0b", " \x85 "]))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), "".join(parts)))
    return [*rows, ("en", None), (None, ""), ("fr", "un seul"), ("de", "red  green\tblue " * 3000), *rows[:40]]


def found(spark, rows, **options):
    df = spark.createDataFrame([(lang, text, "x") for lang, text in rows], "lang string, text string, Phrase string")
    got = collocations.collocations(df.repartition(5), **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize(("seed", "top", "least", "longest", "share"), [(1, 2000, 5, 5, 8), (2, 3, 4, 5, 2), (3, 7, 3, 4, 3), (4, 2, 2, 2, 2)])
def test_as_brute_force(spark, monkeypatch, seed, top, least, longest, share):
    monkeypatch.setattr(collocations, "SHARE", share)
    monkeypatch.setattr(collocations, "BLOCK", 3_000)
    rows = corpus(seed)
    want = sorted(brute(rows, top, least, longest))
    assert found(spark, rows, top=top, least=least, longest=longest) == want
    assert len(want) >= min(top, 5)


def test_a_settled_language_is_not_expanded_again(spark, monkeypatch):
    """Rare words that always stand together fill the list before the common ones are looked at."""
    rng = random.Random(7)
    rare = [f"r{k} s{k}" for k in range(20)]
    rows = [("en", " . ".join(rng.choices(["of the", "the of", "to the"], k=200))) for _ in range(30)] + [("en", f"{x}.") for x in rare for _ in range(6)]
    waves = []
    expand = collocations.expand
    monkeypatch.setattr(collocations, "expand", lambda *a: waves.append(1) or expand(*a))
    assert found(spark, rows, top=10, least=5) == sorted(brute(rows, 10, 5, 5))
    assert len(waves) == 1
    assert found(spark, rows, top=21, least=5) == sorted(brute(rows, 21, 5, 5))
    assert len(waves) == 3


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [("en", "a b c")]) == []


def test_large_numbers(spark):
    """Products beyond 64 bits divide exactly."""
    docs = spark.createDataFrame([], "lang string, text string")
    up, down = 10**12 * 1000 * 10**13, 3 * (10**12 - 1)
    row = docs.sparkSession.sql(f"select cast(cast(cast({10**12} as decimal(18,0)) * cast({10**13} as decimal(18,0)) as decimal(34,0)) * cast(1000 as decimal(4,0)) div cast({down} as decimal(36,0)) as bigint) as q")
    assert row.first().q == up // down


def test_query_equals_sql(spark, oracle, same):
    same(queries.op12_collocations(spark, SF).toPandas(), oracle("op12_collocations"))
    assert isinstance(oracle("op12_collocations"), pd.DataFrame)
