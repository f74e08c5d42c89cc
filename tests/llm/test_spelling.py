"""Spelling variants against brute force and SQL."""

import random
import zlib

import pytest

from plumbmart.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute(counts, factor=2):
    out = []
    form = {}
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best and counts[best] >= factor * n else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out, key=str)


def got(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, spelling.forms(df, **options).collect()), key=str)


@pytest.mark.parametrize(("letters", "sizes", "number", "seed"), [("ab", (3, 9), 400, 1), ("aéz", (4, 8), 500, 2), ("abcdeßÿ", (5, 6), 500, 3), ("a", (3, 60), 40, 4)])
def test_as_brute_force(spark, letters, sizes, number, seed):
    rng = random.Random(seed)
    counts = {"".join(rng.choices(letters, k=rng.randint(*sizes))): int(3 * 1.3 ** rng.randint(0, 25)) for _ in range(number)}
    assert got(spark, counts) == brute(counts)


def test_long_and_lonely_words(spark):
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefg", k=5000))
    counts = {long: 9, long[:2000] + long[2001:]: 3, long[:4000] + "x" + long[4001:]: 4, long + "z": 40, "alone": 3, "y" + long: 5}
    assert got(spark, counts) == brute(counts)
    assert got(spark, {"alone": 7}) == [("alone", None, "alone", 7, 0, None)]


def test_chains_are_followed(spark):
    counts = {"a" * k: 3 * 2**k for k in range(3, 40)}
    rows = got(spark, counts)
    assert rows == brute(counts)
    assert {r[2] for r in rows} == {"a" * 39}
    assert got(spark, counts, factor=3) == brute(counts, 3)


def test_words_of_texts(spark):
    rng = random.Random(6)
    rows = [(k if k % 7 else None, " ".join("".join(rng.choices("abÀÉßÿ÷", k=rng.randint(3, 7))) for _ in range(200)), "x") for k in range(40)]
    rows += [(1, None, "x"), (2, "", "x"), (3, "Hello, HELLO hello1ÀB", "x"), *rows[:5]]
    want = {}
    for key, text, _ in rows:
        run, runs = "", []
        for c in (text or "") + " ":
            if "a" <= c.lower() <= "z" and c.isascii() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            else:
                runs, run = [*runs, run] if run else runs, ""
        for w in runs:
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % 11 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 4:
                want[w] = want.get(w, 0) + 1
    df = spark.createDataFrame(rows, "doc_id long, text string, Word string")
    found = spelling.words(df, slip=11, least_length=4, least=2)
    assert {r.word: r.n for r in found.collect()} == {w: n for w, n in want.items() if n >= 2}


def test_nothing(spark):
    assert got(spark, {}) == []
    with pytest.raises(ValueError):
        got(spark, {"ab": 3})


def test_query_equals_sql(spark, oracle, same):
    same(queries.op11_spelling_variants(spark, SF).toPandas(), oracle("op11_spelling_variants"))
