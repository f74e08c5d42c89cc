import pytest
from pyspark.sql import functions as F

from plumbmart.operators import mutation as mu
from plumbmart.operators import relational as R


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def keyed(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_reconcile_statuses(spark):
    left, right = keyed(spark, ["a", "b", "b", "c", "d", "d"]), keyed(spark, ["a", "c", "c", "d", "d", "e"])
    got = {r.k: (r.reconciliation_status, r.l_row_count, r.r_row_count)
           for r in R.reconcile_keys(left, right, "k", "l", "r").collect()}
    assert got == {
        "a": ("matched", 1, 1), "b": ("l_only", 2, 0), "c": ("r_duplicate", 1, 2),
        "d": ("duplicate_both", 2, 2), "e": ("r_only", 0, 1)}


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([("a",), ("x",), (None,)], "k string")
    assert rows(R.orphan_rows(child, keyed(spark, ["a"]), [("k", "k")])) == [("x",)]
    assert rows(R.shared_rows(child, keyed(spark, ["a"]), ["k"])) == [("a",)]


def test_differences(spark):
    a, b = keyed(spark, ["x", "x", "y"]), keyed(spark, ["x", "y", "z"])
    assert rows(R.multiset_difference(a, b)) == [("x",), ("z",)]
    assert rows(R.set_difference(a, b)) == [("z",)]
    left = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "i int, s string, n int")
    right = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "c", 1)], "i int, s string, n int")
    assert rows(R.cell_differences(left, right, ["i"], ["s", "n"])) == [(2,), (3,), (4,)]


def test_repeated_keys_are_paired(spark):
    left = [(1, "a"), (1, "a"), (1, "b"), (2, "x"), (2, "y"), (3, None), (3, None), (None, "n"), (None, "n"), (5, "q")] + [(9, f"c{i}") for i in range(500)]
    right = [(1, "b"), (1, "a"), (1, "c"), (2, "y"), (2, "x"), (3, None), (None, "n"), (6, "q"), (6, "q")] + [(9, f"c{i}") for i in range(2, 502)]
    both = [spark.createDataFrame(side, "k int, c string") for side in (left, right)]
    got = [r[0] for r in R.cell_differences(*both, ["k"], ["c"]).collect()]
    assert sorted(got, key=str) == sorted([1, 3, None, None, None, 5, 6, 6, 9, 9], key=str)


def test_later_copies_are_the_same_in_every_run(spark):
    data = [("k", 1, "x")] * 50 + [("k", 1, "y")] * 30 + [("k", 2, "z")] * 20 + [("l", 5, "x")]
    runs = {tuple(sorted(map(tuple, R.later_occurrences(spark.createDataFrame(data[::step], "k string, o int, v string").repartition(n), ["k"], "o").collect()))) for step, n in ((1, 1), (-1, 7))}
    (later,) = runs
    assert len(later) == 99 and {r[3:] for r in later} == {(1, 100)}


def test_latest_and_scaffold(spark):
    years = spark.createDataFrame([(2020,), (2024,)], "year int")
    assert rows(R.flag_latest(years, "year", "latest")) == [(2020, False), (2024, True)]
    cats = spark.createDataFrame([(1, "a"), (2, "b")], "o int, c string")
    counted = spark.createDataFrame([("a", 5)], "c string, n bigint")
    assert rows(R.scaffold(cats, counted, "c", "n").select("o", "n")) == [(1, 5), (2, 0)]


def test_one_row_refuses_two(spark):
    two = spark.createDataFrame([(1,), (2,)], "a int")
    with pytest.raises(Exception, match="(?i)more than one row|TOO_MANY_ROWS"):
        spark.range(1).withColumn("x", R.one_row(two)).collect()


@pytest.mark.parametrize("salts", [1, 4, 64])
def test_later_occurrences_with_a_hot_key_and_ties_equals_brute_force(spark, monkeypatch, salts):
    monkeypatch.setattr(R, "SALTS", salts)
    data = [("hot", i // 2, i) for i in range(0, 300, 3)] + [(f"k{i % 70}", i, 0) for i in range(1, 200, 3)]
    data += [("tie", 7, 0)] * 3 + [("tie", 7, 1), (None, 1, 1), (None, 1, 2)]
    df = spark.createDataFrame(data, "k string, o int, x int")
    want = []
    for key in {k for k, _, _ in data if k is not None}:
        mine = sorted(o for k, o, _ in data if k == key)
        want += [(key, o, mine[0]) for o in mine[1:]]
    assert rows(R.later_occurrences(df, ["k"], "o").select("k", "o", "first_seen_at")) == sorted(want)


def test_surplus_copies_are_repeated(spark, monkeypatch):
    monkeypatch.setattr(R, "REPEAT_BLOCK", 4)
    a, b = keyed(spark, ["x"] * 14 + ["y"]), keyed(spark, ["x"] * 3 + ["y"] * 6)
    assert rows(R.multiset_difference(a, b)) == [("x",)] * 11 + [("y",)] * 5


def test_mutations_change_only_what_they_name(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    assert rows(mu.change_cell(df, F.col("i") == 2, "s", F.lit("z"))) == [(1, "a"), (2, "z")]
    assert rows(mu.drop_rows(df, F.col("i") == 2)) == [(1, "a")]
    assert rows(mu.repeat_rows(df, F.col("i") == 2)) == [(1, "a"), (2, "b"), (2, "b")]
