from pyspark.sql import functions as F

from plumbmart.plans.assertions import ASSERTIONS
from plumbmart.plans.damage import ADD, CHANGE, DROP, WORLD, Damage, damage_report, damaged, worlds
from plumbmart.plans.quality import RowRule, SetRule
from plumbmart.queries.catalog import QUERIES
from plumbmart.queries.damage import DAMAGES


def numbers(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "n int, s string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_each_kind_of_damage(spark):
    df = numbers(spark)
    assert rows(damaged(df, Damage("t", CHANGE, "n = 1", "s", "'x'"))) == rows(
        spark.createDataFrame([(1, "x"), (2, "b"), (None, "c")], "n int, s string"))
    assert rows(damaged(df, Damage("t", DROP, "n = 1"))) == sorted([(2, "b"), (None, "c")], key=str)
    assert rows(damaged(df, Damage("t", ADD, "n = 1"))) == sorted([(1, "a"), (1, "a"), (2, "b"), (None, "c")], key=str)
    assert rows(damaged(df, Damage("t", ADD, "n = 2", "n", "n + 40"))) == sorted(
        [(1, "a"), (2, "b"), (42, "b"), (None, "c")], key=str)
    assert damaged(df, Damage("t", CHANGE, "true", "n", "n + 1")).schema == df.schema


def test_worlds_are_one_scan_and_do_not_see_each_other(spark):
    df = numbers(spark)
    several = {
        "up": Damage("t", CHANGE, "true", "n", "n + 10"),
        "down": Damage("t", CHANGE, "n = 11 or n = 2", "n", "n - 10"),
        "none": Damage("t", DROP),
    }
    copies = worlds(df, several)
    for name, damage in several.items():
        assert rows(copies.where(F.col(WORLD) == name).drop(WORLD)) == rows(damaged(df, damage))
    assert copies._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert worlds(df.limit(0), several).count() == 0


def test_report_counts_each_rule_in_its_own_world(spark):
    tables = {"t": numbers(spark), "u": numbers(spark)}
    rules = {
        "large": RowRule("t", lambda: F.col("n") > 10),
        "small": RowRule("t", lambda: F.col("n") < 0),
        "alike": SetRule(("t", "u"), lambda t, u: t.exceptAll(u)),
    }
    damages = {
        "large": Damage("t", CHANGE, "true", "n", "n + 10"),
        "small": Damage("t", CHANGE, "n = 2", "n", "-1"),
        "alike": Damage("u", DROP, "n is null"),
    }
    assert rows(damage_report(rules, damages, tables)) == [("alike", "u", 1), ("large", "t", 2), ("small", "t", 1)]


def test_every_assertion_finds_its_damage(spark):
    assert set(DAMAGES) == set(ASSERTIONS)
    found = QUERIES["damage_of_every_assertion"](spark, "/root/testdata/sf0.001").collect()
    assert {r.assertion for r in found} == set(ASSERTIONS)
    assert [r.assertion for r in found if not r.violations] == []
