"""The mix against its SQL, and its promises on odd sources."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbmart.llm import mixing, queries

ODD = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "", None), (None, "w " * 50, None), (4, "one", "é"), (5, " \t\n", "Z"), (6, "v " * 3000, "big"), (7, "u", "big"), (8, "t t", "")]


def test_query_as_its_sql(spark, oracle, same):
    same(queries.op9_mixing(spark, "/root/testdata/sf0.001").toPandas(), oracle("op9_mixing"))


@pytest.mark.parametrize("rows", [ODD, [], [(1, None, None)], [(i, "w " * (i % 7), f"s{i % 3}") for i in range(200)]])
def test_edge_rows_as_sql(spark, oracle, same, rows):
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, SIZE int")
    out = mixing.mix(df, mixing.cycle).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
    docs = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64", "text": "string", "source": "string"})
    same(out.toPandas(), oracle("op9_mixing", documents=docs))


def test_targets_are_met_without_passing_a_cap(spark):
    rows = [(i, "w " * (1 + i * 37 % 90), f"s{i % 5 if i % 3 else 0}") for i in range(3000)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), mixing.cycle).toPandas()
    taken = (mixed["copies"] * mixed["size"]).groupby(mixed["source"]).sum()
    target = mixed.groupby("source")["target"].first()
    assert (abs(taken - target) <= 90).all() and mixed["copies"].max() <= 3
    assert target.sum() == pytest.approx(mixed["size"].sum())


def test_repeated(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 3)], "doc_id long, n int")
    assert sorted(r.doc_id for r in mixing.repeated(df, "n").collect()) == [2, 3, 3, 3]


def test_only_data_frame_operations(spark):
    plan = queries.op9_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
