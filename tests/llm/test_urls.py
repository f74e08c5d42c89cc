"""URL filter against its SQL, and against plain models on edge rows."""

import pandas as pd
import pytest

from plumbmart.llm import queries, urls


def test_query_as_its_sql(spark, oracle, same):
    same(queries.op3_url_filter(spark, "/root/testdata/sf0.001").toPandas(), oracle("op3_url_filter"))


def test_edge_rows_as_sql(spark, oracle, same):
    links = [
        None, "", "no scheme/en/", "http://", "HTTP://EXAMPLE.NET/en/x", "http://a.example.net/en/?q", "http://xexample.net/en/", "https://example.com/de/#f", "https://example.com/de",
        "ftp://é.ORG/fr/ö?x", "http://org/fr/", "http://net", "http://net/", "http://a.b://c/fr/", "http://q.org/fr/" + "9" * 5000, "://x.net/y", "http://shop.net/\nx",
    ]
    rows = [(None if i == 3 else i, link) for i, link in enumerate(links * 3)]
    df = spark.createDataFrame([(i, u, "old") for i, u in rows], "page_id long, url string, HOST string")
    out = urls.judge(df, queries.URL_RULES)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "score", "verdict"]
    want = oracle("op3_url_filter", pages=pd.DataFrame(rows, columns=["page_id", "url"]).astype({"page_id": "Int64"}))
    same(out.select("page_id", "host", "path", "rule", "verdict").toPandas(), want)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "http://x.de/a"), (1, "http://x.de/a")], [(1, "http://x.net/a"), (2, "http://y.io")]])
def test_nothing_to_compare(spark, rows):
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES).collect()
    assert len(got) == len(rows)
    assert all(r.score == 0 and r.verdict == ("block" if r.rule else "allow") for r in got)


def test_only_data_frame_operations(spark):
    plan = queries.op3_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
