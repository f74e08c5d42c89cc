"""Quality classifier: statistics against plain ones, rules as columns, held-out accuracy."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plumbmart.llm import queries, rules, words

TEXTS = ["", None, "The cat.", "BUY!! NOW!! it it it | a", "ä ß 12 3.\n\nx*** y### z\n", " \n ", "word " * 300, "a" * 5000]


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    raw = re.findall(r"[^\x20\x09-\x0D]+", text)
    data = text.encode()
    n, size = max(len(w), 1), max(len(data), 1)
    letters = sum(chr(b).isalpha() if b < 128 else 1 for b in data)
    marks = lambda s: sum(chr(b) in "!#$%&*+/<=>@[\\]^_`{|}~\x7f" for b in s)
    lines = text.count("\n")
    return [
        math.log1p(len(w)), sum(len(x.encode()) for x in w) / n, sum(65 <= b <= 90 for b in data) / max(letters, 1), sum(48 <= b < 58 for b in data) / size,
        marks(data) / size, sum(chr(b) in ".,;:?'\"-()" for b in data) / size, sum(b > 127 for b in data) / size, sum(a == b for a, b in zip(w, w[1:])) / n,
        len(set(w)) / n**0.8, math.log1p(lines), n / (lines + 1) if w else 0, sum(marks(x[-1:].encode()) for x in raw) / n,
        sum(len(x) == 1 and marks(x.encode()) for x in raw) / n, sum(x.endswith("!") for x in raw) / n, max(Counter(w).values(), default=0) / n,
    ]


@pytest.mark.parametrize("chunk", [1 << 20, 16])
def test_statistics(chunk, monkeypatch):
    monkeypatch.setattr(words.spans, "__defaults__", (chunk,))
    monkeypatch.setattr(rules, "CHUNK", chunk)
    got = rules.features(pa.array(TEXTS, pa.string()))
    for row, text in zip(got, TEXTS, strict=True):
        assert row == pytest.approx(plain(text)), text


def test_columns_equal_the_model(spark):
    rng = np.random.default_rng(3)
    x = rng.random((600, len(rules.STATISTICS)))
    y = ((x[:, 2] > 0.5) & (x[:, 4] <= 0.7)).astype(float)
    model = rules.fit(x, y)
    assert model.rules and len(model.rules) < 300
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["doc_id", *rules.STATISTICS])
    got = {r.doc_id: r.score for r in rules.score(df, model).collect()}
    margin = model.intercept + sum(w * rules.holds(r, x) for r, w in zip(model.rules, model.weights, strict=True))
    assert [got[i] for i in range(600)] == pytest.approx(list(1 / (1 + np.exp(-margin))))
    assert np.mean((np.array([got[i] for i in range(600)]) > 0.5) == y) > 0.97


def test_edge_labels(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (2, None), (None, "x"), (3, "")], "doc_id long, text string")
    stats = rules.statistics(df)
    for rows, want in (([], 0.5), ([(1, 1), (2, None), (None, 0)], 2 / 3), ([(1, 1), (1, 0)], 0.5)):
        model = rules.train(stats, spark.createDataFrame(rows, "doc_id long, quality int"))
        out = rules.score(stats, model).collect()
        assert len(out) == 5 and all(r.score == pytest.approx(want) for r in out)
    assert rules.statistics(df.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op6_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    good, bad = held.score[held.quality == 1].to_numpy(), held.score[held.quality == 0].to_numpy()
    assert np.mean(good[:, None] > bad[None, :]) > 0.95
    assert (held.predicted == held.quality).mean() > 0.93
