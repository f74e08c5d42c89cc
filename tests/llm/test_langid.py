"""Language ID: code lengths against a plain coder, edge rows, held-out accuracy."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbmart.llm import langid, queries, words


def symbols(text):
    out = []
    for b in text.encode():
        c = chr(b)
        out.append(1 if c.isdigit() and b < 128 else 2 + ord(c.lower()) - 97 if b < 128 and c.isalpha() else 28 + b - 128 if b >= 128 else 0)
    return out


def plain_bits(training, text):
    """PPM with escapes and exclusion, symbol by symbol."""
    after = {}
    for t in training:
        s = [0, 0, *symbols(t)]
        for i in range(2, len(s)):
            for k in range(3):
                after.setdefault(tuple(s[i - k : i]) if k < 2 else tuple(s[i - 2 : i]), Counter())[s[i]] += 1
    s, bits = [0, 0, *symbols(text)], 0.0
    for i in range(2, len(s)):
        out = set()
        for k in (2, 1, 0):
            n = {x: c for x, c in after.get(tuple(s[i - k : i]), {}).items() if x not in out}
            if not n:
                continue
            whole = sum(n.values()) + len(n)
            if s[i] in n:
                bits += math.log2(whole / n[s[i]])
                break
            bits += math.log2(whole / len(n))
            out |= n.keys()
        else:
            bits += math.log2(156 - len(out))
    return bits


TRAINING = [("en", "The cat sat on the mat, 12 times."), ("en", "the dog"), ("de", "Die Katze saß auf über"), ("fr", "été çà et là"), (None, "nobody"), ("en", None)]


def test_code_lengths_are_exact(spark, monkeypatch):
    model = langid.train(spark.createDataFrame(TRAINING, "lang string, text string"))
    assert model.langs == ["de", "en", "fr"]
    texts = ["", "the", "Über die Katze", None, "zzz 9", "é", "日本 çat 7!", "the cat " * 30, "x"]
    for size in (1 << 20, 7, 3):
        monkeypatch.setattr(langid.pieces, "__defaults__", (size,))
        got = langid.text_bits(model, *words.bytes_of(pa.array(texts, pa.string())))
        for row, text in zip(got, texts, strict=True):
            for k, lang in enumerate(model.langs):
                want = plain_bits([t for name, t in TRAINING if name == lang and t], text or "")
                assert row[k] == pytest.approx(want, rel=1e-5, abs=1e-3), (text, lang)


def test_probabilities_sum_to_at_most_one(spark):
    model = langid.train(spark.createDataFrame(TRAINING, "lang string, text string"))
    total = np.exp2(-model.cost.astype(float)).sum(1)
    assert (total < 1 + 1e-4).all() and (total > 0.5).all()


def test_edge_rows(spark):
    model = langid.train(spark.createDataFrame(TRAINING, "lang string, text string"))
    df = spark.createDataFrame([(1, None, 9.0), (1, "", 9.0), (2, "12 !?", 9.0), (3, "the mat", 9.0), (3, "the mat", 9.0), (None, "ß", None)], "doc_id long, text string, SCORE double")
    got = langid.predict(df, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    rows = sorted(((r.text, r.lang_pred) for r in got.collect()), key=str)
    assert rows == sorted([(None, "und"), ("", "und"), ("12 !?", "und"), ("the mat", "en"), ("the mat", "en"), ("ß", "de")], key=str)
    assert all(0 <= r.score <= 1 for r in got.collect())
    empty = langid.train(spark.createDataFrame([], "lang string, text string"))
    assert {(r.lang_pred, r.score) for r in langid.predict(df, empty).collect()} == {("und", 0.0)}
    assert langid.predict(df.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op10_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.count() == 1000
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
