"""The pipeline: every stage against a plain version, odd tables, and the library without this subpackage."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbmart.llm import langid, minhash, mixing, queries, rules

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, SIZE int, score string, copies int"


@pytest.fixture(scope="module")
def runs(spark):
    """What each stage returns over the smallest tables, in order."""
    out = {"documents": spark.read.parquet(f"{SF}/documents.parquet")}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema) if name != "tokens" else stage(spark, docs, SF)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_order_and_columns(runs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "mixing", "tokens"]
    for name in ("language", "quality", "near_duplicates", "mixing"):
        assert runs[name].columns == runs["documents"].columns


def test_language_keeps_what_it_recognises(runs):
    want = sorted(r.doc_id for r in runs["documents"].collect() if r.text and any(c.isalpha() for c in r.text))
    assert ids(runs["language"]) == want


def test_quality_keeps_the_good(spark, runs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = set(ids(runs["language"])), set(ids(runs["quality"]))
    good, bad = ({i for i in before if labels.get(i) == q} for q in (1, 0))
    assert after <= before and len(good & after) >= 0.95 * len(good) and len(bad & after) <= 0.2 * len(bad)


def test_one_of_each_group_stays(spark, runs, oracle):
    docs = runs["quality"].toPandas()
    classes = oracle("op7_jaccard_join", documents=docs)
    assert ids(runs["near_duplicates"]) == sorted(set(classes.class_id))


def test_mix_and_tokens(spark, runs, oracle):
    docs = runs["near_duplicates"].toPandas()
    plan = oracle("op9_mixing", documents=docs)
    times = {r.doc_id: r.taken // r.size for r in plan.itertuples() if r.size}
    want = sorted(i for i, n in times.items() for _ in range(int(n)))
    assert ids(runs["mixing"]) == want
    tokens = runs["tokens"].collect()
    assert sorted(r.doc_id for r in tokens) == want and all(r.n_tokens == len(r.token_ids) > 0 for r in tokens)


def test_run_returns_the_last_stage(spark, runs):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "source", "n_tokens", "token_ids"]
    assert sorted((r.doc_id, tuple(r.token_ids)) for r in got.collect()) == sorted((r.doc_id, tuple(r.token_ids)) for r in runs["tokens"].collect())


ODD = [
    (1, "The cat sat on the mat, and that was it.", "en", "a", 1, 1, "x", 1), (1, "The cat sat on the mat, and that was it.", "en", "a", 1, 1, "x", 1),
    (None, "Ein Hund und eine Katze, das ist gut.", "de", None, None, None, None, None), (3, None, "en", "a", 0, 1, "y", 1), (4, "", None, "b", 0, 1, "y", 1),
    (5, "123 !!", "en", "b", 6, 1, "y", 1), (6, "un chat et un chien " * 2000, "fr", "b", 0, 1, "y", 1), (7, "einmal", None, "c", 0, 1, "y", 1),
]


@pytest.mark.parametrize("rows", [ODD, ODD[3:5], []])
def test_odd_tables_keep_their_columns(spark, rows):
    docs = spark.createDataFrame(rows, KIND)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame([tuple(r) for r in stage(spark, docs, SF).collect()], KIND)
        assert docs.columns == [f.split()[0] for f in KIND.split(", ")], name
    out = stage_rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(out) == docs.count() and all(r.n_tokens for r in stage_rows)
    kept = {r.doc_id for r in docs.collect()}
    assert kept <= {1, None, 6, 7}


def test_model_is_learned_outside_the_held_out_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = queries.op10_language_id(spark, SF).where("held_out").count()
    assert learned == docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).count()
    assert langid.UNKNOWN == "und" and rules.TRAIN_ROWS == 20_000 and mixing.EPOCHS == 3 and minhash.THRESHOLD == 0.8


def test_the_rest_works_without_this_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert q and s.keys() <= q.keys(); assert not [n for n in q if n.startswith('op1') or n == 'pipeline']"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": str(copy)})
