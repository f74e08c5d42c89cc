"""From documents to token ids: five stages over the whole table.

1. language: documents without a recognised language go (null, empty, letterless texts).
2. quality: documents that the rule ensemble finds bad go.
3. near_duplicates: of each group of copies and near copies one document stays.
4. mixing: documents are dropped or repeated so that sources meet their target weights.
5. tokens: the whole texts are encoded.

Each stage is written as Parquet to the shared folder and read again, so a lost
executor costs at most the stage it works on. Column names that begin with two
underscores are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbmart.llm import bpe, langid, minhash, mixing, queries, rules
from plumbmart.llm.common import fold, stored, table

#: A document stays if its quality score reaches this.
QUALITY = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, by a model learned from those outside fold 2 of 4."""
    model = langid.train(docs.where(fold("doc_id", 4) != 2))
    done = langid.predict(docs, model, lang="__lang", score="__score")
    # Without anything to learn from, nothing can be rejected.
    known = done.where(F.col("__lang") != langid.UNKNOWN) if model.langs else done
    return known.select(*(f"`{c}`" for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a good score, by a model learned from the labels outside fold 2 of 4."""
    labels = table(spark, sf_dir, "labels")
    training = docs.select("doc_id", "text").where(fold("doc_id", 4) != 2).join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    model = rules.train(stored(rules.statistics(training).drop("text"), "statistics"), labels)
    done = rules.score(rules.statistics(docs), model, "__score")
    return done.where(F.col("__score") >= QUALITY).select(*(f"`{c}`" for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are linked by 0.8 similar sets of five-word runs."""
    return minhash.one_of_each(docs).select(*(f"`{c}`" for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    mixed = mixing.mix(docs, mixing.cycle, results=("__size", "__source_size", "__target", "__copies"))
    return mixing.repeated(mixed, "__copies").select(*(f"`{c}`" for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document of the mix; decoded texts are not made."""
    done = bpe.encode_decode(docs.select("doc_id", "source", "text"), bpe.Model(queries.tokenizer_path()), decoded=None)
    return done.select("doc_id", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("mixing", mix), ("tokens", tokens)]

#: SQL can express neither the learned stages nor BPE; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
