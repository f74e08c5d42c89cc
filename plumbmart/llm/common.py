"""Helpers shared by the operators: tables, the shared folder, column names."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white space ones.
WORD = r"[^\x20\x09-\x0D]+"


def by_value(module: str) -> None:
    """Pickle a module's functions by value: executors need not import it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; a
    cluster has none that all machines see, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("plumbmart.llm.folder", None)
    if not folder:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-llm-")
        spark.conf.set("plumbmart.llm.folder", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a stored table that no later plan reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that a result column of this name replaces, in any case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fold(key, folds: int):
    """crc32 of the key as text, modulo ``folds``; a null key is in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(0))
