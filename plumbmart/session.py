"""Session helpers: settings for a local run, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The JVM never compiles a method above 8,000 bytes. The wide typing projections
# generate larger ones; with this limit Spark splits them into small methods
# instead, which runs them two to three times faster. Set it on a cluster too.
HUGE_METHOD_LIMIT = "8000"
# Tasks that write the rows of one partition value.
WRITERS = 8


def local_session(cpus: int = 8, app_name: str = "plumbmart", folder: str | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own.

    ``folder`` becomes the shared folder.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_LIMIT)
    )
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A cluster without that setting has no folder that all machines see, which is
    an error. A local session, which is one machine, gets one of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("plumbmart.scratch.dir", None)
    if not folder:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-plumbmart-")
        spark.conf.set("plumbmart.scratch.dir", folder)
    return folder.rstrip("/")


def materialise(
    df: DataFrame,
    label: str,
    partition_by: Sequence[str] = (),
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used where several consumers read one relation: it cuts the lineage, keeps
    column and partition pruning for the readers and survives lost executors.
    ``watch`` is put on the rows that the writing tasks write, after any shuffle;
    what it observes there counts each task once, whatever is run again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/plumbmart/{label}-{uuid.uuid4().hex}"
    if partition_by:
        # a few tasks for each value, or every task would write a file for every value
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(WRITERS))
        df = df.repartition(*partition_by, salt)
    watch(df).write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*(f"`{c}`" for c in df.columns))
