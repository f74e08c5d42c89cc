"""Scans of published files: strict all-text CSV and file fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbmart.operators.evidence import file_evidence
from plumbmart.sources.csv_split import csv_records


class HeaderError(ValueError):
    """A CSV header is empty, repeats a label or lacks a required one."""


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The ordered labels of the header, which may hold quoted line breaks."""
    first = spark.read.csv(path, header=False, quote='"', escape='"', multiLine=True).head(1)
    if not first:
        raise HeaderError(f"{path}: empty file")
    return [label if label is not None else "" for label in first[0]]


def scan_csv(
    spark: SparkSession,
    path: str,
    required: Sequence[str],
    *,
    multi_line: bool = True,
    numbered: bool = False,
) -> DataFrame:
    """The required columns as text exactly as received; blanks are ``''``.

    ``numbered`` adds the ``file`` and ``row_number`` of each row, the header being
    row 1, for reports that name the row.

    Ragged rows and files whose header differs stop the read. Files are read by
    many tasks, with quoted line breaks by ``csv_split``; switch ``multi_line`` off
    for a publisher that never breaks lines, which saves its passes over the lines.
    """
    if numbered and not multi_line:
        raise ValueError("rows are numbered as they are split")
    header = csv_header(spark, path)
    repeated = sorted({h for h in header if header.count(h) > 1})
    if repeated:
        raise HeaderError(f"{path}: repeated labels {repeated}")
    missing = [n for n in required if n not in header]
    if missing:
        raise HeaderError(f"{path}: required columns missing {missing}")
    schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
    options = {
        "quote": '"', "escape": '"', "mode": "FAILFAST", "columnPruning": "false",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    if multi_line:
        rows = _split_rows(csv_records(spark, path, numbered), header, schema, {**options, "multiLine": "true"})
    else:
        rows = spark.read.schema(schema).options(**options).csv(path, header=True, enforceSchema=False)
    texts = [F.coalesce(F.col(f"row.`{n}`") if multi_line else F.col(f"`{n}`"), F.lit("")).alias(n) for n in required]
    return rows.select(*(["file", "row_number"] if numbered else []), *texts)


def _split_rows(records: DataFrame, header: Sequence[str], schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """Records parsed one by one; the first of each file must be the header."""
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
    parsed = records.withColumn("row", F.from_csv("text", ddl, options)).drop("text")
    same = F.lit(True)
    for h in header:
        same = same & F.coalesce(F.col("row").getField(h), F.lit("")).eqNullSafe(F.lit(h))
    wrong = F.raise_error(F.concat(F.lit("the header differs in "), F.col("file"))).cast("boolean")
    body = F.when(~F.col("first"), True).when(same, False).otherwise(wrong)
    return parsed.where(body)


def columns_frame(
    spark: SparkSession, names: Sequence[str], declared_types: Sequence[str] | None = None
) -> DataFrame:
    """Ordered column metadata as a relation, for the schema checks and hashes."""
    types = declared_types or ["TEXT"] * len(names)
    rows = [(i, n, t) for i, (n, t) in enumerate(zip(names, types, strict=True))]
    return spark.createDataFrame(rows, "position int, name string, declared_type string")


def header_issues(observed: DataFrame, published: DataFrame) -> DataFrame:
    """Repeated labels, and positions where file and published header differ."""
    repeated = (
        observed.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.lit("duplicate_header").alias("code"), F.col("name").alias("field"))
    )
    a = observed.select("position", F.col("name").alias("seen"))
    b = published.select("position", F.col("name").alias("expected"))
    moved = a.join(b, "position", "full").where(
        ~F.col("seen").eqNullSafe(F.col("expected"))
    ).select(F.lit("header_mismatch").alias("code"),
             F.coalesce("expected", "seen").alias("field"))
    return repeated.union(moved)


def scan_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """Path, byte count and SHA-256 of every file under ``path``."""
    return file_evidence(spark.read.format("binaryFile").load(path))
