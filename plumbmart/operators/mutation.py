"""Controlled damage to a relation, to prove that a named assertion notices it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def change_cell(df: DataFrame, where: Column, column: str, value: Column) -> DataFrame:
    """Replace one column where the condition holds, keeping its type."""
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(where, value.cast(kind)).otherwise(F.col(column)))


def drop_rows(df: DataFrame, where: Column) -> DataFrame:
    return df.where(~F.coalesce(where, F.lit(False)))


def repeat_rows(df: DataFrame, where: Column) -> DataFrame:
    return df.unionByName(df.where(where))
