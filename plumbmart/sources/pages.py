"""Scan of paged JSON: one page of records per file, tokens kept as source text."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The parser travels with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    raise ValueError(f"unexpected value {value!r}")


def _records(body: bytes | str, names: Sequence[str]) -> Iterator[tuple]:
    """(position, problem, more, *values) per record; one row when a page is bad."""
    empty = (None,) * len(names)
    try:
        # numbers stay exactly as written
        page = json.loads(body, parse_int=str, parse_float=str)
        features = page["features"]
        more = page.get("exceededTransferLimit")
        if not isinstance(features, list) or not features:
            yield (None, "page has no records", more, *empty)
            return
    except (ValueError, KeyError, TypeError, AttributeError):
        yield (None, "page is not a JSON object with features", None, *empty)
        return
    for position, feature in enumerate(features):
        attributes = feature.get("attributes") if isinstance(feature, dict) else None
        if not isinstance(attributes, dict):
            yield (position, "record has no attributes", more, *empty)
        elif "geometry" in feature:
            yield (position, "record contains geometry", more, *empty)
        elif set(attributes) != set(names):
            differing = sorted(set(attributes) ^ set(names))
            yield (position, "attributes differ: " + ", ".join(differing), more, *empty)
        else:
            try:
                yield (position, None, more, *(_text(attributes[n]) for n in names))
            except ValueError as error:
                yield (position, str(error), more, *empty)


def parse_pages(pages: DataFrame, body: str, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per record of each page.

    Spark's own JSON readers rewrite numbers given as text (0.7500 becomes
    0.75), so a page body is parsed in Python, one Arrow batch at a time. The
    result keeps ``keys`` and adds ``position``, ``problem`` (NULL when good),
    ``more_pages`` and the attributes.
    """
    names = list(names)
    added = ["position", "problem", "more_pages", *names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                values = dict(zip(batch.columns, row, strict=True))
                out = pd.DataFrame(list(_records(values[body], names)), columns=added, dtype=object)
                for k in keys:
                    out[k] = values[k]
                yield out[[*keys, *added]]

    kept = pages.select(*keys, body)
    key_ddl = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != body
    )
    attribute_ddl = ", ".join(f"`{n}` string" for n in names)
    schema = f"{key_ddl}, position int, problem string, more_pages boolean, {attribute_ddl}"
    return kept.mapInPandas(run, schema)


def scan_pages(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Records of every ``page-<offset>.json`` under ``path`` with page evidence."""
    files = spark.read.format("binaryFile").load(path).select(
        F.regexp_extract("path", r"page-([0-9]+)\.json\z", 1).cast("bigint").alias("page_offset"),
        F.length("content").cast("bigint").alias("page_bytes"),
        F.sha2("content", 256).alias("page_sha256"),
        "content",
    )
    return parse_pages(files, "content", ["page_offset", "page_bytes", "page_sha256"], names)


def page_problems(records: DataFrame) -> DataFrame:
    return records.where(F.col("problem").isNotNull())
