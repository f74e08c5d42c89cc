"""Writing raw tables with their load audit, and assembling a build input."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbmart.operators.evidence import input_set_sha256
from plumbmart.operators.relational import one_row


class LoadMismatch(RuntimeError):
    """Stored rows do not equal the evidence they were loaded from."""


def with_lineage(df: DataFrame, lineage: Mapping[str, str | None]) -> DataFrame:
    """Append the snapshot's identity to every row."""
    return df.withColumns({n: F.lit(v).cast("string") for n, v in lineage.items()})


def write_raw(
    df: DataFrame, path: str, lineage: Mapping[str, str | None], evidence: Mapping[str, object]
) -> DataFrame:
    """Write a raw table once, check it against its evidence, write its audit.

    The count is taken from the written files, not from the plan that wrote
    them. ``evidence`` needs ``row_count``; further values go to the audit as
    they are. Returns the stored table.
    """
    spark = df.sparkSession
    stored_path, audit_path = f"{path}/rows", f"{path}/load_audit"
    raw = with_lineage(df, lineage)
    raw.write.mode("errorifexists").parquet(stored_path)
    stored = spark.read.schema(raw.schema).parquet(stored_path)
    loaded = stored.count()
    if loaded != evidence["row_count"]:
        raise LoadMismatch(f"{path}: loaded {loaded} rows, evidence says {evidence['row_count']}")
    audit = stored.agg(F.count(F.lit(1)).alias("row_count")).withColumns(
        {n: F.lit(v).cast("string") for n, v in lineage.items()}
        | {n: F.lit(v) for n, v in evidence.items() if n != "row_count"}
    )
    audit.coalesce(1).write.mode("errorifexists").parquet(audit_path)
    return stored


def read_raw(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A stored raw table and its load audit."""
    return spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/load_audit")


def source_audit(
    raw: DataFrame, contract_version: str, hash_name: str, page: str | None = None
) -> DataFrame:
    """One row per lineage of a raw table: identity, contract, pages and rows."""
    pages = F.countDistinct(page) if page else F.lit(1).cast("bigint")
    counted = raw.groupBy(
        "source_id", "source_manifest_run_id", hash_name, "source_retrieved_at_utc"
    ).agg(F.count(F.lit(1)).alias("row_count"), pages.alias("page_count"))
    return counted.select(
        "source_id",
        F.col("source_manifest_run_id").alias("manifest_run_id"),
        F.lit(contract_version).alias("contract_version"),
        F.col(hash_name).alias("snapshot_sha256"),
        F.col("source_retrieved_at_utc").alias("retrieved_at_utc"),
        "page_count",
        "row_count",
    )


def build_input_audit(build_id: str, audits: Mapping[str, DataFrame]) -> DataFrame:
    """The one audit row of a combined build over two or three sources.

    ``audits`` maps the prefixes ``cms``, ``svi`` and optionally ``facility`` to
    one-row source audits; format 1 has two sources, format 2 has three.
    """
    version = 2 if "facility" in audits else 1
    identity = input_set_sha256(reduce(DataFrame.union, audits.values()), version)
    spark = next(iter(audits.values())).sparkSession
    out = spark.range(1).select(
        F.lit(version).alias("build_format_version"),
        F.lit(build_id).alias("build_id"),
        identity.scalar().alias("input_set_sha256"),
        *(one_row(audit).alias(f"_{p}") for p, audit in audits.items()),
    )
    names = ("source_id", "manifest_run_id", "contract_version", "snapshot_sha256",
             "retrieved_at_utc", "page_count", "row_count")
    columns = []
    for prefix in ("cms", "svi", "facility"):
        for name in names:
            label = "content_sha256" if (prefix, name) == ("cms", "snapshot_sha256") else name
            if prefix in audits:
                value = F.col(f"_{prefix}.{name}")
            else:
                value = F.lit(None).cast("bigint" if name.endswith("_count") else "string")
            columns.append(value.alias(f"{prefix}_{label}"))
    return out.select("build_format_version", "build_id", "input_set_sha256", *columns)


def combined_counts(tables: Mapping[str, DataFrame], audit: DataFrame) -> DataFrame:
    """Stored rows of each source beside the build audit's count for it."""
    recorded = one_row(audit)
    parts = [
        df.agg(F.count(F.lit(1)).alias("stored_rows")).select(
            F.lit(prefix).alias("source"), "stored_rows",
            recorded[f"{prefix}_row_count"].alias("audited_rows"),
        )
        for prefix, df in tables.items()
    ]
    return reduce(DataFrame.union, parts)


def build_decision(tables: Mapping[str, DataFrame], audit: DataFrame, expected: DataFrame) -> DataFrame:
    """``loaded``, ``database_noop`` or ``conflict`` for a combined build, and what differs.

    ``tables`` maps prefixes to the stored raw tables, ``audit`` is the stored build
    audit and ``expected`` the audit row of the inputs at hand. Nothing stored means
    load. One audit row that names the same build and inputs, over tables of the
    announced sizes, means nothing to do. All else is a conflict; ``differing`` lists
    the audit fields and ``<prefix>_stored_rows`` that disagree. The time of
    retrieval is no part of an identity. A source that is announced by neither side
    has no rows.
    """
    names = [c for c in expected.columns if not c.endswith("_retrieved_at_utc")]
    want = one_row(expected)
    seen = audit.agg(
        F.count(F.lit(1)).alias("audits"), *(F.count_if(~F.col(c).eqNullSafe(want[c])).alias(c) for c in names)
    )
    sizes = {p: df.agg(F.count(F.lit(1))).scalar() for p, df in tables.items()}
    state = seen.select("audits", *names, want.alias("want"), *(n.alias(f"{p}_stored_rows") for p, n in sizes.items()))
    announced = {p: F.coalesce(F.col(f"want.{p}_row_count"), F.lit(0)) for p in tables}
    unequal = {c: F.col(c) > 0 for c in names} | {
        f"{p}_stored_rows": F.col(f"{p}_stored_rows") != n for p, n in announced.items()
    }
    differing = F.array_compact(F.array(*(F.when(test, F.lit(c)) for c, test in unequal.items())))
    stored_rows = sum((F.col(f"{p}_stored_rows") for p in tables), F.lit(0).cast("bigint"))
    nothing = (F.col("audits") == 0) & (stored_rows == 0)
    same = (F.col("audits") == 1) & (F.size(differing) == 0)
    return state.select(
        F.when(nothing, "loaded").when(same, "database_noop").otherwise("conflict").alias("decision"),
        "audits", stored_rows.alias("stored_rows"), sum(announced.values(), F.lit(0).cast("bigint")).alias("expected_rows"),
        F.when(nothing, F.array().cast("array<string>")).otherwise(differing).alias("differing"),
    )
