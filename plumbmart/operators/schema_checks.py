"""Schema contracts: observed columns against what a source or model must have."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISSUE = "code string, field string, message string"


class ContractError(ValueError):
    """A relation does not have the columns and types it declares."""


def enforce_contract(df: DataFrame, expected: T.StructType, relation: str) -> DataFrame:
    """``df`` itself when its names and types equal the contract; no casts."""
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if have != want:
        missing = sorted(set(want) - set(have))
        surplus = sorted(set(have) - set(want))
        raise ContractError(
            f"{relation}: expected but absent {missing}, present but undeclared {surplus}"
            + ("" if missing or surplus else ", columns out of order")
        )
    return df


def _issue(code: Column | str, field: Column, message: Column) -> Column:
    code = F.lit(code) if isinstance(code, str) else code
    return F.struct(code.alias("code"), field.alias("field"), message.alias("message"))


def schema_issues(
    observed: DataFrame,
    required: DataFrame,
    families: Mapping[str, Sequence[str]],
    *,
    noun: str = "column",
    ignore_case: bool = True,
) -> DataFrame:
    """Missing, repeated or wrongly typed required columns.

    ``observed`` has ``name`` and ``declared_type``; ``required`` has ``name``
    and ``family``; ``families`` lists the declared types each family accepts.
    """
    seen = observed.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.first("declared_type").alias("declared_type")
    )
    both = required.join(seen, "name", "left")
    declared = F.trim("declared_type")
    declared = F.upper(declared) if ignore_case else declared
    accepted = reduce(
        lambda a, b: a | b,
        ((F.col("family") == f) & declared.isin(*types) for f, types in families.items()),
    )
    code = (
        F.when(F.col("n").isNull(), f"missing_required_{noun}")
        .when(F.col("n") > 1, f"duplicate_required_{noun}")
        .when(~accepted, "incompatible_required_type")
    )
    message = F.concat_ws(" ", F.lit("declared type"), declared, F.lit("expected"), F.col("family"))
    return (
        both.select(code.alias("code"), F.col("name").alias("field"), message.alias("message"))
        .where(F.col("code").isNotNull())
        .withColumn("message", F.when(F.col("code") == "incompatible_required_type", F.col("message"))
                    .otherwise(F.concat_ws(": ", "code", "field")))
    )


def additive_columns(observed: DataFrame, required: DataFrame) -> DataFrame:
    """Observed names the contract does not ask for; tolerated but reported."""
    return observed.select("name").distinct().join(required.select("name"), "name", "left_anti")


def identity_issues(observed: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Layer identity of a one-row metadata relation, each field as text."""
    hits = [
        F.when(
            ~F.col(name).cast("string").eqNullSafe(F.lit(value)),
            _issue(
                f"unexpected_{name}", F.lit(name),
                F.concat(F.lit(f"expected {value}, found "),
                         F.coalesce(F.col(name).cast("string"), F.lit("nothing"))),
            ),
        )
        for name, value in expected.items()
    ]
    return observed.select(F.explode(F.array_compact(F.array(*hits))).alias("i")).select("i.*")


def api_schema_issues(observed: DataFrame, required: DataFrame) -> DataFrame:
    """Published API fields against the required field-to-header mapping.

    ``observed`` has ``api_field``, ``header``, ``declared_type``; ``required``
    has ``semantic``, ``api_field``, ``header``.
    """
    seen = observed.groupBy("api_field").agg(
        F.count(F.lit(1)).alias("n"),
        F.first("header").alias("seen_header"),
        F.first("declared_type").alias("seen_type"),
    )
    headers = observed.groupBy("header").agg(F.count(F.lit(1)).alias("header_n"))
    both = required.join(seen, "api_field", "left").join(headers, "header", "left")
    once = F.col("n") == 1
    text = F.lower(F.trim("seen_type")) == "text"
    field = F.col("semantic")
    hits = [
        F.when(F.col("n").isNull(),
               _issue("missing_required_api_field", field, F.col("api_field"))),
        F.when(F.col("n") > 1,
               _issue("duplicate_required_api_field", field, F.col("api_field"))),
        F.when(once & (F.col("seen_header") != F.col("header")),
               _issue("incompatible_api_csv_mapping", field, F.col("seen_header"))),
        F.when(once & ~text,
               _issue("incompatible_api_transport_type", field, F.col("seen_type"))),
        F.when(once & (F.coalesce("header_n", F.lit(0)) != 1),
               _issue("ambiguous_required_csv_header", field, F.col("header"))),
    ]
    governed = both.select(F.explode(F.array_compact(F.array(*hits))).alias("i")).select("i.*")
    repeated = (
        headers.where("header_n > 1")
        .join(required.select("header"), "header", "left_anti")
        .select(F.lit("duplicate_additive_csv_header").alias("code"),
                F.col("header").alias("field"), F.col("header").alias("message"))
    )
    return governed.union(repeated)


def additive_headers(observed: DataFrame, required: DataFrame) -> DataFrame:
    """Headers of API fields the mapping does not ask for."""
    return observed.join(required.select("api_field"), "api_field", "left_anti").select("header")


def mapping_issues(
    observed: DataFrame,
    expected: DataFrame,
    key: str,
    attributes: Mapping[str, str],
    targets: Mapping[str, str] | None = None,
) -> DataFrame:
    """Drift between an observed and an expected mapping, one row per difference.

    ``attributes`` maps each compared column to the issue code its change gets;
    ``targets`` names columns whose values may be used by one mapping only.
    Repeated targets are reported alone, since comparing them would be noise.
    """
    def repeated(column: str, code: str) -> DataFrame:
        return (
            observed.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.lit(code).alias("code"), F.col(column).alias("field"),
                    F.lit("appears more than once").alias("message"))
        )

    missing = expected.join(observed, key, "left_anti").select(
        F.lit("missing_required_mapping").alias("code"), F.col(key).alias("field"),
        F.lit("mapping is missing").alias("message"),
    )
    found = missing.union(repeated(key, "duplicate_semantic_mapping"))
    clashes = [repeated(c, code) for c, code in (targets or {}).items()]
    names = list(attributes)
    pairs = observed.select(key, F.struct(*names).alias("seen")).join(
        expected.select(key, F.struct(*names).alias("want")), key
    )
    hits = [
        F.when(
            ~F.col(f"seen.{n}").eqNullSafe(F.col(f"want.{n}")),
            _issue(code, F.col(key), F.concat(
                F.lit("found "), F.coalesce(F.col(f"seen.{n}").cast("string"), F.lit("nothing")),
                F.lit("; expected "), F.coalesce(F.col(f"want.{n}").cast("string"), F.lit("nothing")),
            )),
        )
        for n, code in attributes.items()
    ]
    changed = pairs.select(F.explode(F.array_compact(F.array(*hits))).alias("i")).select("i.*")
    if clashes:
        clash = reduce(DataFrame.union, clashes)
        clash_count = clash.agg(F.count(F.lit(1))).scalar()
        changed = changed.where(clash_count == 0)
        found = found.union(clash)
    return found.union(changed)
