"""Data-quality checks: a check is a query for violating rows; none means pass.

Row rules are predicates, so every rule over one relation is counted in a single
scan. Set rules are small DataFrame programs (grain, reconciliation, totals).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbmart.operators.relational import orphan_rows
from plumbmart.plans.relations import FOREIGN_KEYS, RELATIONS

Tables = Mapping[str, DataFrame]
REPORT = "assertion string, violations bigint"
# Violating rows may come counted: a row with this column stands for so many.
WEIGHT = "__violations"


class RowRule(NamedTuple):
    """Rows of ``relation`` for which ``violated()`` is true (NULL is a pass)."""

    relation: str
    violated: Callable[[], Column]

    @property
    def relations(self) -> tuple[str, ...]:
        return (self.relation,)


class SetRule(NamedTuple):
    """Violating rows computed from several relations or from aggregates, counted where they carry ``WEIGHT``."""

    relations: tuple[str, ...]
    violations: Callable[..., DataFrame]


Rule = RowRule | SetRule


class QualityFailure(RuntimeError):
    """A build stopped because named assertions returned rows."""

    def __init__(self, failures: Mapping[str, int]):
        self.failures = dict(failures)
        listed = ", ".join(f"{n} ({c} rows)" for n, c in sorted(failures.items()))
        super().__init__(f"violated: {listed}")


def violating_rows(rule: Rule, tables: Tables) -> DataFrame:
    if isinstance(rule, RowRule):
        return tables[rule.relation].where(rule.violated())
    return rule.violations(*(tables[name] for name in rule.relations))


def violations(rows: DataFrame) -> Column:
    """The number of violating rows, as an aggregate."""
    if WEIGHT in rows.columns:
        return F.coalesce(F.sum(WEIGHT), F.lit(0)).cast("bigint").alias("violations")
    return F.count(F.lit(1)).alias("violations")


def _counted(name: str, rows: DataFrame) -> DataFrame:
    return rows.agg(violations(rows)).select(
        F.lit(name).alias("assertion"), "violations"
    )


def _unpivot(counts: DataFrame, names: Iterable[str]) -> DataFrame:
    """One (name, number) row per column of a one-row relation."""
    pairs = [f"'{n}', `{n}`" for n in names]
    return counts.selectExpr(f"stack({len(pairs)}, {', '.join(pairs)}) as (assertion, violations)")


def assertion_report(rules: Mapping[str, Rule], tables: Tables) -> DataFrame:
    """One row per assertion with its number of violating rows."""
    parts: list[DataFrame] = []
    by_relation: dict[str, dict[str, RowRule]] = {}
    for name, rule in rules.items():
        if isinstance(rule, RowRule):
            by_relation.setdefault(rule.relation, {})[name] = rule
        else:
            parts.append(_counted(name, violating_rows(rule, tables)))
    for relation, group in by_relation.items():
        counts = tables[relation].agg(
            *(F.count_if(rule.violated()).alias(name) for name, rule in group.items())
        )
        parts.append(_unpivot(counts, group))
    return reduce(DataFrame.union, parts)


# -- generic checks from the relation declarations ------------------------------


def not_null_counts(relation: str, names: Iterable[str]) -> list[Column]:
    """NULLs in each of the named columns, as aggregates to take or to observe."""
    return [F.count_if(F.col(f"`{n}`").isNull()).alias(f"not_null:{relation}.{n}") for n in names]


def required(relation: str) -> list[str]:
    return [f.name for f in RELATIONS[relation] if f.required]


def column_report(relation: str, df: DataFrame, not_null: bool = True) -> DataFrame | None:
    """NULLs in required columns and values that a unique column repeats: one scan.

    Without unique columns that is one aggregation. With them a row gives one entry
    for each unique value and one for each NULL it should not have, and the entries
    of all checks are counted in the same grouped pass.
    """
    nulls = required(relation) if not_null else []
    unique = [f.name for f in RELATIONS[relation] if f.unique]
    names = [f"not_null:{relation}.{n}" for n in nulls] + [f"unique:{relation}.{n}" for n in unique]
    if not unique:
        return _unpivot(df.agg(*not_null_counts(relation, nulls)), names) if nulls else None

    def entry(kind: str, name: str, value: Column) -> Column:
        return F.struct(F.lit(f"{kind}:{relation}.{name}").alias("assertion"), value.alias("value"))

    cells = {n: F.col(f"`{n}`") for n in (*nulls, *unique)}
    entries = [F.when(cells[n].isNull(), entry("not_null", n, F.lit(None).cast("string"))) for n in nulls]
    entries += [F.when(cells[n].isNotNull(), entry("unique", n, cells[n].cast("string"))) for n in unique]
    found = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
    counted = found.groupBy("e.assertion", "e.value").agg(F.count(F.lit(1)).alias("n"))
    hits = F.when(F.col("value").isNull(), F.col("n")).otherwise((F.col("n") > 1).cast("long"))
    return _unpivot(
        counted.agg(*(F.coalesce(F.sum(F.when(F.col("assertion") == n, hits)), F.lit(0)).alias(n) for n in names)), names
    )


def relationship_report(tables: Tables) -> DataFrame | None:
    """Rows whose non-null foreign key is missing from the parent."""
    parts = []
    for child, child_col, parent, parent_col in FOREIGN_KEYS:
        if child in tables and parent in tables:
            orphans = orphan_rows(tables[child], tables[parent], [(child_col, parent_col)])
            parts.append(_counted(f"relationship:{child}.{child_col}", orphans))
    return reduce(DataFrame.union, parts) if parts else None


def generic_report(tables: Tables, observed: Iterable[str] = ()) -> DataFrame:
    """All declared not-null, unique and relationship checks of the tables given.

    The not-null checks of the ``observed`` relations are left out: they were
    counted while those relations were written.
    """
    known = set(observed)
    parts = [column_report(n, tables[n], n not in known) for n in RELATIONS if n in tables]
    parts.append(relationship_report(tables))
    return reduce(DataFrame.union, [p for p in parts if p is not None])


def failures(report: DataFrame) -> dict[str, int]:
    """Assertions with violations; the report has one row per assertion."""
    return {r.assertion: r.violations for r in report.where("violations > 0").collect()}


def require_clean(report: DataFrame | None, observed: Mapping[str, int] = {}) -> None:
    """Stop on violations in the report or among counts already observed."""
    found = {n: c for n, c in observed.items() if c}
    if report is not None:
        found |= failures(report)
    if found:
        raise QualityFailure(found)
