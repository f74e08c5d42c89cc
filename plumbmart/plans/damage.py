"""Damages to relations, one for each assertion, and what the assertions find in them.

A damage is a statement about rows (a condition, a column, a value), so the same
one can be put on the sample tables, on a finished mart, or written in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbmart.plans.quality import RowRule, Rule, Tables, violating_rows, violations

CHANGE, ADD, DROP = "change", "add", "drop"
WORLD = "__world"


class Damage(NamedTuple):
    """Rows of ``relation`` under ``where`` are changed, come a second time (changed, if a column is named), or go."""

    relation: str
    kind: str
    where: str = "true"
    column: str | None = None
    value: str = "null"


def _hit(damage: Damage) -> Column:
    return F.coalesce(F.expr(damage.where), F.lit(False))


def worlds(df: DataFrame, damages: Mapping[str, Damage]) -> DataFrame:
    """A damaged copy of ``df`` for each damage, named in the column ``__world``, in one scan.

    A row is emitted once for every world that has it; what a world changes is
    computed from the row as it was.
    """
    entries = []
    for name, damage in damages.items():
        hit = _hit(damage)
        kept = F.struct(F.lit(name).alias("name"), F.lit(damage.kind == CHANGE).alias("changed"))
        entries.append(F.when(~hit, kept) if damage.kind == DROP else kept)
        if damage.kind == ADD:
            entries.append(F.when(hit, F.struct(F.lit(name).alias("name"), F.lit(True).alias("changed"))))
    copies = df.select("*", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias(WORLD))
    cells = {}
    for name, damage in damages.items():
        if damage.column:
            at = F.col(f"{WORLD}.changed") & (F.col(f"{WORLD}.name") == name) & _hit(damage)
            old = cells.get(damage.column, F.col(f"`{damage.column}`"))
            cells[damage.column] = F.when(at, F.expr(damage.value).cast(df.schema[damage.column].dataType)).otherwise(old)
    columns = [cells.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns]
    return copies.select(*columns, F.col(f"{WORLD}.name").alias(WORLD))


def damaged(df: DataFrame, damage: Damage) -> DataFrame:
    """``df`` with one damage."""
    return worlds(df, {"": damage}).drop(WORLD)


def damage_report(rules: Mapping[str, Rule], damages: Mapping[str, Damage], tables: Tables) -> DataFrame:
    """(assertion, damaged, violations): what each assertion finds after its own damage.

    All row rules over one relation are counted over its worlds in one scan; a rule
    over several rows or relations is a plan of its own over the damaged relation.
    """
    parts = []
    together: dict[str, list[str]] = {}
    for name, rule in rules.items():
        relation = damages[name].relation
        if isinstance(rule, RowRule) and rule.relation == relation:
            together.setdefault(relation, []).append(name)
            continue
        rows = violating_rows(rule, {**tables, relation: damaged(tables[relation], damages[name])})
        parts.append(rows.agg(violations(rows)).select(
            F.lit(name).alias("assertion"), F.lit(relation).alias("damaged"), "violations"))
    for relation, names in together.items():
        copies = worlds(tables[relation], {n: damages[n] for n in names})
        counts = copies.agg(*(
            F.count_if((F.col(WORLD) == n) & rules[n].violated()).alias(n) for n in names))
        pairs = ", ".join(f"'{n}', `{n}`" for n in names)
        parts.append(counts.selectExpr(f"stack({len(names)}, {pairs}) as (assertion, violations)").select(
            "assertion", F.lit(relation).alias("damaged"), "violations"))
    return reduce(DataFrame.union, parts)
