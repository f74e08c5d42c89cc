"""The mart's models, what each reads, and a build that stops on a failed check."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation

from plumbmart.operators.schema_checks import enforce_contract
from plumbmart.plans import core, quality, screening, staging
from plumbmart.plans.assertions import ASSERTIONS
from plumbmart.plans.relations import RELATIONS, schema
from plumbmart.session import materialise
from plumbmart.sources import contracts as C


class Model(NamedTuple):
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    stored: bool
    partition_by: tuple[str, ...] = ()
    # The stored model of which this one is a plain projection, row for row.
    projects: str | None = None


_MEDICARE, _SVI, _FACILITY = (f"raw.{s}" for s in (C.MEDICARE, C.VULNERABILITY, C.FACILITY))

# In dependency order. Stored models are written once, by year where later models
# read one year; the others are plain plans over the stored ones.
MODELS: dict[str, Model] = {
    "stg_cms_om_gv_county_year": Model(
        (_MEDICARE,), staging.stg_cms_om_gv_county_year, True, ("year",)
    ),
    "stg_cms_om_gv_benchmark_year": Model(
        (_MEDICARE,), staging.stg_cms_om_gv_benchmark_year, True, ("year",)
    ),
    "stg_cdc_svi_county_2022": Model((_SVI,), staging.stg_cdc_svi_county_2022, True),
    "stg_cms_dialysis_facility": Model((_FACILITY,), staging.stg_cms_dialysis_facility, True),
    "dim_county": Model(
        ("stg_cdc_svi_county_2022", "stg_cms_om_gv_county_year", "historical_county_identities"),
        core.dim_county, True,
    ),
    "dim_year": Model(
        ("stg_cms_om_gv_county_year", "stg_cms_om_gv_benchmark_year"), core.dim_year, False
    ),
    "dim_facility": Model(("stg_cms_dialysis_facility",), core.dim_facility, False),
    "fct_medicare_county_year": Model(
        ("stg_cms_om_gv_county_year",), core.fct_medicare_county_year, False,
        projects="stg_cms_om_gv_county_year",
    ),
    "fct_medicare_benchmark_year": Model(
        ("stg_cms_om_gv_benchmark_year",), core.fct_medicare_benchmark_year, False,
        projects="stg_cms_om_gv_benchmark_year",
    ),
    "fct_svi_county": Model(
        ("stg_cdc_svi_county_2022",), core.fct_svi_county, False, projects="stg_cdc_svi_county_2022"
    ),
    "fct_facility_quality_snapshot": Model(
        ("stg_cms_dialysis_facility",), core.fct_facility_quality_snapshot, False,
        projects="stg_cms_dialysis_facility",
    ),
    "audit_cms_svi_county_reconciliation": Model(
        ("fct_medicare_county_year", "fct_svi_county"),
        core.audit_cms_svi_county_reconciliation, True,
    ),
    "int_county_screening_threshold": Model(
        ("raw.build_input_audit", "dim_year", "dim_county", "fct_medicare_county_year",
         "fct_svi_county"),
        screening.int_county_screening_threshold, True,
    ),
    "mart_county_screening": Model(
        ("int_county_screening_threshold", "dim_county", "fct_medicare_county_year",
         "fct_svi_county", "audit_cms_svi_county_reconciliation"),
        screening.mart_county_screening, True,
    ),
    "audit_screening_quadrant_summary": Model(
        ("int_county_screening_threshold", "mart_county_screening"),
        screening.audit_screening_quadrant_summary, True,
    ),
}


def with_ancestors(names: Iterable[str]) -> list[str]:
    """The named models and every model they read, in build order."""
    wanted = set(names)
    for name in reversed(MODELS):
        if name in wanted:
            wanted |= set(MODELS[name].inputs)
    return [n for n in MODELS if n in wanted]


def with_descendants(names: Iterable[str]) -> list[str]:
    """The named relations' models and every model that reads them."""
    reached = set(names)
    for name, model in MODELS.items():
        if reached & set(model.inputs):
            reached.add(name)
    return [n for n in MODELS if n in reached]


def assertions_for(relations: Iterable[str]) -> dict[str, quality.Rule]:
    """Assertions whose relations are all among those given."""
    have = set(relations)
    return {n: r for n, r in ASSERTIONS.items() if have.issuperset(r.relations)}


def plan(raw: Mapping[str, DataFrame], select: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Lazily defined relations: the raw inputs plus the selected models."""
    tables = dict(raw)
    for name in with_ancestors(MODELS if select is None else select):
        model = MODELS[name]
        tables[name] = model.build(*(tables[i] for i in model.inputs))
    return tables


def projected_columns(name: str, selected: Iterable[str]) -> dict[str, list[str]]:
    """The required columns of a stored model and of the selected models that project it."""
    models = [name, *(n for n in selected if MODELS[n].projects == name)]
    return {n: quality.required(n) for n in models}


def build(
    raw: Mapping[str, DataFrame],
    *,
    select: Iterable[str] | None = None,
    exclude: Iterable[str] = (),
    check: bool = True,
    store: Callable[..., DataFrame] = materialise,
) -> dict[str, DataFrame]:
    """Build the selected models, checking each as soon as it can be checked.

    A model that ``raw`` already holds is taken as it is.

    An assertion runs once all of its relations exist, so a broken input stops
    the build by the assertion's name before any model depends on it. Declared
    not-null checks of a stored model, and of the models that project it, are
    observed while it is written and read nothing again.

    ``store(relation, name, partition_by)`` writes a model; with checks it also
    gets ``watch``, a function of the written rows (see ``materialise``).
    """
    tables = dict(raw)
    skipped = set(with_descendants(exclude)) | set(exclude)
    selected = [n for n in with_ancestors(MODELS if select is None else select) if n not in skipped and n not in tables]
    done: set[str] = set()
    observed: set[str] = set()

    def verify(counts: Mapping[str, int] = {}) -> None:
        due = {n: r for n, r in assertions_for(tables).items() if n not in done}
        done.update(due)
        if check:
            quality.require_clean(quality.assertion_report(due, tables) if due else None, counts)

    def observing(relation: DataFrame, name: str) -> tuple[DataFrame, dict[str, int]]:
        """Store a model and count what its not-null checks find on the way."""
        wanted = projected_columns(name, selected)
        watched = Observation()
        counts = [c for n, columns in wanted.items() for c in quality.not_null_counts(n, columns)]
        stored = store(relation, name, MODELS[name].partition_by, watch=lambda rows: rows.observe(watched, *counts))
        observed.update(wanted)
        # An empty relation may be planned away with its metrics.
        return stored, dict(watched.get or {})

    verify()
    for name in selected:
        model = MODELS[name]
        relation = enforce_contract(
            model.build(*(tables[i] for i in model.inputs)), schema(name), name
        )
        counts: Mapping[str, int] = {}
        if not model.stored:
            tables[name] = relation
        elif check:
            tables[name], counts = observing(relation, name)
        else:
            tables[name] = store(relation, name, model.partition_by)
        verify(counts)
    if check:
        declared = {n: t for n, t in tables.items() if n in RELATIONS}
        quality.require_clean(quality.generic_report(declared, observed))
    return tables
