"""Declared columns of every relation: name, type, required, unique.

The declarations drive the schema contract check, the not-null and uniqueness
checks and the foreign-key checks, so each is stated once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

from plumbmart.sources import contracts as C


class Field(NamedTuple):
    name: str
    type: str
    required: bool = False
    unique: bool = False


def _fields(type_: str, *names: str, required: bool = True, unique: bool = False):
    return [Field(n, type_, required, unique) for n in names]


def _text(*names, **kw):
    return _fields("string", *names, **kw)


def _int(*names, **kw):
    return _fields("int", *names, **kw)


def _long(*names, **kw):
    return _fields("bigint", *names, **kw)


def _flag(*names, **kw):
    return _fields("boolean", *names, **kw)


def _optional(*names, type_="string"):
    return _fields(type_, *names, required=False)


MEDICARE_LINEAGE = _text(*C.MEDICARE_LINEAGE[:4]) + _optional("source_modified_at")
SNAPSHOT_LINEAGE = _text(*C.SNAPSHOT_LINEAGE[:4]) + _optional("source_modified_at")
FACILITY_LINEAGE = _text(*C.FACILITY_LINEAGE[:4]) + _optional(*C.FACILITY_LINEAGE[4:])


def _medicare_values(raw: bool) -> list[Field]:
    out: list[Field] = []
    for name, kind, _ in C.MEDICARE_METRICS:
        out += _text(f"{name}_raw") if raw else []
        out += _optional(name, type_="decimal(38,0)" if kind == "count" else "decimal(38,10)")
        out += _text(f"{name}_status")
    return out


def _scores(raw: bool) -> list[Field]:
    out: list[Field] = []
    for name in C.VULNERABILITY_METRICS:
        out += _optional(f"{name}_raw") if raw else []
        out += _optional(name, type_="decimal(18,10)") + _text(f"{name}_status")
    return out


def _star(raw: bool) -> list[Field]:
    out = _optional("five_star_period_raw") if raw else []
    out += _optional("five_star_period_start", "five_star_period_end", type_="date")
    out += _optional("five_star_rating_raw") if raw else []
    out += _optional("five_star_rating", type_="int")
    out += _text("five_star_availability_code", "five_star_availability_status")
    return out + _optional("five_star_unavailability_reason")


def _outcome(family: str, raw: bool) -> list[Field]:
    out = _optional(f"{family}_period_raw") if raw else []
    out += _optional(f"{family}_period_start", f"{family}_period_end", type_="date")
    out += _text(f"{family}_availability_code", f"{family}_availability_status")
    out += _optional(f"{family}_unavailability_reason")
    for role, type_ in (
        ("category", "string"),
        ("denominator", "bigint"),
        ("estimate", "decimal(18,10)"),
        ("lower_confidence_limit", "decimal(18,10)"),
        ("upper_confidence_limit", "decimal(18,10)"),
    ):
        out += _optional(f"{family}_{role}_raw") if raw else []
        out += _optional(f"{family}_{role}", type_=type_)
    return out


def _facility_stage() -> list[Field]:
    out = _text("ccn", unique=True) + _text("facility_name")
    out += _optional(*(n for n, _ in C.FACILITY_IDENTITY[2:]))
    out += _optional("chain_owned_raw") + _optional("chain_owned", type_="boolean")
    out += _optional("chain_organization", "dialysis_stations_raw")
    out += _optional("dialysis_stations", type_="int")
    for name, _ in C.FACILITY_YES_NO[1:]:
        out += _optional(f"{name}_raw") + _optional(name, type_="boolean")
    out += _optional("certification_date_raw") + _optional("certification_date", type_="date")
    out += _star(True)
    for family in C.FAMILIES:
        out += _outcome(family, True)
    return out + FACILITY_LINEAGE


def _audit_source(prefix: str, hash_name: str, required: bool) -> list[Field]:
    return _fields(
        "string",
        *(f"{prefix}_{n}" for n in
          ("source_id", "manifest_run_id", "contract_version", hash_name, "retrieved_at_utc")),
        required=required,
    ) + _fields("bigint", f"{prefix}_page_count", f"{prefix}_row_count", required=required)


_GEO = _text(
    "source_geography_level",
    "source_geography_description",
    "source_geography_code",
    "source_age_level",
)
_SVI_PERIOD = _int("svi_vintage", "acs_period_start", "acs_period_end")
_SCREENING_KEYS = ("screening_definition_version", "screening_run_id", "input_set_sha256")

RELATIONS: dict[str, list[Field]] = {
    "raw.build_input_audit": (
        _int("build_format_version")
        + _text("build_id", "input_set_sha256", unique=True)
        + _audit_source("cms", "content_sha256", True)
        + _audit_source("svi", "snapshot_sha256", True)
        + _audit_source("facility", "snapshot_sha256", False)
    ),
    "historical_county_identities": (
        _optional(
            "county_fips", "state_fips", "state_name", "state_abbreviation", "county_name",
            "source_geography_description",
        )
        + _optional("observed_cms_start_year", "observed_cms_end_year", type_="int")
        + _optional("geography_status")
        + _optional("is_current_county", type_="boolean")
        + _optional("boundary_discontinuity_warning", "seed_version")
    ),
    "stg_cms_om_gv_county_year": (
        _text("county_fips", "county_geography_mapping_method")
        + _int("year") + _GEO + _medicare_values(True) + MEDICARE_LINEAGE
    ),
    "stg_cms_om_gv_benchmark_year": (
        _text("benchmark_geography_type", "benchmark_geography_key")
        + _int("year") + _GEO + _medicare_values(True) + MEDICARE_LINEAGE
    ),
    "stg_cdc_svi_county_2022": (
        _text("county_fips", "state_fips", "state_name", "state_abbreviation", "county_name")
        + _int("source_object_id") + _SVI_PERIOD + _scores(True) + SNAPSHOT_LINEAGE
        + _long("source_page_index", "source_page_offset") + _text("source_page_sha256")
    ),
    "stg_cms_dialysis_facility": _facility_stage(),
    "dim_county": (
        _text("county_fips", unique=True)
        + _text("state_fips", "state_name", "state_abbreviation", "county_name",
                "geography_status")
        + _flag("is_current_county")
        + _optional("svi_geography_vintage", "observed_cms_start_year",
                    "observed_cms_end_year", type_="int")
        + _optional("boundary_discontinuity_warning")
        + _text("geography_source_id", "geography_source_version",
                "geography_source_manifest_run_id")
        + _optional("geography_source_snapshot_sha256")
    ),
    "dim_year": _int("year", unique=True) + _flag("is_latest_cms_year"),
    "dim_facility": (
        _text("ccn", unique=True) + _text("facility_name")
        + _optional(*(n for n, _ in C.FACILITY_IDENTITY[2:]))
        + _optional("chain_owned", type_="boolean") + _optional("chain_organization")
        + _optional("dialysis_stations", type_="int")
        + _optional(*(n for n, _ in C.FACILITY_YES_NO[1:]), type_="boolean")
        + _optional("certification_date", type_="date")
        + _optional("county_fips") + _text("geography_match_status")
        + _optional("geography_match_method")
        + _optional("geography_resolution_date", type_="date")
        + _text("geography_provenance") + FACILITY_LINEAGE
    ),
    "fct_medicare_county_year": (
        _text("county_fips") + _int("year") + _text("county_geography_mapping_method")
        + _medicare_values(False) + MEDICARE_LINEAGE
    ),
    "fct_medicare_benchmark_year": (
        _text("benchmark_geography_type", "benchmark_geography_key") + _int("year")
        + _text("source_geography_description", "source_geography_code")
        + _medicare_values(False) + MEDICARE_LINEAGE
    ),
    "fct_svi_county": (
        _text("county_fips") + _SVI_PERIOD + _scores(False) + SNAPSHOT_LINEAGE
    ),
    "fct_facility_quality_snapshot": (
        _text("ccn", "source_snapshot_sha256") + _star(False)
        + [f for family in C.FAMILIES for f in _outcome(family, False)]
        + _text("source_id", "source_manifest_run_id", "source_retrieved_at_utc")
        + _optional("source_release", "source_modified_at")
    ),
    "audit_cms_svi_county_reconciliation": (
        _text("county_fips", unique=True) + _text("reconciliation_status")
        + _flag("cms_present", "svi_present") + _long("cms_row_count", "svi_row_count")
        + _int("cms_latest_year")
        + _text("cms_source_manifest_run_id", "cms_source_content_sha256")
        + _optional("cms_source_modified_at") + _int("svi_vintage")
        + _text("svi_source_manifest_run_id", "svi_source_snapshot_sha256")
        + _optional("svi_source_modified_at")
    ),
    "int_county_screening_threshold": (
        _text(*_SCREENING_KEYS, unique=True)
        + _int("build_format_version", "cms_year", "svi_vintage")
        + _text("threshold_metric") + _fields("decimal(3,2)", "threshold_quantile")
        + _text("threshold_method")
        + _fields("decimal(38,10)", "dialysis_use_p75_threshold")
        + _long("current_county_count", "threshold_eligible_count", "threshold_excluded_count")
        + _text("cms_source_manifest_run_id", "cms_source_content_sha256",
                "cms_source_retrieved_at_utc")
        + _optional("cms_source_modified_at")
        + _text("svi_source_manifest_run_id", "svi_source_snapshot_sha256",
                "svi_source_retrieved_at_utc")
        + _optional("svi_source_modified_at")
    ),
    "mart_county_screening": (
        _text(*_SCREENING_KEYS) + _text("county_fips", unique=True)
        + _text("state_fips", "state_name", "state_abbreviation", "county_name",
                "geography_status")
        + _optional("boundary_discontinuity_warning") + _text("reconciliation_status")
        + _long("cms_reconciliation_row_count", "svi_reconciliation_row_count")
        + _int("cms_year") + _SVI_PERIOD
        + _optional("benes_om_cnt", type_="decimal(38,0)") + _text("benes_om_cnt_status")
        + _optional("benes_op_dlys_pct", type_="decimal(38,10)")
        + _text("benes_op_dlys_pct_status")
        + _fields("decimal(38,10)", "dialysis_use_p75_threshold")
        + _long("threshold_eligible_count") + _flag("is_dialysis_use_threshold_eligible")
        + _optional("is_higher_observed_dialysis_use", type_="boolean")
        + _text("dialysis_use_band")
        + _optional("rpl_themes", type_="decimal(18,10)") + _text("rpl_themes_status")
        + _optional("is_higher_social_vulnerability", type_="boolean")
        + _text("social_vulnerability_band", "screening_data_status")
        + _optional("screening_insufficient_reason") + _text("screening_quadrant")
        + _text("cms_source_manifest_run_id", "cms_source_content_sha256",
                "cms_source_retrieved_at_utc")
        + _optional("cms_source_modified_at")
        + _text("svi_source_manifest_run_id", "svi_source_snapshot_sha256",
                "svi_source_retrieved_at_utc")
        + _optional("svi_source_modified_at")
    ),
    "audit_screening_quadrant_summary": (
        _text(*_SCREENING_KEYS) + _int("cms_year", "svi_vintage")
        + _int("category_display_order", unique=True)
        + _text("screening_quadrant", unique=True)
        + _long("screening_row_count", "total_screening_row_count", "complete_data_count",
                "insufficient_data_count", "higher_use_count", "lower_use_count",
                "higher_vulnerability_count", "lower_vulnerability_count")
        + _fields("decimal(38,10)", "dialysis_use_p75_threshold")
        + _long("threshold_eligible_count", "threshold_excluded_count")
        + _text("cms_source_manifest_run_id", "cms_source_content_sha256",
                "svi_source_manifest_run_id", "svi_source_snapshot_sha256")
    ),
}

# (child relation, child column, parent relation, parent column)
FOREIGN_KEYS = (
    ("mart_county_screening", "county_fips", "dim_county", "county_fips"),
    ("fct_svi_county", "county_fips", "dim_county", "county_fips"),
    ("fct_medicare_county_year", "year", "dim_year", "year"),
    ("fct_medicare_benchmark_year", "year", "dim_year", "year"),
    ("fct_facility_quality_snapshot", "ccn", "dim_facility", "ccn"),
)


def columns(relation: str) -> list[str]:
    return [f.name for f in RELATIONS[relation]]


def schema(relation: str) -> T.StructType:
    return T.StructType.fromDDL(
        ", ".join(f"`{f.name}` {f.type}" for f in RELATIONS[relation])
    )
