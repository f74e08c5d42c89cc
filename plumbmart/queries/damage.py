"""A damage for every assertion on the mart of the benchmark tables, for Spark and in SQL.

Conditions hold for a share of the rows at every size. A damage is stated once; the
assertions' SQL that counts after it is ``assertion_sql``'s.
"""

from __future__ import annotations

from plumbmart.plans.damage import ADD, CHANGE, DROP, Damage
from plumbmart.plans.relations import RELATIONS
from plumbmart.queries import assertion_sql
from plumbmart.queries.oracle import with_relations

B, FC, FB = "raw.build_input_audit", "fct_medicare_county_year", "fct_medicare_benchmark_year"
SC, SB = "stg_cms_om_gv_county_year", "stg_cms_om_gv_benchmark_year"
SS, SF = "stg_cdc_svi_county_2022", "stg_cms_dialysis_facility"
FS, FF = "fct_svi_county", "fct_facility_quality_snapshot"
M, T, Q = "mart_county_screening", "int_county_screening_threshold", "audit_screening_quadrant_summary"
_EVEN = "year % 2 = 0"
_FIPS = "right(county_fips, 1) = '3'"
_CCN = "right(ccn, 1) in ('1', '2')"


def _cell(relation: str, column: str, value: str, where: str = "true") -> Damage:
    return Damage(relation, CHANGE, where, column, value)


DAMAGES: dict[str, Damage] = {
    "build_input_audit_singleton": Damage(B, ADD),
    "build_input_lineage_reconciles_facts": _cell(B, "cms_content_sha256", "repeat('0', 64)"),
    "cms_benchmark_fact_grain_unique": Damage(FB, ADD, _EVEN),
    "cms_benchmark_fact_reconciles_stage": _cell(FB, "benes_om_cnt", "1", _EVEN),
    "cms_benchmark_grain_unique": Damage(SB, ADD, _EVEN),
    "cms_benchmark_numeric_values_valid": _cell(SB, "bene_dual_pct_status", "'invalid_numeric'"),
    "cms_benchmark_scope": _cell(SB, "benchmark_geography_key", "'ZZ'", "benchmark_geography_type = 'state'"),
    "cms_county_fact_geography_resolves": Damage("dim_county", DROP, _FIPS),
    "cms_county_fact_grain_unique": Damage(FC, ADD, _EVEN),
    "cms_county_fact_reconciles_stage": Damage(FC, DROP, _EVEN),
    "cms_county_fips_valid": _cell(SC, "county_fips", "'ABCDE'", _EVEN),
    "cms_county_scope": _cell(SC, "source_age_level", "'<65'", _EVEN),
    "cms_county_year_unique": Damage(SC, ADD, _EVEN),
    "cms_dc_county_equivalent_unambiguous": Damage(
        SC, ADD, "county_fips = '11001'", "county_geography_mapping_method", "'source_county_fips'"),
    "cms_dialysis_users_not_above_beneficiaries": _cell(FC, "benes_op_dlys_cnt", "2000000000"),
    "cms_fact_lineage_constant": _cell(FB, "source_manifest_run_id", "'other'", _EVEN),
    "cms_fact_metric_bounds_and_status": _cell(FC, "ma_prtcptn_rate", "1.5", _EVEN),
    "cms_lineage_present": _cell(SC, "source_manifest_run_id", "' '", _EVEN),
    "cms_numeric_values_valid": _cell(SC, "benes_op_dlys_pct_status", "'invalid_numeric'", _EVEN),
    "cms_stage_reconciles_selected_raw": Damage(SC, DROP, _EVEN),
    "dim_year_has_one_latest": _cell("dim_year", "is_latest_cms_year", "true"),
    "dim_year_reconciles_facts": _cell("dim_year", "year", "year + 100", _EVEN),
    "cms_svi_latest_current_reconciled": _cell(
        "audit_cms_svi_county_reconciliation", "reconciliation_status", "'svi_only'"),
    "dim_county_geography_valid": _cell("dim_county", "state_fips", "'60'", "is_current_county"),
    "historical_county_identities_do_not_overlap_current": _cell(
        "historical_county_identities", "county_fips", "'11001'"),
    "svi_county_fips_unique": Damage(SS, ADD, _FIPS),
    "svi_county_fips_valid": _cell(SS, "source_object_id", "0", _FIPS),
    "svi_fact_grain_unique": Damage(FS, ADD, _FIPS),
    "svi_fact_reconciles_stage": _cell(FS, "ep_age65_status", "'unknown'", _FIPS),
    "svi_lineage_present": _cell(SS, "svi_vintage", "2020", _FIPS),
    "svi_numeric_values_valid": _cell(SS, "rpl_themes_status", "'unavailable_null'", _FIPS),
    "svi_percentage_bounds": _cell(SS, "ep_noveh", "101", _FIPS),
    "svi_rank_bounds": _cell(SS, "rpl_theme2", "1.25", _FIPS),
    "svi_stage_reconciles_raw": Damage(SS, DROP, _FIPS),
    "facility_availability_codes_valid": _cell(SF, "readmission_availability_status", "'invalid'", _CCN),
    "facility_characteristics_valid": _cell(SF, "dialysis_stations", "null", _CCN),
    "facility_confidence_intervals_valid": _cell(SF, "survival_lower_confidence_limit", "99", _CCN),
    "facility_fact_grain_unique": Damage(FF, ADD, _CCN),
    "facility_fact_reconciles_stage": Damage("dim_facility", DROP, _CCN),
    "facility_five_star_valid": _cell(SF, "five_star_rating", "6", _CCN),
    "facility_geography_deferred": _cell("dim_facility", "county_fips", "'11001'", _CCN),
    "facility_periods_valid": _cell(SF, "hospitalization_period_end", "date '1999-01-01'", _CCN),
    "facility_quality_companions_complete": _cell(SF, "survival_upper_confidence_limit", "null", _CCN),
    "facility_stage_reconciles_raw": Damage(SF, DROP, _CCN),
    "screening_classification_consistent": _cell(M, "is_higher_observed_dialysis_use", "null"),
    "screening_latest_year_singular": _cell(T, "cms_year", "cms_year - 1"),
    "screening_national_threshold_fixed": _cell(M, "dialysis_use_p75_threshold", "0.02", _FIPS),
    "screening_reconciles_facts_and_lineage": _cell(M, "rpl_themes", "0.1", _FIPS),
    "screening_row_count_reconciles": Damage(M, DROP, _FIPS),
    "screening_rows_current_and_reconciled": _cell(M, "svi_reconciliation_row_count", "2", _FIPS),
    "screening_summary_reconciles": _cell(Q, "screening_row_count", "-1", "category_display_order = 1"),
    "screening_threshold_valid": _cell(T, "dialysis_use_p75_threshold", "1.2"),
}

#: Names in SQL of relations that are no models.
SQL_NAMES = {B: "raw_audit", "historical_county_identities": "historical"}


def _damaged_sql(damage: Damage, source: str) -> str:
    rows = f"select * from {source}"
    if damage.kind == DROP:
        return f"{rows} where not coalesce({damage.where}, false)"
    if damage.column:
        kind = next(f.type for f in RELATIONS[damage.relation] if f.name == damage.column)
        changed = (f"select * replace (case when {damage.where} then cast({damage.value} as {kind})"
                   f" else {damage.column} end as {damage.column}) from {source}")
        if damage.kind == CHANGE:
            return changed
        return f"{rows} union all {changed} where {damage.where}"
    return f"{rows} union all {rows} where {damage.where}"


def damage_sql() -> str:
    """One row for each assertion: what it finds after its own damage."""
    needed = {r for relations, _ in assertion_sql.SQL.values() for r in relations}
    names = {d.relation: SQL_NAMES.get(d.relation, d.relation) for d in DAMAGES.values()}
    intact = "".join(f",\nintact_{n} as (select * from {n})" for n in names.values())
    parts = []
    for assertion, damage in DAMAGES.items():
        name = names[damage.relation]
        parts.append(
            f"select '{assertion}' as assertion, '{damage.relation}' as damaged, count(*) as violations from"
            f" (with {name} as ({_damaged_sql(damage, f'intact_{name}')})"
            f" select * from ({assertion_sql.SQL[assertion][1]}) as rows_found) as found"
        )
    return with_relations(needed | set(names.values()), intact + "\n" + "\nunion all ".join(parts))
