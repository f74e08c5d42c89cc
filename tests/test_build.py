from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbmart.operators import mutation as mu
from plumbmart.operators.evidence import table_checksum
from plumbmart.plans import quality
from plumbmart.plans.assertions import ASSERTIONS
from plumbmart.plans.build import MODELS, assertions_for, build, plan, with_ancestors, with_descendants
from plumbmart.plans.relations import RELATIONS
from plumbmart.sources import contracts as C
from samples import FACILITIES, PAGES, SCREENING_ROWS, facility_row, medicare_row, raw_sources

SCREENING = ("int_county_screening_threshold", "mart_county_screening", "audit_screening_quadrant_summary")


@pytest.fixture(scope="module")
def raw(spark, folder):
    return raw_sources(spark, f"{folder}/clean")


@pytest.fixture(scope="module")
def mart(raw):
    """A clean build: every assertion and every declared check has to pass."""
    return build(raw)


def test_clean_build_goldens(mart):
    counts = {n: mart[n].count() for n in (
        "dim_year", "dim_county", "fct_medicare_county_year", "fct_medicare_benchmark_year",
        "audit_cms_svi_county_reconciliation", "dim_facility")}
    assert list(counts.values()) == [2, 14, 4, 6, 3, 3]
    recon = mart["audit_cms_svi_county_reconciliation"].collect()
    assert {r.reconciliation_status for r in recon} == {"matched"}
    t = mart["int_county_screening_threshold"].collect()[0]
    assert (t.dialysis_use_p75_threshold, t.threshold_eligible_count, t.threshold_excluded_count) == (
        Decimal("0.0150000000"), 3, 0)
    got = {r.county_fips: r.screening_quadrant for r in mart["mart_county_screening"].collect()}
    assert got == {"01001": "higher_use_lower_vulnerability", "02013": "lower_use_higher_vulnerability",
                   "11001": "lower_use_higher_vulnerability"}
    summary = mart["audit_screening_quadrant_summary"].orderBy("category_display_order").collect()
    assert [r.screening_row_count for r in summary] == [0, 1, 2, 0, 0]
    svi = {r.county_fips: r for r in mart["stg_cdc_svi_county_2022"].collect()}
    assert (svi["11001"].rpl_theme1_status, svi["02013"].ep_age65_status) == (
        "unavailable_sentinel", "unavailable_null")
    assert svi["02013"].source_page_offset == 2
    dim = mart["dim_county"].where("county_fips = '09001'").collect()[0]
    assert (dim.is_current_county, dim.observed_cms_end_year) == (False, 2021)


def test_every_assertion_was_due(mart):
    assert set(assertions_for(mart)) == set(ASSERTIONS) and len(ASSERTIONS) == 52


def test_rebuild_gives_equal_checksums(mart, raw):
    again = plan({n: df for n, df in raw.items()}, ["fct_svi_county", "dim_county"])
    for name in ("fct_svi_county", "dim_county"):
        assert table_checksum(again[name]).collect() == table_checksum(mart[name]).collect()
    rebuilt = build(raw, check=False)
    for name in SCREENING:
        assert table_checksum(rebuilt[name]).collect() == table_checksum(mart[name]).collect()


def cell(name, column, value, where="true"):
    return lambda t: {name: mu.change_cell(t[name], F.expr(where), column, F.expr(value))}


def doubled(name, where="true"):
    return lambda t: {name: mu.repeat_rows(t[name], F.expr(where))}


def less(name, where):
    return lambda t: {name: mu.drop_rows(t[name], F.expr(where))}


B, FC, FB = "raw.build_input_audit", "fct_medicare_county_year", "fct_medicare_benchmark_year"
SC, SB = "stg_cms_om_gv_county_year", "stg_cms_om_gv_benchmark_year"
SS, SF = "stg_cdc_svi_county_2022", "stg_cms_dialysis_facility"
M, T, Q = "mart_county_screening", "int_county_screening_threshold", "audit_screening_quadrant_summary"

DAMAGE = {
    "build_input_audit_singleton": doubled(B),
    "build_input_lineage_reconciles_facts": cell(B, "cms_content_sha256", "repeat('0', 64)"),
    "cms_benchmark_fact_grain_unique": doubled(FB, "benchmark_geography_key = 'US'"),
    "cms_benchmark_fact_reconciles_stage": cell(FB, "benes_om_cnt", "1", "benchmark_geography_key = 'US'"),
    "cms_benchmark_grain_unique": doubled(SB, "benchmark_geography_key = '01'"),
    "cms_benchmark_numeric_values_valid": cell(SB, "bene_dual_pct_status", "'invalid_numeric'"),
    "cms_benchmark_scope": cell(SB, "benchmark_geography_key", "'ZZ'", "benchmark_geography_type = 'state'"),
    "cms_county_fact_geography_resolves": less("dim_county", "county_fips = '01001'"),
    "cms_county_fact_grain_unique": doubled(FC, "county_fips = '01001'"),
    "cms_county_fact_reconciles_stage": less(FC, "county_fips = '01001'"),
    "cms_county_fips_valid": cell(SC, "county_fips", "'ABCDE'", "county_fips = '01001'"),
    "cms_county_scope": cell(SC, "source_age_level", "'<65'", "county_fips = '01001'"),
    "cms_county_year_unique": doubled(SC, "county_fips = '01001'"),
    "cms_dc_county_equivalent_unambiguous": lambda t: {SC: t[SC].union(
        mu.change_cell(t[SC].where("county_fips = '11001'"), F.lit(True),
                       "county_geography_mapping_method", F.lit("source_county_fips")))},
    "cms_dialysis_users_not_above_beneficiaries": cell(FC, "benes_op_dlys_cnt", "2000"),
    "cms_fact_lineage_constant": cell(FB, "source_manifest_run_id", "'other'"),
    "cms_fact_metric_bounds_and_status": cell(FC, "ma_prtcptn_rate", "1.5"),
    "cms_lineage_present": cell(SC, "source_manifest_run_id", "' '"),
    "cms_numeric_values_valid": cell(SC, "benes_op_dlys_pct_status", "'invalid_numeric'"),
    "cms_stage_reconciles_selected_raw": less(SC, "county_fips = '01001'"),
    "dim_year_has_one_latest": cell("dim_year", "is_latest_cms_year", "true"),
    "dim_year_reconciles_facts": cell("dim_year", "year", "2020", "year = 2023"),
    "cms_svi_latest_current_reconciled": cell(
        "audit_cms_svi_county_reconciliation", "reconciliation_status", "'svi_only'"),
    "dim_county_geography_valid": cell("dim_county", "state_fips", "'60'", "is_current_county"),
    "historical_county_identities_do_not_overlap_current": cell(
        "historical_county_identities", "county_fips", "'01001'", "county_fips = '09001'"),
    "svi_county_fips_unique": doubled(SS, "county_fips = '01001'"),
    "svi_county_fips_valid": cell(SS, "source_object_id", "0"),
    "svi_fact_grain_unique": doubled("fct_svi_county", "county_fips = '01001'"),
    "svi_fact_reconciles_stage": cell("fct_svi_county", "ep_age65_status", "'reported'"),
    "svi_lineage_present": cell(SS, "svi_vintage", "2020"),
    "svi_numeric_values_valid": cell(SS, "rpl_themes_status", "'unavailable_null'"),
    "svi_percentage_bounds": cell(SS, "ep_noveh", "101"),
    "svi_rank_bounds": cell(SS, "rpl_theme2", "1.25"),
    "svi_stage_reconciles_raw": less(SS, "county_fips = '01001'"),
    "facility_availability_codes_valid": cell(SF, "readmission_availability_status", "'invalid'"),
    "facility_characteristics_valid": cell(SF, "dialysis_stations", "null"),
    "facility_confidence_intervals_valid": cell(SF, "survival_lower_confidence_limit", "99"),
    "facility_fact_grain_unique": doubled("fct_facility_quality_snapshot", "ccn = '012345'"),
    "facility_fact_reconciles_stage": less("dim_facility", "ccn = '012345'"),
    "facility_five_star_valid": cell(SF, "five_star_rating", "6"),
    "facility_geography_deferred": cell("dim_facility", "county_fips", "'01001'"),
    "facility_periods_valid": cell(SF, "hospitalization_period_end", "date'1999-01-01'"),
    "facility_quality_companions_complete": cell(SF, "survival_upper_confidence_limit", "null"),
    "facility_stage_reconciles_raw": less(SF, "ccn = '012345'"),
    "screening_classification_consistent": cell(M, "is_higher_observed_dialysis_use", "null"),
    "screening_latest_year_singular": cell(T, "cms_year", "2023"),
    "screening_national_threshold_fixed": cell(M, "dialysis_use_p75_threshold", "0.02", "state_fips = '01'"),
    "screening_reconciles_facts_and_lineage": cell(M, "rpl_themes", "0.1", "county_fips = '01001'"),
    "screening_row_count_reconciles": less(M, "county_fips = '01001'"),
    "screening_rows_current_and_reconciled": cell(M, "svi_reconciliation_row_count", "2"),
    "screening_summary_reconciles": cell(Q, "screening_row_count", "5", "category_display_order = 1"),
    "screening_threshold_valid": cell(T, "dialysis_use_p75_threshold", "1.2"),
}


def test_each_assertion_notices_its_damage(mart):
    """One mutation per assertion; the named one has to report rows."""
    assert set(DAMAGE) == set(ASSERTIONS)
    parts = []
    for name, damage in DAMAGE.items():
        rows = quality.violating_rows(ASSERTIONS[name], {**mart, **damage(mart)})
        parts.append((name, rows))
    silent = [name for name, rows in parts if not rows.take(1)]
    assert silent == []


@pytest.mark.parametrize("change,name", [
    ({"medicare": [*SCREENING_ROWS[1:], medicare_row("2024", "County", "AL-x", "01001", "x")]},
     "cms_numeric_values_valid"),
    ({"medicare": [*SCREENING_ROWS, SCREENING_ROWS[3]]}, "cms_county_year_unique"),
    ({"medicare": [r for r in SCREENING_ROWS if r[3] != "02013"]}, "cms_svi_latest_current_reconciled"),
    ({"facilities": [*FACILITIES, facility_row("777777", ("6", "001"))]}, "facility_five_star_valid"),
])
def test_build_stops_by_name(spark, folder, change, name):
    raw = raw_sources(spark, f"{folder}/bad-{name}", **change)
    with pytest.raises(quality.QualityFailure) as stopped:
        build(raw)
    assert name in stopped.value.failures


def test_two_source_build_leaves_facilities_out(spark, folder, raw):
    some = {n: df for n, df in raw.items() if C.FACILITY not in n}
    tables = build(some, exclude=["stg_cms_dialysis_facility"], check=False)
    assert set(MODELS) - set(tables) == {
        "stg_cms_dialysis_facility", "dim_facility", "fct_facility_quality_snapshot"}


def test_selection():
    assert with_ancestors(["dim_year"]) == [SC, SB, "dim_year"]
    assert with_descendants(["stg_cms_dialysis_facility"]) == [
        SF, "dim_facility", "fct_facility_quality_snapshot"]
    assert with_descendants([T]) == list(SCREENING)
    assert set(assertions_for([SF])) == {
        "facility_availability_codes_valid", "facility_characteristics_valid",
        "facility_confidence_intervals_valid", "facility_five_star_valid", "facility_periods_valid",
        "facility_quality_companions_complete"}


def test_declared_checks_cover_every_model(mart):
    declared = {n: mart[n] for n in RELATIONS}
    report = quality.generic_report(declared)
    assert report.count() == 287 + 13 + 5
    assert quality.failures(report) == {}


def test_column_report_counts_nulls_and_repeats_in_one_scan(mart):
    damaged = mu.change_cell(mart["dim_county"], F.col("county_fips").isin("01001", "02013"), "county_fips", F.lit("11001"))
    damaged = mu.change_cell(damaged, F.col("county_fips") == "09001", "county_fips", F.lit(None))
    report = quality.column_report("dim_county", damaged)
    assert quality.failures(report) == {"not_null:dim_county.county_fips": 1, "unique:dim_county.county_fips": 1}
    assert report.count() == len(quality.required("dim_county")) + 1
    plan_text = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.count("Relation [") == 1
    assert quality.failures(quality.column_report("dim_county", damaged.limit(0))) == {}


def test_not_null_checks_are_observed_while_a_model_is_written(spark, folder):
    """A NULL in a stage stops the build by the names of the stage's and the fact's check."""
    raw = raw_sources(spark, f"{folder}/observed")
    blank = mu.change_cell(raw[f"raw.{C.VULNERABILITY}"], F.lit(True), "source_retrieved_at_utc", F.lit(None))
    with pytest.raises(quality.QualityFailure) as stopped:
        build({**raw, f"raw.{C.VULNERABILITY}": blank}, select=["fct_svi_county"])
    rows = raw[f"raw.{C.VULNERABILITY}"].count()
    assert stopped.value.failures["not_null:stg_cdc_svi_county_2022.source_retrieved_at_utc"] == rows
    assert stopped.value.failures["not_null:fct_svi_county.source_retrieved_at_utc"] == rows


def test_observed_counts_of_an_empty_model(raw):
    empty = {n: df.limit(0) if n == f"raw.{C.FACILITY}" else df for n, df in raw.items()}
    with pytest.raises(quality.QualityFailure) as stopped:
        build(empty, select=["stg_cms_dialysis_facility"])
    assert set(stopped.value.failures) <= set(ASSERTIONS)
    built = build({n: df for n, df in empty.items() if "audit" not in n}, select=["stg_cms_dialysis_facility"])
    assert built["stg_cms_dialysis_facility"].count() == 0


def test_projections_keep_the_rows_of_what_they_project(mart):
    for name, model in MODELS.items():
        if model.projects:
            assert model.inputs == (model.projects,) and not model.stored
            plain = mart[model.projects].select(*mart[name].columns)
            assert plain.sameSemantics(mart[name]) or plain.exceptAll(mart[name]).isEmpty()
