from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbmart.plans import core, screening, staging
from plumbmart.plans.relations import columns, schema
from plumbmart.sources import contracts as C
from samples import FACILITIES, facility_row, medicare_row, sha

A, B = sha("a"), sha("b")


def partial(spark, relation, rows):
    """Rows given by some of a relation's columns; the others are NULL."""
    names = columns(relation)
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema(relation))


def medicare(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in C.MEDICARE_COLUMNS))
    return df.withColumns({n: F.lit(n) for n in C.MEDICARE_LINEAGE})


def all_tokens(token, year="2024", code="01003"):
    return [year, "County", "AL-x", code, "All"] + [token] * 9


def test_county_stage_scope_and_gaps(spark):
    rows = [
        medicare_row("2024", "County", "AL-a", "01001"), medicare_row("2024", "County", "AL-a", "01001", age="<65"),
        medicare_row("2024", "State", "AL", "01"), medicare_row("2024", "National", "National", ""),
        ["2024", "State", " dc ", " 11 ", "All"] + ["0"] * 9,
        all_tokens("*", code="01003"), all_tokens("", code="01005"), all_tokens(" na ", code="01007"),
        all_tokens(" 42 ", code="01009"), all_tokens("1", code="01000")[:2] + ["al-unknown", "01000", "All"] + ["1"] * 9,
        medicare_row("2024", "County", "PR-x", "72001"),
    ]
    got = {r.county_fips: r for r in staging.stg_cms_om_gv_county_year(medicare(spark, rows)).collect()}
    assert set(got) == {"01001", "01003", "01005", "01007", "01009", "11001"}
    dc = got["11001"]
    assert dc.county_geography_mapping_method == "district_of_columbia_state_to_county_equivalent"
    assert (dc.benes_om_cnt, dc.benes_op_dlys_pct, dc.benes_op_dlys_pct_status) == (0, 0, "reported")
    for code, status in (("01003", "suppressed"), ("01005", "unavailable_blank"), ("01007", "unavailable_na")):
        assert {got[code][f"{m}_status"] for m, _, _ in C.MEDICARE_METRICS} == {status}
        assert {got[code][m] for m, _, _ in C.MEDICARE_METRICS} == {None}
    assert (got["01009"].benes_om_cnt_raw, got["01009"].benes_om_cnt) == (" 42 ", 42)


def test_benchmark_stage(spark):
    rows = [medicare_row("2024", "State", "AL", " 01 "), medicare_row("2024", "State", "PR", "72"),
            medicare_row("2024", "State", "Territory", ""), medicare_row("2024", "National", "national", " "),
            medicare_row("2024", "National", "Other", ""), medicare_row("2024", "County", "AL-x", "01001")]
    got = staging.stg_cms_om_gv_benchmark_year(medicare(spark, rows)).collect()
    assert sorted((r.benchmark_geography_type, r.benchmark_geography_key) for r in got) == [
        ("national", "US"), ("state", "01")]


def test_facility_stage(spark):
    df = spark.createDataFrame([tuple(r[h] for h in C.FACILITY_COLUMNS) for r in FACILITIES],
                               ", ".join(f"`{h}` string" for h in C.FACILITY_COLUMNS))
    df = df.withColumns({n: F.lit(n) for n in C.FACILITY_LINEAGE})
    stage = staging.stg_cms_dialysis_facility(df)
    assert stage.columns == columns("stg_cms_dialysis_facility")
    got = {r.ccn: r for r in stage.collect()}
    full, gone, zero = got["012345"], got["123456"], got["654321"]
    assert (full.five_star_rating, full.survival_denominator, full.survival_estimate) == (4, 100, Decimal("10.5"))
    assert (full.survival_lower_confidence_limit, full.survival_upper_confidence_limit) == (9, 12)
    assert full.survival_category == "as_expected" and str(full.survival_period_start) == "2024-01-01"
    assert (gone.five_star_rating, gone.survival_estimate, gone.dialysis_stations, gone.chain_owned) == (
        None, None, 0, False)
    assert gone.survival_unavailability_reason == "data_not_reported"
    assert (zero.five_star_rating, zero.five_star_rating_raw, zero.five_star_unavailability_reason) == (
        None, "0", "insufficient_history")
    assert (zero.survival_estimate, zero.survival_availability_status) == (0, "available")


def test_county_dimension_keeps_text_identity(spark):
    svi = partial(spark, "stg_cdc_svi_county_2022", [
        {"county_fips": c, "state_fips": c[:2], "svi_vintage": 2022, "source_id": C.VULNERABILITY,
         "source_manifest_run_id": "r", "source_snapshot_sha256": A} for c in ("01001", "11001")])
    years = partial(spark, "stg_cms_om_gv_county_year", [
        {"county_fips": "01001", "year": 2023}, {"county_fips": "01001", "year": 2024},
        {"county_fips": "09001", "year": 2021}])
    seed = partial(spark, "historical_county_identities", [
        {"county_fips": "09001", "state_fips": "09", "observed_cms_start_year": 2014, "is_current_county": False,
         "observed_cms_end_year": 2021, "geography_status": "historical_source_only", "seed_version": "v"}])
    got = {r.county_fips: r for r in core.dim_county(svi, years, seed).collect()}
    assert (got["01001"].observed_cms_start_year, got["01001"].observed_cms_end_year) == (2023, 2024)
    assert got["11001"].observed_cms_start_year is None and got["11001"].is_current_county
    old = got["09001"]
    assert (old.svi_geography_vintage, old.geography_source_id, old.observed_cms_end_year) == (
        None, C.HISTORICAL_SOURCE, 2021)


CMS = {"source_manifest_run_id": "c", "source_content_sha256": A, "source_retrieved_at_utc": "t",
       "source_modified_at": "m"}
SVI = {"source_manifest_run_id": "s", "source_snapshot_sha256": B, "source_retrieved_at_utc": "u",
       "source_modified_at": "n", "svi_vintage": 2022}


def share(code, value, status="reported", year=2024):
    return {"county_fips": code, "year": year, "benes_op_dlys_pct": None if value is None else Decimal(value),
            "benes_op_dlys_pct_status": status, "benes_om_cnt_status": "reported", **CMS}


@pytest.fixture(scope="module")
def threshold_inputs(spark):
    audit = partial(spark, "raw.build_input_audit",
                    [{"build_format_version": 1, "build_id": "run", "input_set_sha256": A}])
    years = partial(spark, "dim_year", [{"year": 2023, "is_latest_cms_year": False},
                                        {"year": 2024, "is_latest_cms_year": True}])
    counties = partial(spark, "dim_county", [
        {"county_fips": c, "is_current_county": c != "09001"}
        for c in ("01001", "01003", "01005", "01007", "01009", "09001")])
    svi = partial(spark, "fct_svi_county", [{"county_fips": "01001", **SVI}])
    return audit, years, counties, svi


def test_threshold_uses_reported_latest_current_counties(spark, threshold_inputs):
    audit, years, counties, svi = threshold_inputs
    fact = partial(spark, "fct_medicare_county_year", [
        share("01001", "0.99", year=2023), share("01001", "0.01"), share("01003", "0.02"),
        share("01005", "0.03"), share("01007", "0.04"), share("01009", None, "suppressed"), share("09001", "1")])
    row = screening.int_county_screening_threshold(audit, years, counties, fact, svi).collect()
    assert len(row) == 1
    row = row[0]
    assert row.dialysis_use_p75_threshold == Decimal("0.0325000000")
    assert (row.current_county_count, row.threshold_eligible_count, row.threshold_excluded_count) == (5, 4, 1)
    assert (row.cms_year, row.svi_vintage, row.threshold_method) == (2024, 2022, "continuous_linear_type_7")


def test_threshold_is_null_without_eligible_rows(spark, threshold_inputs):
    audit, years, counties, svi = threshold_inputs
    fact = partial(spark, "fct_medicare_county_year", [share("01001", None, "suppressed")])
    row = screening.int_county_screening_threshold(audit, years, counties, fact, svi).collect()[0]
    assert (row.dialysis_use_p75_threshold, row.threshold_eligible_count) == (None, 0)


CASES = {
    "01001": ("0.03", "reported", "0.75", "reported", True, True, "higher_use_higher_vulnerability", None),
    "01003": ("0.04", "reported", "0.5", "reported", True, False, "higher_use_lower_vulnerability", None),
    "02013": ("0.02", "reported", "0.8", "reported", False, True, "lower_use_higher_vulnerability", None),
    "11001": ("0", "reported", "0", "reported", False, False, "lower_use_lower_vulnerability", None),
    "04001": (None, "suppressed", "0.8", "reported", None, True, "insufficient_data",
              "dialysis_use_component_unavailable"),
    "05001": ("0.04", "reported", None, "unavailable_sentinel", True, None, "insufficient_data",
              "social_vulnerability_component_unavailable"),
    "06001": (None, "unavailable_na", None, "unavailable_null", None, None, "insufficient_data",
              "both_components_unavailable"),
    "08001": (None, None, None, None, None, None, "insufficient_data", "both_components_unavailable"),
}


def test_classification(spark):
    threshold = partial(spark, "int_county_screening_threshold", [
        {"screening_run_id": "run", "cms_year": 2024, "svi_vintage": 2022, "threshold_eligible_count": 6,
         "dialysis_use_p75_threshold": Decimal("0.03")}])
    counties = partial(spark, "dim_county", [{"county_fips": c, "is_current_county": True} for c in CASES]
                       + [{"county_fips": "09001", "is_current_county": False}])
    fact = partial(spark, "fct_medicare_county_year",
                   [share(c, v[0], v[1]) for c, v in CASES.items() if v[1]] + [share("01001", "0", year=2023)])
    svi = partial(spark, "fct_svi_county", [
        {"county_fips": c, "rpl_themes": None if v[2] is None else Decimal(v[2]), "rpl_themes_status": v[3], **SVI}
        for c, v in CASES.items() if v[3]])
    recon = partial(spark, "audit_cms_svi_county_reconciliation",
                    [{"county_fips": c, "reconciliation_status": "matched", "cms_row_count": 1, "svi_row_count": 1}
                     for c in CASES])
    got = {r.county_fips: r for r in screening.mart_county_screening(threshold, counties, fact, svi, recon).collect()}
    assert set(got) == set(CASES)
    for code, case in CASES.items():
        r = got[code]
        assert (r.is_higher_observed_dialysis_use, r.is_higher_social_vulnerability, r.screening_quadrant,
                r.screening_insufficient_reason) == case[4:], code
        assert r.is_dialysis_use_threshold_eligible is (case[0] is not None)
        assert r.screening_data_status == ("insufficient_data" if case[7] else "complete")


def test_summary_shows_every_category(spark):
    threshold = partial(spark, "int_county_screening_threshold", [
        {"screening_run_id": "run", "cms_year": 2024, "threshold_eligible_count": 4, "threshold_excluded_count": 1}])
    hh, hl, lh, ll, none = (q for _, q in C.QUADRANTS)
    rows = [(hh, "complete", True, True)] * 2 + [(hl, "complete", True, False), (lh, "complete", False, True),
            (none, "insufficient_data", None, False)]
    mart = partial(spark, "mart_county_screening", [
        {"screening_quadrant": q, "screening_data_status": s, "is_higher_observed_dialysis_use": u,
         "is_higher_social_vulnerability": v} for q, s, u, v in rows])
    got = screening.audit_screening_quadrant_summary(threshold, mart).orderBy("category_display_order").collect()
    assert [(r.screening_quadrant, r.screening_row_count) for r in got] == [(hh, 2), (hl, 1), (lh, 1), (ll, 0), (none, 1)]
    assert {(r.total_screening_row_count, r.complete_data_count, r.insufficient_data_count, r.higher_use_count,
             r.lower_use_count, r.higher_vulnerability_count, r.lower_vulnerability_count) for r in got} == {
        (5, 4, 1, 3, 1, 3, 2)}
