"""The violating rows of every named assertion, stated in SQL for DuckDB."""

from __future__ import annotations

from plumbmart.queries.oracle import ABROAD, _IS_COUNTY, _IS_DISTRICT, with_relations
from plumbmart.sources import contracts as C

BENCH_KEY = "benchmark_geography_type, benchmark_geography_key, year"


def _bad_hash(x: str) -> str:
    return f"not regexp_full_match({x}, '[0-9a-f]{{64}}')"


def _blank(x: str) -> str:
    return f"trim(coalesce({x}, '')) = ''"


def _repeats(relation: str, keys: str) -> str:
    return f"select {keys} from {relation} group by {keys} having count(*) > 1"


def _rows(relation: str, *conditions: str) -> str:
    return f"select 1 as hit from {relation} where " + " or ".join(f"({c})" for c in conditions)


def _any_invalid() -> list[str]:
    return [f"{m}_status = 'invalid_numeric'" for m, _, _ in C.MEDICARE_METRICS]


def _bounds() -> list[str]:
    out = []
    for m, _, share in C.MEDICARE_METRICS:
        out.append(f"{m} < 0" + (f" or {m} > 1" if share else ""))
        out.append(
            f"{m}_status not in ('reported', 'suppressed', 'unavailable_blank', 'unavailable_na')"
        )
        out.append(f"({m}_status = 'reported') <> ({m} is not null)")
    return out


_METRIC_LIST = ", ".join(f"{m}, {m}_status" for m, _, _ in C.MEDICARE_METRICS)
_BOTH_FACTS = (
    f"(select {_METRIC_LIST} from fct_medicare_county_year union all"
    f" select {_METRIC_LIST} from fct_medicare_benchmark_year)"
)
_LINEAGE = ", ".join(C.MEDICARE_LINEAGE)


def _lineage_gap(fact: str, prefix: str, hash_name: str) -> str:
    return (
        f"select distinct source_id, source_manifest_run_id, source_{hash_name},"
        f" source_retrieved_at_utc from {fact} f where not exists (select 1 from raw_audit a"
        f" where a.{prefix}_source_id = f.source_id"
        f" and a.{prefix}_manifest_run_id = f.source_manifest_run_id"
        f" and a.{prefix}_{hash_name} = f.source_{hash_name}"
        f" and a.{prefix}_retrieved_at_utc = f.source_retrieved_at_utc)"
    )


def _county_identity() -> list[str]:
    return [
        "not regexp_full_match(county_fips, '[0-9]{5}')",
        "not regexp_full_match(state_fips, '[0-9]{2}')",
        "left(county_fips, 2) <> state_fips",
        f"state_fips in {ABROAD}",
        "state_fips = '11' and county_fips <> '11001'",
    ]


def _score_values() -> list[str]:
    out = []
    for m in C.VULNERABILITY_METRICS:
        out += [
            f"{m}_status not in ('reported', 'unavailable_sentinel', 'unavailable_null')",
            f"({m}_status = 'reported') <> ({m} is not null)",
            f"{m}_raw is null and {m}_status <> 'unavailable_null'",
            f"trim({m}_raw) = '-999' and {m}_status <> 'unavailable_sentinel'",
        ]
    return out


def _unmatched(relation: str, other: str) -> str:
    """The rows of one relation that the other does not have, numbered within their key."""
    columns = ", ".join((
        "county_fips", "svi_vintage", "acs_period_start", "acs_period_end",
        *(n for m in C.VULNERABILITY_METRICS for n in (m, f"{m}_status")), *C.SNAPSHOT_LINEAGE,
    ))
    keyed = "where county_fips is not null and svi_vintage is not null"
    return (
        "(select county_fips, svi_vintage, row_number() over (partition by county_fips, svi_vintage) as place"
        f" from (select {columns} from {relation} {keyed} except all select {columns} from {other} {keyed}))"
    )


def _families(condition: str) -> str:
    return " union all ".join(
        f"select ccn from stg_cms_dialysis_facility where {f}_availability_status = 'available'"
        f" and ({condition.replace('@', f)})"
        for f in C.FAMILIES
    )


_P = ("five_star", *C.FAMILIES)
_NUMBERS = ("denominator", "estimate", "lower_confidence_limit", "upper_confidence_limit")

_REQUIRED_AUDIT = " or ".join(
    f"facility_{n} is null"
    for n in ("manifest_run_id", "snapshot_sha256", "retrieved_at_utc", "page_count", "row_count")
)

# assertion -> (relations, SQL for its violating rows)
SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "build_input_audit_singleton": (
        ("raw_audit",),
        "select 1 from raw_audit having count(*) <> 1 or count(distinct build_id) <> 1"
        " or count(distinct input_set_sha256) <> 1"
        " or count_if(build_format_version not in (1, 2)) > 0",
    ),
    "build_input_lineage_reconciles_facts": (
        ("raw_audit", "fct_medicare_county_year", "fct_svi_county"),
        _rows(
            "raw_audit",
            f"cms_source_id <> '{C.MEDICARE}'", f"cms_contract_version <> '{C.MEDICARE_CONTRACT}'",
            f"svi_source_id <> '{C.VULNERABILITY}'",
            f"svi_contract_version <> '{C.VULNERABILITY_CONTRACT}'",
            _bad_hash("input_set_sha256"), _bad_hash("cms_content_sha256"),
            _bad_hash("svi_snapshot_sha256"),
            "least(cms_page_count, cms_row_count, svi_page_count, svi_row_count) < 1",
        )
        + " union all select 1 from ("
        + _lineage_gap("fct_medicare_county_year", "cms", "content_sha256")
        + ") union all select 1 from ("
        + _lineage_gap("fct_svi_county", "svi", "snapshot_sha256") + ")",
    ),
    "cms_benchmark_fact_grain_unique": (
        ("fct_medicare_benchmark_year",), _repeats("fct_medicare_benchmark_year", BENCH_KEY)
    ),
    "cms_benchmark_fact_reconciles_stage": (
        ("stg_cms_om_gv_benchmark_year", "fct_medicare_benchmark_year"),
        f"(select {_METRIC_LIST}, {BENCH_KEY}, {_LINEAGE} from stg_cms_om_gv_benchmark_year"
        f" except all select {_METRIC_LIST}, {BENCH_KEY}, {_LINEAGE} from fct_medicare_benchmark_year)"
        f" union all (select {_METRIC_LIST}, {BENCH_KEY}, {_LINEAGE} from fct_medicare_benchmark_year"
        f" except all select {_METRIC_LIST}, {BENCH_KEY}, {_LINEAGE} from stg_cms_om_gv_benchmark_year)",
    ),
    "cms_benchmark_grain_unique": (
        ("stg_cms_om_gv_benchmark_year",), _repeats("stg_cms_om_gv_benchmark_year", BENCH_KEY)
    ),
    "cms_benchmark_numeric_values_valid": (
        ("stg_cms_om_gv_benchmark_year",), _rows("stg_cms_om_gv_benchmark_year", *_any_invalid())
    ),
    "cms_benchmark_scope": (
        ("stg_cms_om_gv_benchmark_year",),
        _rows(
            "stg_cms_om_gv_benchmark_year",
            "source_age_level <> 'All'",
            "benchmark_geography_type not in ('state', 'national')",
            "benchmark_geography_type = 'state'"
            " and not regexp_full_match(benchmark_geography_key, '[0-9]{2}')",
            "benchmark_geography_type = 'national' and (benchmark_geography_key <> 'US'"
            " or coalesce(source_geography_code, '') <> '')",
        ),
    ),
    "cms_county_fact_geography_resolves": (
        ("fct_medicare_county_year", "dim_county"),
        "select county_fips from fct_medicare_county_year f where not exists"
        " (select 1 from dim_county d where d.county_fips = f.county_fips)",
    ),
    "cms_county_fact_grain_unique": (
        ("fct_medicare_county_year",), _repeats("fct_medicare_county_year", "county_fips, year")
    ),
    "cms_county_fact_reconciles_stage": (
        ("stg_cms_om_gv_county_year", "fct_medicare_county_year"),
        f"(select {_METRIC_LIST}, county_fips, year, {_LINEAGE} from stg_cms_om_gv_county_year"
        f" except all select {_METRIC_LIST}, county_fips, year, {_LINEAGE} from fct_medicare_county_year)"
        f" union all (select {_METRIC_LIST}, county_fips, year, {_LINEAGE} from fct_medicare_county_year"
        f" except all select {_METRIC_LIST}, county_fips, year, {_LINEAGE} from stg_cms_om_gv_county_year)",
    ),
    "cms_county_fips_valid": (
        ("stg_cms_om_gv_county_year",),
        _rows(
            "stg_cms_om_gv_county_year",
            "not regexp_full_match(county_fips, '[0-9]{5}')",
            "starts_with(upper(trim(source_geography_description)), 'DC-')"
            " and county_fips <> '11001'",
        ),
    ),
    "cms_county_scope": (
        ("stg_cms_om_gv_county_year",),
        _rows(
            "stg_cms_om_gv_county_year",
            "source_age_level <> 'All'",
            "county_geography_mapping_method not in"
            " ('source_county_fips', 'district_of_columbia_state_to_county_equivalent')",
            "source_geography_level <> 'County' and not (source_geography_level = 'State' and"
            " county_fips = '11001' and source_geography_code = '11'"
            " and upper(trim(source_geography_description)) = 'DC')",
            f"left(county_fips, 2) in {ABROAD}",
            "trim(source_geography_code) similar to '[0-9]{2}000' and"
            " upper(trim(source_geography_description)) similar to '[A-Z]{2}-UNKNOWN'",
        ),
    ),
    "cms_county_year_unique": (
        ("stg_cms_om_gv_county_year",), _repeats("stg_cms_om_gv_county_year", "county_fips, year")
    ),
    "cms_dc_county_equivalent_unambiguous": (
        ("stg_cms_om_gv_county_year",),
        "select year from stg_cms_om_gv_county_year where county_fips = '11001' group by year"
        " having count(*) > 1 and count(distinct county_geography_mapping_method) = 2",
    ),
    "cms_dialysis_users_not_above_beneficiaries": (
        ("fct_medicare_county_year", "fct_medicare_benchmark_year"),
        _rows(_BOTH_FACTS, "benes_op_dlys_cnt - benes_om_cnt > 0"),
    ),
    "cms_fact_lineage_constant": (
        ("fct_medicare_county_year", "fct_medicare_benchmark_year"),
        f"select 1 from (select distinct {_LINEAGE} from (select {_LINEAGE} from"
        f" fct_medicare_county_year union all select {_LINEAGE} from fct_medicare_benchmark_year))"
        f" having count(*) <> 1 or min(source_id) <> '{C.MEDICARE}' or "
        + _bad_hash("min(source_content_sha256)"),
    ),
    "cms_fact_metric_bounds_and_status": (
        ("fct_medicare_county_year", "fct_medicare_benchmark_year"),
        _rows(_BOTH_FACTS, *_bounds()),
    ),
    "cms_lineage_present": (
        ("stg_cms_om_gv_county_year",),
        _rows(
            "stg_cms_om_gv_county_year", f"source_id <> '{C.MEDICARE}'",
            _blank("source_manifest_run_id"), _bad_hash("source_content_sha256"),
            _blank("source_retrieved_at_utc"),
        ),
    ),
    "cms_numeric_values_valid": (
        ("stg_cms_om_gv_county_year",), _rows("stg_cms_om_gv_county_year", *_any_invalid())
    ),
    "cms_stage_reconciles_selected_raw": (
        ("raw_medicare", "stg_cms_om_gv_county_year"),
        "select 1 from raw_medicare having count_if(BENE_AGE_LVL = 'All' and"
        f" (({_IS_COUNTY}) or ({_IS_DISTRICT})))"
        " <> (select count(*) from stg_cms_om_gv_county_year)",
    ),
    "dim_year_has_one_latest": (
        ("dim_year",),
        "select 1 from dim_year having count_if(is_latest_cms_year) <> 1"
        " or max(year) <> max(case when is_latest_cms_year then year end)",
    ),
    "dim_year_reconciles_facts": (
        ("fct_medicare_county_year", "fct_medicare_benchmark_year", "dim_year"),
        "select year from (select distinct year, 1 as side from fct_medicare_county_year union"
        " select distinct year, 1 from fct_medicare_benchmark_year union"
        " select distinct year, 2 from dim_year) group by year having sum(side) <> 3",
    ),
    "cms_svi_latest_current_reconciled": (
        ("audit_cms_svi_county_reconciliation",),
        _rows(
            "audit_cms_svi_county_reconciliation",
            "reconciliation_status <> 'matched'", "not (cms_present and svi_present)",
            "cms_row_count <> 1 or svi_row_count <> 1",
            _bad_hash("cms_source_content_sha256"), _bad_hash("svi_source_snapshot_sha256"),
        ),
    ),
    "dim_county_geography_valid": (
        ("dim_county",),
        _rows(
            "dim_county",
            *_county_identity(),
            "geography_status not in ('current_in_scope', 'historical_source_only')",
            "is_current_county and (geography_status <> 'current_in_scope'"
            " or svi_geography_vintage <> 2022 or boundary_discontinuity_warning is not null"
            f" or geography_source_id <> '{C.VULNERABILITY}'"
            f" or geography_source_version <> '{C.VULNERABILITY_CONTRACT}'"
            f" or {_bad_hash('geography_source_snapshot_sha256')})",
            "not is_current_county and (geography_status <> 'historical_source_only'"
            " or svi_geography_vintage is not null"
            " or coalesce(observed_cms_start_year > observed_cms_end_year, true)"
            " or boundary_discontinuity_warning is null"
            f" or geography_source_id <> '{C.HISTORICAL_SOURCE}'"
            f" or geography_source_version <> '{C.HISTORICAL_VERSION}'"
            f" or geography_source_manifest_run_id <> '{C.HISTORICAL_RUN}'"
            " or geography_source_snapshot_sha256 is not null)",
        ),
    ),
    "historical_county_identities_do_not_overlap_current": (
        ("historical", "stg_cdc_svi_county_2022"),
        "select county_fips from historical where county_fips in"
        " (select county_fips from stg_cdc_svi_county_2022)",
    ),
    "svi_county_fips_unique": (
        ("stg_cdc_svi_county_2022",), _repeats("stg_cdc_svi_county_2022", "county_fips")
    ),
    "svi_county_fips_valid": (
        ("stg_cdc_svi_county_2022",),
        _rows(
            "stg_cdc_svi_county_2022", *_county_identity(), _blank("state_name"),
            _blank("state_abbreviation"), _blank("county_name"), "source_object_id <= 0",
        ),
    ),
    "svi_fact_grain_unique": (
        ("fct_svi_county",), _repeats("fct_svi_county", "county_fips, svi_vintage")
    ),
    "svi_fact_reconciles_stage": (
        ("stg_cdc_svi_county_2022", "fct_svi_county"),
        # the rows of a repeated key are paired, equal rows first
        f"select 1 from {_unmatched('stg_cdc_svi_county_2022', 'fct_svi_county')} s full join"
        f" {_unmatched('fct_svi_county', 'stg_cdc_svi_county_2022')} f"
        " on (s.county_fips, s.svi_vintage, s.place) = (f.county_fips, f.svi_vintage, f.place)"
        " union all select 1 from stg_cdc_svi_county_2022 where county_fips is null or svi_vintage is null"
        " union all select 1 from fct_svi_county where county_fips is null or svi_vintage is null",
    ),
    "svi_lineage_present": (
        ("stg_cdc_svi_county_2022",),
        _rows(
            "stg_cdc_svi_county_2022", f"source_id <> '{C.VULNERABILITY}'",
            _blank("source_manifest_run_id"), _bad_hash("source_snapshot_sha256"),
            _blank("source_retrieved_at_utc"), "least(source_page_index, source_page_offset) < 0",
            _bad_hash("source_page_sha256"),
            "(svi_vintage, acs_period_start, acs_period_end) <> (2022, 2018, 2022)",
        ),
    ),
    "svi_numeric_values_valid": (
        ("stg_cdc_svi_county_2022",), _rows("stg_cdc_svi_county_2022", *_score_values())
    ),
    "svi_percentage_bounds": (
        ("stg_cdc_svi_county_2022",),
        _rows("stg_cdc_svi_county_2022", *(f"{m} < 0 or {m} > 100" for m in C.PERCENTAGES)),
    ),
    "svi_rank_bounds": (
        ("stg_cdc_svi_county_2022",),
        _rows("stg_cdc_svi_county_2022", *(f"{m} < 0 or {m} > 1" for m in C.RANKS)),
    ),
    "svi_stage_reconciles_raw": (
        ("raw_vulnerability", "stg_cdc_svi_county_2022"),
        "select 1 from (select count(*) n, count(distinct STCNTY) k,"
        " count(distinct source_snapshot_sha256) s from raw_vulnerability) a,"
        " (select count(*) n, count(distinct county_fips) k,"
        " count(distinct source_snapshot_sha256) s from stg_cdc_svi_county_2022) b"
        " where (a.n, a.k, a.s, b.s) <> (b.n, b.k, 1, 1)",
    ),
    "facility_availability_codes_valid": (
        ("stg_cms_dialysis_facility",),
        _rows("stg_cms_dialysis_facility",
              *(f"{p}_availability_status = 'invalid'" for p in _P)),
    ),
    "facility_characteristics_valid": (
        ("stg_cms_dialysis_facility",),
        _rows(
            "stg_cms_dialysis_facility", "coalesce(dialysis_stations, -1) < 0",
            *(f"lower(trim({n}_raw)) not in ('yes', 'no')" for n, _ in C.FACILITY_YES_NO),
            "certification_date is null",
        ),
    ),
    "facility_confidence_intervals_valid": (
        ("stg_cms_dialysis_facility",),
        _families(
            "@_estimate < @_lower_confidence_limit or @_estimate > @_upper_confidence_limit"
        ),
    ),
    "facility_fact_grain_unique": (
        ("fct_facility_quality_snapshot",),
        _repeats("fct_facility_quality_snapshot", "ccn, source_snapshot_sha256"),
    ),
    "facility_fact_reconciles_stage": (
        ("stg_cms_dialysis_facility", "dim_facility", "fct_facility_quality_snapshot", "raw_audit"),
        "select 1 from raw_audit, (select (select count(*) from stg_cms_dialysis_facility) as s,"
        " (select count(*) from dim_facility) as d,"
        " (select count(*) from fct_facility_quality_snapshot) as f) where s <> d or s <> f"
        f" or build_format_version <> 2 or facility_source_id is distinct from '{C.FACILITY}'"
        f" or facility_contract_version is distinct from '{C.FACILITY_CONTRACT}'"
        f" or {_REQUIRED_AUDIT} or {_bad_hash('input_set_sha256')}"
        f" or {_bad_hash('facility_snapshot_sha256')} or facility_page_count <> 1"
        " or facility_row_count < 1 union all select 1 from ("
        + _lineage_gap("fct_facility_quality_snapshot", "facility", "snapshot_sha256") + ")",
    ),
    "facility_five_star_valid": (
        ("stg_cms_dialysis_facility",),
        _rows(
            "stg_cms_dialysis_facility",
            "five_star_availability_status = 'available'"
            " and coalesce(five_star_rating, 0) not in (1, 2, 3, 4, 5)",
            "five_star_availability_status = 'not_available' and five_star_rating is not null",
        ),
    ),
    "facility_geography_deferred": (
        ("dim_facility",),
        _rows(
            "dim_facility", "geography_match_status <> 'not_attempted'",
            "coalesce(county_fips, geography_match_method) is not null",
            "geography_resolution_date is not null",
        ),
    ),
    "facility_periods_valid": (
        ("stg_cms_dialysis_facility",),
        _rows("stg_cms_dialysis_facility",
              *(f"coalesce({p}_period_start > {p}_period_end, true)" for p in _P)),
    ),
    "facility_quality_companions_complete": (
        ("stg_cms_dialysis_facility",),
        _families(
            "@_period_start is null or @_period_end is null or @_category not in"
            " ('better_than_expected', 'as_expected', 'worse_than_expected') or "
            + " or ".join(f"coalesce(@_{n}, -1) < 0" for n in _NUMBERS)
        ),
    ),
    "facility_stage_reconciles_raw": (
        ("raw_facility", "stg_cms_dialysis_facility"),
        f'select 1 from (select count(*) n, count(distinct "{C.CCN_HEADER}") k from raw_facility) a,'
        " (select count(*) n, count(distinct ccn) k from stg_cms_dialysis_facility) b"
        " where a.n <> a.k or a.n <> b.n or b.n <> b.k",
    ),
    "screening_classification_consistent": (
        ("mart_county_screening",),
        "select 1 from (select *, coalesce(benes_op_dlys_pct_status = 'reported'"
        " and benes_op_dlys_pct is not null, false) as u,"
        " coalesce(rpl_themes_status = 'reported' and rpl_themes is not null, false) as v,"
        " benes_op_dlys_pct >= dialysis_use_p75_threshold as hu, rpl_themes >= 0.75 as hv"
        " from mart_county_screening) where is_dialysis_use_threshold_eligible <> u"
        " or is_higher_observed_dialysis_use is distinct from case when u then hu end"
        " or is_higher_social_vulnerability is distinct from case when v then hv end"
        " or dialysis_use_band <> case when u then if(hu, 'higher_use', 'lower_use')"
        " else 'insufficient_data' end"
        " or social_vulnerability_band <> case when v then"
        " if(hv, 'higher_vulnerability', 'lower_vulnerability') else 'insufficient_data' end"
        " or screening_data_status <> if(u and v, 'complete', 'insufficient_data')"
        " or screening_insufficient_reason is distinct from case when u and v then null"
        " when not u and not v then 'both_components_unavailable' when u then"
        " 'social_vulnerability_component_unavailable' else 'dialysis_use_component_unavailable' end"
        " or screening_quadrant <> case when u and v then"
        " dialysis_use_band || '_' || social_vulnerability_band else 'insufficient_data' end",
    ),
    "screening_latest_year_singular": (
        ("dim_year", "int_county_screening_threshold"),
        "select 1 from dim_year having count_if(is_latest_cms_year) <> 1"
        " or (select count(*) from int_county_screening_threshold) <> 1"
        " or (select count(distinct cms_year) from int_county_screening_threshold) <> 1"
        " or max(year) filter (is_latest_cms_year)"
        " <> (select max(cms_year) from int_county_screening_threshold)",
    ),
    "screening_national_threshold_fixed": (
        ("mart_county_screening", "int_county_screening_threshold"),
        "select state_fips from mart_county_screening group by 1"
        " having count(distinct dialysis_use_p75_threshold) <> 1"
        " or min(dialysis_use_p75_threshold) is distinct from"
        " (select dialysis_use_p75_threshold from int_county_screening_threshold)",
    ),
    "screening_reconciles_facts_and_lineage": (
        ("mart_county_screening", "fct_medicare_county_year", "fct_svi_county"),
        "select 1 from mart_county_screening m left join fct_medicare_county_year f"
        " on (f.county_fips, f.year) = (m.county_fips, m.cms_year) left join fct_svi_county s"
        " on (s.county_fips, s.svi_vintage) = (m.county_fips, m.svi_vintage) where "
        + " or ".join(
            [f"m.{v} is distinct from {t}.{v} or m.{v}_status <> {t}.{v}_status"
             for t, v in (("f", "benes_om_cnt"), ("f", "benes_op_dlys_pct"), ("s", "rpl_themes"))]
            + [f"m.{p}_{n} <> {t}.{n}" for t, p, h in
               (("f", "cms", "source_content_sha256"), ("s", "svi", "source_snapshot_sha256"))
               for n in ("source_manifest_run_id", h)]
            + [_bad_hash(f"m.{n}") for n in
               ("input_set_sha256", "cms_source_content_sha256", "svi_source_snapshot_sha256")]
        ),
    ),
    "screening_row_count_reconciles": (
        ("mart_county_screening", "dim_county", "int_county_screening_threshold"),
        "select 1 from mart_county_screening having count(*) <>"
        " (select count_if(is_current_county) from dim_county)"
        " or count_if(is_dialysis_use_threshold_eligible) <>"
        " (select threshold_eligible_count from int_county_screening_threshold)",
    ),
    "screening_rows_current_and_reconciled": (
        ("mart_county_screening", "dim_county"),
        "select 1 from mart_county_screening m left join dim_county d"
        " on m.county_fips = d.county_fips where coalesce(not d.is_current_county, true)"
        " or m.geography_status <> 'current_in_scope' or m.reconciliation_status <> 'matched'"
        " or m.cms_reconciliation_row_count <> 1 or m.svi_reconciliation_row_count <> 1",
    ),
    "screening_summary_reconciles": (
        ("mart_county_screening", "audit_screening_quadrant_summary"),
        "select 1 from audit_screening_quadrant_summary s left join (select screening_quadrant,"
        " count(*) as n from mart_county_screening group by 1) q using (screening_quadrant),"
        " (select count(*) as n, count_if(screening_data_status = 'complete') as c,"
        " count_if(is_higher_observed_dialysis_use) as hu,"
        " count_if(not is_higher_observed_dialysis_use) as lu,"
        " count_if(is_higher_social_vulnerability) as hv,"
        " count_if(not is_higher_social_vulnerability) as lv from mart_county_screening) m"
        " having count(*) <> 5 or count_if(screening_row_count <> coalesce(q.n, 0)) > 0"
        " or count_if((total_screening_row_count, complete_data_count, insufficient_data_count,"
        " higher_use_count, lower_use_count, higher_vulnerability_count, lower_vulnerability_count)"
        " <> (m.n, m.c, m.n - m.c, m.hu, m.lu, m.hv, m.lv)) > 0"
        " or count_if(threshold_eligible_count <> m.hu + m.lu"
        " or threshold_eligible_count + threshold_excluded_count <> m.n) > 0",
    ),
    "screening_threshold_valid": (
        ("int_county_screening_threshold",),
        _rows(
            "int_county_screening_threshold",
            f"screening_definition_version <> '{C.SCREENING_VERSION}'",
            "threshold_metric <> 'BENES_OP_DLYS_PCT' or threshold_quantile <> 0.75",
            "threshold_method <> 'continuous_linear_type_7'",
            "current_county_count <> threshold_eligible_count + threshold_excluded_count",
            "threshold_eligible_count < 1 or threshold_excluded_count < 0",
            "dialysis_use_p75_threshold < 0 or dialysis_use_p75_threshold > 1",
            _bad_hash("input_set_sha256"), _bad_hash("cms_source_content_sha256"),
            _bad_hash("svi_source_snapshot_sha256"),
        ),
    ),
}


def report_sql(names) -> str:
    """One row per assertion: its name and its number of violating rows."""
    needed = {r for n in names for r in SQL[n][0]}
    parts = [
        f"select '{n}' as assertion, count(*) as violations from ({SQL[n][1]}) as found"
        for n in names
    ]
    return with_relations(needed, "\nunion all ".join(parts))
