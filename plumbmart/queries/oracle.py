"""SQL statements for DuckDB that say, independently, what each query returns."""

from __future__ import annotations

from plumbmart.plans.relations import RELATIONS
from plumbmart.queries.inputs import INPUTS, duckdb_ctes
from plumbmart.sources import contracts as C

HASH = "'[0-9a-f]{64}'"
ABROAD = "(" + ", ".join(f"'{p}'" for p in C.TERRITORY_PREFIXES) + ")"


# -- typing ------------------------------------------------------------------------


def count_sql(x: str) -> str:
    return f"case when regexp_full_match(trim({x}), '[0-9]+') then try_cast(trim({x}) as decimal(38,0)) end"


def rate_sql(x: str) -> str:
    return f"try_cast(trim({x}) as decimal(38,10))"


def gap_status(x: str, value: str) -> str:
    return (
        f"case when ({value}) is not null then 'reported'"
        f" else case coalesce(upper(trim({x})), '') when '' then 'unavailable_blank'"
        " when '*' then 'suppressed' when 'NA' then 'unavailable_na'"
        " else 'invalid_numeric' end end"
    )


def score_sql(x: str) -> str:
    return f"try_cast(nullif(trim({x}), '-999') as decimal(18,10))"


def score_status(x: str) -> str:
    return (
        f"case when {x} is null then 'unavailable_null'"
        f" when nullif(trim({x}), '-999') is null then 'unavailable_sentinel'"
        f" when {score_sql(x)} is not null then 'reported' else 'invalid_numeric' end"
    )


def triple_sql(x: str, name: str, kind: str) -> str:
    if kind == "score":
        value, status = score_sql(x), score_status(x)
    else:
        value = count_sql(x) if kind == "count" else rate_sql(x)
        status = gap_status(x, value)
    return f"{x} as {name}_raw, {value} as {name}, {status} as {name}_status"


_MEDICARE = ", ".join(
    [
        "cast(YEAR as integer) as year",
        "BENE_GEO_LVL as source_geography_level",
        "BENE_GEO_DESC as source_geography_description",
        "BENE_GEO_CD as source_geography_code",
        "BENE_AGE_LVL as source_age_level",
        *(triple_sql(m.upper(), m, kind) for m, kind, _ in C.MEDICARE_METRICS),
        *C.MEDICARE_LINEAGE,
    ]
)

_IS_DISTRICT = "BENE_GEO_LVL = 'State' and upper(trim(BENE_GEO_DESC)) = 'DC' and trim(BENE_GEO_CD) = '11'"
_IS_COUNTY = (
    f"BENE_GEO_LVL = 'County' and left(BENE_GEO_CD, 2) not in {ABROAD} and not"
    " (trim(BENE_GEO_CD) similar to '[0-9]{2}000'"
    " and upper(trim(BENE_GEO_DESC)) similar to '[A-Z]{2}-UNKNOWN')"
)


def code_status(x: str, star: bool) -> str:
    extra = ", '260', '261', '281'" if star else ""
    return (
        f"case when trim({x}) = '001' then 'available' when trim({x}) in"
        f" ('199', '201', '255', '258', '270', '280'{extra}) then 'not_available'"
        " else 'invalid' end"
    )


def code_reason(x: str) -> str:
    return (
        f"case trim({x}) when '199' then 'insufficient_patients' when '201' then 'data_not_reported'"
        " when '255' then 'inaccurate_measure' when '258' then 'insufficient_history'"
        " when '260' then 'insufficient_star_data' when '261' then 'inaccurate_star_component'"
        " when '270' then 'disaster_suppression' when '280' then 'external_factors'"
        " when '281' then 'external_factors_star_rating' end"
    )


def period_sql(x: str, part: int) -> str:
    return f"cast(try_strptime(split_part(trim({x}), '-', {part}), '%d%b%Y') as date)"


def _facility_sql() -> str:
    def q(header: str) -> str:
        return f'"{header}"'

    def period(prefix: str, x: str) -> list[str]:
        return [
            f"{x} as {prefix}_period_raw",
            f"{period_sql(x, 1)} as {prefix}_period_start",
            f"{period_sql(x, 2)} as {prefix}_period_end",
        ]

    def availability(prefix: str, x: str, star: bool) -> list[str]:
        return [
            f"{x} as {prefix}_availability_code",
            f"{code_status(x, star)} as {prefix}_availability_status",
            f"{code_reason(x)} as {prefix}_unavailability_reason",
        ]

    out = [f"{q(h)} as {n}" for n, h in C.FACILITY_IDENTITY]
    for n, h in C.FACILITY_YES_NO:
        out += [
            f"{q(h)} as {n}_raw",
            f"case when lower(trim({q(h)})) in ('yes', 'no') then lower(trim({q(h)})) = 'yes' end as {n}",
        ]
    stations, certified = q(C.STATIONS_HEADER), q(C.CERTIFIED_HEADER)
    code, star = q(C.STAR_HEADERS["availability"]), q(C.STAR_HEADERS["rating"])
    out += [
        f"{q(C.CHAIN_HEADER)} as chain_organization",
        f"{stations} as dialysis_stations_raw",
        f"try_cast(nullif(trim({stations}), '') as integer) as dialysis_stations",
        f"{certified} as certification_date_raw",
        f"try_cast(nullif(trim({certified}), '') as date) as certification_date",
        *period("five_star", q(C.STAR_HEADERS["period"])),
        f"{star} as five_star_rating_raw",
        f"case when trim({code}) = '001' then try_cast(nullif(trim({star}), '') as integer) end"
        " as five_star_rating",
        *availability("five_star", code, True),
    ]
    types = {
        "denominator": "bigint", "estimate": "decimal(18,10)",
        "lower_confidence_limit": "decimal(18,10)", "upper_confidence_limit": "decimal(18,10)",
    }
    for family, h in C.OUTCOME_HEADERS.items():
        code, category = q(h["availability"]), q(h["category"])
        known = ", ".join(f"'{c}'" for c in ("better than expected", "as expected", "worse than expected"))
        out += period(family, q(h["period"])) + availability(family, code, False)
        out += [
            f"{category} as {family}_category_raw",
            f"case when trim({code}) = '001' and lower(trim({category})) in ({known})"
            f" then replace(lower(trim({category})), ' ', '_') end as {family}_category",
        ]
        for role, type_ in types.items():
            x = q(h[role])
            out += [
                f"{x} as {family}_{role}_raw",
                f"case when trim({code}) = '001' then try_cast(nullif(trim({x}), '') as {type_}) end"
                f" as {family}_{role}",
            ]
    return ", ".join([*out, *C.FACILITY_LINEAGE])


# -- models: name -> (relations it reads, SQL) ----------------------------------------

_ELIGIBLE = "benes_op_dlys_pct_status = 'reported' and benes_op_dlys_pct is not null"
_LATEST = "(select max(year) from fct_medicare_county_year)"

_AUDIT_SOURCE = (
    '{{"contract_version":"{contract}","manifest_run_id":"derived-{label}-run",'
    '"page_count":\' || {pages} || \',"row_count":\' || {rows} || \','
    '"snapshot_sha256":"\' || sha256(\'{label}\') || \'","source_id":"{source}"}}'
)


def _audit_payload() -> str:
    parts = [
        _AUDIT_SOURCE.format(contract=c, label=label, pages=f"{p}_pages", rows=f"{p}_rows", source=s)
        for s, c, label, p in (
            (C.VULNERABILITY, C.VULNERABILITY_CONTRACT, "vulnerability", "svi"),
            (C.FACILITY, C.FACILITY_CONTRACT, "facility", "facility"),
            (C.MEDICARE, C.MEDICARE_CONTRACT, "medicare", "cms"),
        )
    ]
    return "'{\"build_format_version\":2,\"sources\":[" + ",".join(parts) + "]}' || chr(10)"


def _audit_columns(p: str, source: str, contract: str, label: str, hash_name: str) -> str:
    return (
        f"'{source}' as {p}_source_id, 'derived-{label}-run' as {p}_manifest_run_id,"
        f" '{contract}' as {p}_contract_version, sha256('{label}') as {p}_{hash_name},"
        f" '2026-08-15T01:50:00Z' as {p}_retrieved_at_utc,"
        f" cast({p}_pages as bigint) as {p}_page_count, {p}_rows as {p}_row_count"
    )


MODELS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_audit": (
        ("raw_medicare", "raw_vulnerability", "raw_facility"),
        f"select 2 as build_format_version, 'derived-build' as build_id,"
        f" sha256({_audit_payload()}) as input_set_sha256,"
        f" {_audit_columns('cms', C.MEDICARE, C.MEDICARE_CONTRACT, 'medicare', 'content_sha256')},"
        f" {_audit_columns('svi', C.VULNERABILITY, C.VULNERABILITY_CONTRACT, 'vulnerability', 'snapshot_sha256')},"
        f" {_audit_columns('facility', C.FACILITY, C.FACILITY_CONTRACT, 'facility', 'snapshot_sha256')}"
        " from (select (select count(*) from raw_medicare) as cms_rows, 1 as cms_pages,"
        " (select count(*) from raw_vulnerability) as svi_rows,"
        " (select count(distinct source_page_index) from raw_vulnerability) as svi_pages,"
        " (select count(*) from raw_facility) as facility_rows, 1 as facility_pages) as sizes",
    ),
    "stg_cms_om_gv_county_year": (
        ("raw_medicare",),
        "select if(BENE_GEO_LVL = 'State', '11001', BENE_GEO_CD) as county_fips,"
        " if(BENE_GEO_LVL = 'State', 'district_of_columbia_state_to_county_equivalent',"
        f" 'source_county_fips') as county_geography_mapping_method, {_MEDICARE}"
        f" from raw_medicare where BENE_AGE_LVL = 'All' and (({_IS_DISTRICT}) or ({_IS_COUNTY}))",
    ),
    "stg_cms_om_gv_benchmark_year": (
        ("raw_medicare",),
        "select lower(BENE_GEO_LVL) as benchmark_geography_type,"
        " if(BENE_GEO_LVL = 'State', trim(BENE_GEO_CD), 'US') as benchmark_geography_key,"
        f" {_MEDICARE} from raw_medicare where BENE_AGE_LVL = 'All' and case BENE_GEO_LVL"
        " when 'State' then trim(BENE_GEO_CD) similar to '[0-9]{2}'"
        f" and trim(BENE_GEO_CD) not in {ABROAD}"
        " when 'National' then upper(trim(BENE_GEO_DESC)) = 'NATIONAL'"
        " and trim(coalesce(BENE_GEO_CD, '')) = '' end",
    ),
    "stg_cdc_svi_county_2022": (
        ("raw_vulnerability",),
        "select STCNTY as county_fips, ST as state_fips, STATE as state_name,"
        " ST_ABBR as state_abbreviation, COUNTY as county_name,"
        " cast(GRASP_ID as integer) as source_object_id, 2022 as svi_vintage,"
        " 2018 as acs_period_start, 2022 as acs_period_end, "
        + ", ".join(triple_sql(m.upper(), m, "score") for m in C.VULNERABILITY_METRICS)
        + ", " + ", ".join((*C.SNAPSHOT_LINEAGE, *C.PAGE_LINEAGE))
        + " from raw_vulnerability",
    ),
    "stg_cms_dialysis_facility": (("raw_facility",), f"select {_facility_sql()} from raw_facility"),
    "dim_county": (
        ("stg_cdc_svi_county_2022", "stg_cms_om_gv_county_year", "historical"),
        "select s.county_fips, s.state_fips, s.state_name, s.state_abbreviation, s.county_name,"
        " 'current_in_scope' as geography_status, true as is_current_county,"
        " s.svi_vintage as svi_geography_vintage, y.lo as observed_cms_start_year,"
        " y.hi as observed_cms_end_year, cast(null as varchar) as boundary_discontinuity_warning,"
        f" s.source_id as geography_source_id, '{C.VULNERABILITY_CONTRACT}' as geography_source_version,"
        " s.source_manifest_run_id as geography_source_manifest_run_id,"
        " s.source_snapshot_sha256 as geography_source_snapshot_sha256"
        " from stg_cdc_svi_county_2022 s left join (select county_fips, min(year) as lo,"
        " max(year) as hi from stg_cms_om_gv_county_year group by 1) y"
        " on y.county_fips = s.county_fips union all"
        " select county_fips, state_fips, state_name, state_abbreviation, county_name,"
        " geography_status, is_current_county, null, observed_cms_start_year,"
        " observed_cms_end_year, boundary_discontinuity_warning,"
        f" '{C.HISTORICAL_SOURCE}', seed_version, '{C.HISTORICAL_RUN}', null from historical",
    ),
    "dim_year": (
        ("stg_cms_om_gv_county_year", "stg_cms_om_gv_benchmark_year"),
        "select year, year = (select max(y) from (select max(year) as y from"
        " stg_cms_om_gv_county_year union all select max(year) from stg_cms_om_gv_benchmark_year))"
        " as is_latest_cms_year from (select distinct year from stg_cms_om_gv_county_year union"
        " select distinct year from stg_cms_om_gv_benchmark_year)",
    ),
    "dim_facility": (
        ("stg_cms_dialysis_facility",),
        "select * from (select *, cast(null as varchar) as county_fips,"
        " 'not_attempted' as geography_match_status, cast(null as varchar) as geography_match_method,"
        " cast(null as date) as geography_resolution_date,"
        " 'facility geography assignment is deferred' as geography_provenance"
        " from stg_cms_dialysis_facility)",
    ),
    "fct_medicare_county_year": (("stg_cms_om_gv_county_year",), "from stg_cms_om_gv_county_year"),
    "fct_medicare_benchmark_year": (
        ("stg_cms_om_gv_benchmark_year",), "from stg_cms_om_gv_benchmark_year"
    ),
    "fct_svi_county": (("stg_cdc_svi_county_2022",), "from stg_cdc_svi_county_2022"),
    "fct_facility_quality_snapshot": (
        ("stg_cms_dialysis_facility",), "from stg_cms_dialysis_facility"
    ),
    "audit_cms_svi_county_reconciliation": (
        ("fct_medicare_county_year", "fct_svi_county"),
        "select county_fips, case when c = 0 then 'svi_only' when s = 0 then 'cms_only'"
        " when c > 1 and s > 1 then 'duplicate_both' when c > 1 then 'cms_duplicate'"
        " when s > 1 then 'svi_duplicate' else 'matched' end as reconciliation_status,"
        " c > 0 as cms_present, s > 0 as svi_present, c as cms_row_count, s as svi_row_count,"
        " cms_latest_year, cms_source_manifest_run_id, cms_source_content_sha256,"
        " cms_source_modified_at, svi_vintage, svi_source_manifest_run_id,"
        " svi_source_snapshot_sha256, svi_source_modified_at from"
        " (select county_fips, count(*) filter (side = 'c') as c, count(*) filter (side = 's') as s"
        f" from (select county_fips, 'c' as side from fct_medicare_county_year where year = {_LATEST}"
        " union all select county_fips, 's' from fct_svi_county) group by 1),"
        " (select distinct year as cms_latest_year,"
        " source_manifest_run_id as cms_source_manifest_run_id,"
        " source_content_sha256 as cms_source_content_sha256,"
        f" source_modified_at as cms_source_modified_at from fct_medicare_county_year where year = {_LATEST}),"
        " (select distinct svi_vintage, source_manifest_run_id as svi_source_manifest_run_id,"
        " source_snapshot_sha256 as svi_source_snapshot_sha256,"
        " source_modified_at as svi_source_modified_at from fct_svi_county)",
    ),
    "int_county_screening_threshold": (
        ("raw_audit", "dim_year", "dim_county", "fct_medicare_county_year", "fct_svi_county"),
        f"select '{C.SCREENING_VERSION}' as screening_definition_version,"
        " build_id as screening_run_id, input_set_sha256, build_format_version,"
        " (select year from dim_year where is_latest_cms_year) as cms_year, svi_vintage,"
        " 'BENES_OP_DLYS_PCT' as threshold_metric, cast(0.75 as decimal(3,2)) as threshold_quantile,"
        " 'continuous_linear_type_7' as threshold_method, m.* , cms.*, svi.* exclude (svi_vintage)"
        " from raw_audit, (select cast(quantile_cont(case when ok then benes_op_dlys_pct end, 0.75)"
        " as decimal(38,10)) as dialysis_use_p75_threshold, count(*) as current_county_count,"
        " count_if(ok) as threshold_eligible_count, count_if(not ok) as threshold_excluded_count"
        f" from (select benes_op_dlys_pct, ({_ELIGIBLE}) as ok from fct_medicare_county_year f"
        " join dim_county d on d.county_fips = f.county_fips and d.is_current_county"
        " where f.year in (select year from dim_year where is_latest_cms_year))) m,"
        " (select distinct source_manifest_run_id as cms_source_manifest_run_id,"
        " source_content_sha256 as cms_source_content_sha256,"
        " source_retrieved_at_utc as cms_source_retrieved_at_utc,"
        " source_modified_at as cms_source_modified_at from fct_medicare_county_year"
        f" where year = {_LATEST}) cms,"
        " (select distinct svi_vintage, source_manifest_run_id as svi_source_manifest_run_id,"
        " source_snapshot_sha256 as svi_source_snapshot_sha256,"
        " source_retrieved_at_utc as svi_source_retrieved_at_utc,"
        " source_modified_at as svi_source_modified_at from fct_svi_county) svi",
    ),
    "mart_county_screening": (
        ("int_county_screening_threshold", "dim_county", "fct_medicare_county_year",
         "fct_svi_county", "audit_cms_svi_county_reconciliation"),
        "select *, use_ok as is_dialysis_use_threshold_eligible,"
        " case when use_ok then use_high end as is_higher_observed_dialysis_use,"
        " case when not use_ok then 'insufficient_data' when use_high then 'higher_use'"
        " else 'lower_use' end as dialysis_use_band,"
        " case when vul_ok then vul_high end as is_higher_social_vulnerability,"
        " case when not vul_ok then 'insufficient_data' when vul_high then 'higher_vulnerability'"
        " else 'lower_vulnerability' end as social_vulnerability_band,"
        " if(use_ok and vul_ok, 'complete', 'insufficient_data') as screening_data_status,"
        " case (case when use_ok then 0 else 1 end) + (case when vul_ok then 0 else 2 end)"
        " when 1 then 'dialysis_use_component_unavailable'"
        " when 2 then 'social_vulnerability_component_unavailable'"
        " when 3 then 'both_components_unavailable' end as screening_insufficient_reason,"
        " case when use_ok and vul_ok then (case when use_high then 'higher' else 'lower' end)"
        " || '_use_' || (case when vul_high then 'higher' else 'lower' end) || '_vulnerability'"
        " else 'insufficient_data' end as screening_quadrant"
        " from (select d.county_fips, d.state_fips, d.state_name, d.state_abbreviation,"
        " d.county_name, d.geography_status, d.boundary_discontinuity_warning,"
        " r.reconciliation_status, r.cms_row_count as cms_reconciliation_row_count,"
        " r.svi_row_count as svi_reconciliation_row_count, t.screening_definition_version,"
        " t.screening_run_id, t.input_set_sha256, t.cms_year, t.svi_vintage,"
        " t.dialysis_use_p75_threshold, t.threshold_eligible_count, s.acs_period_start,"
        " s.acs_period_end, f.benes_om_cnt, f.benes_om_cnt_status, f.benes_op_dlys_pct,"
        " f.benes_op_dlys_pct_status, s.rpl_themes, s.rpl_themes_status,"
        + "".join(
            f" {a}.{n} as {p}_{n},"
            for a, p, h in (("f", "cms", "source_content_sha256"), ("s", "svi", "source_snapshot_sha256"))
            for n in ("source_manifest_run_id", h, "source_retrieved_at_utc", "source_modified_at")
        )
        + " f.benes_op_dlys_pct is not null and coalesce(f.benes_op_dlys_pct_status, '') = 'reported'"
        " as use_ok, s.rpl_themes is not null and coalesce(s.rpl_themes_status, '') = 'reported'"
        " as vul_ok, f.benes_op_dlys_pct >= t.dialysis_use_p75_threshold as use_high,"
        " s.rpl_themes >= 0.75 as vul_high"
        " from int_county_screening_threshold t join dim_county d on d.is_current_county"
        " left join fct_medicare_county_year f on f.county_fips = d.county_fips and f.year = t.cms_year"
        " left join fct_svi_county s on s.county_fips = d.county_fips and s.svi_vintage = t.svi_vintage"
        " left join audit_cms_svi_county_reconciliation r on r.county_fips = d.county_fips)",
    ),
    "audit_screening_quadrant_summary": (
        ("int_county_screening_threshold", "mart_county_screening"),
        "select t.*, c.*, (select count(*) from mart_county_screening m"
        " where m.screening_quadrant = c.screening_quadrant) as screening_row_count, n.*"
        " from int_county_screening_threshold t, (values "
        + ", ".join(f"({i}, '{q}')" for i, q in C.QUADRANTS)
        + ") c(category_display_order, screening_quadrant),"
        " (select count(*) as total_screening_row_count,"
        " count_if(screening_data_status = 'complete') as complete_data_count,"
        " count_if(screening_data_status = 'insufficient_data') as insufficient_data_count,"
        " count_if(dialysis_use_band = 'higher_use') as higher_use_count,"
        " count_if(dialysis_use_band = 'lower_use') as lower_use_count,"
        " count_if(social_vulnerability_band = 'higher_vulnerability') as higher_vulnerability_count,"
        " count_if(social_vulnerability_band = 'lower_vulnerability') as lower_vulnerability_count"
        " from mart_county_screening) n",
    ),
}


def _model_sql(name: str) -> str:
    text = MODELS[name][1]
    if name == "raw_audit":
        return text
    listed = ", ".join(
        f"cast({f.name} as bigint) as {f.name}" if f.type == "bigint" else f.name
        for f in RELATIONS[name]
    )
    if text.startswith("from "):
        return f"select {listed} {text}"
    return f"select {listed} from ({text}) as shaped"


def with_relations(names, final: str) -> str:
    """``final`` preceded by the CTEs of the named relations and their ancestors."""
    wanted = set(names)
    for name in reversed(MODELS):
        if name in wanted:
            wanted |= set(MODELS[name][0])
    ctes = duckdb_ctes([n for n in wanted if n in INPUTS])
    ctes += [f"{n} as materialized ({_model_sql(n)})" for n in MODELS if n in wanted]
    return "with " + ",\n".join(ctes) + "\n" + final


def model_sql(name: str) -> str:
    return with_relations([name], f"select * from {name}")
