"""The named assertions of the mart, by area."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbmart.functions.tokens import full_match, is_blank
from plumbmart.operators import relational as R
from plumbmart.plans.quality import WEIGHT, RowRule, Rule, SetRule
from plumbmart.plans.relations import columns
from plumbmart.plans.screening import classify
from plumbmart.plans.staging import county_scope
from plumbmart.sources import contracts as C

COUNTY, BENCH = "stg_cms_om_gv_county_year", "stg_cms_om_gv_benchmark_year"
SVI, FAC = "stg_cdc_svi_county_2022", "stg_cms_dialysis_facility"
F_COUNTY, F_BENCH = "fct_medicare_county_year", "fct_medicare_benchmark_year"
F_SVI, F_FAC = "fct_svi_county", "fct_facility_quality_snapshot"
RECON, THRESHOLD = "audit_cms_svi_county_reconciliation", "int_county_screening_threshold"
MART, SUMMARY = "mart_county_screening", "audit_screening_quadrant_summary"
BUILD = "raw.build_input_audit"


def _any(conditions) -> Column:
    return reduce(or_, conditions)


def _all(conditions) -> Column:
    return reduce(and_, conditions)


def _c(name: str) -> Column:
    return F.col(name)


def _not_hash(name: str) -> Column:
    return ~full_match(name, C.HASH_PATTERN)


def _outside(name: str, low: int, high: int) -> Column:
    return ~_c(name).between(low, high)


def _grain(relation: str, *keys: str) -> SetRule:
    return SetRule((relation,), lambda df: R.grain_violations(df, keys))


def _same_rows(stage: str, fact: str) -> SetRule:
    return SetRule((stage, fact), lambda s, f: R.multiset_difference(s.select(*columns(fact)), f))


def _facts(county: DataFrame, bench: DataFrame) -> DataFrame:
    """Both Medicare facts under one key, for checks that span them."""
    metrics = [n for m, _, _ in C.MEDICARE_METRICS for n in (m, f"{m}_status")]
    return county.select(
        F.lit("county").alias("fact_type"), _c("county_fips").alias("geography_key"),
        "year", *metrics,
    ).unionByName(
        bench.select(
            _c("benchmark_geography_type").alias("fact_type"),
            _c("benchmark_geography_key").alias("geography_key"), "year", *metrics,
        )
    )


def _status_mismatch(metric: str, allowed: tuple[str, ...]) -> Column:
    status, present = _c(f"{metric}_status"), _c(metric).isNotNull()
    return ~status.isin(*allowed) | ((status == "reported") != present)


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


# -- build inputs ----------------------------------------------------------------


def _audit_singleton(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("build_id").alias("builds"),
        F.countDistinct("input_set_sha256").alias("input_sets"),
        F.count_if(~_c("build_format_version").isin(1, 2)).alias("unknown_formats"),
    ).where("row_count <> 1 or builds <> 1 or input_sets <> 1 or unknown_formats > 0")


def _unmatched_lineage(fact: DataFrame, audit: DataFrame, prefix: str, hash_name: str):
    pairs = {
        "source_id": f"{prefix}_source_id",
        "source_manifest_run_id": f"{prefix}_manifest_run_id",
        f"source_{hash_name}": f"{prefix}_{hash_name}",
        "source_retrieved_at_utc": f"{prefix}_retrieved_at_utc",
    }
    return R.orphan_rows(fact.select(*pairs).distinct(), audit, list(pairs.items()))


def _build_lineage(audit: DataFrame, county: DataFrame, svi: DataFrame) -> DataFrame:
    wrong = _any(
        [
            _c("cms_source_id") != C.MEDICARE,
            _c("cms_contract_version") != C.MEDICARE_CONTRACT,
            _c("svi_source_id") != C.VULNERABILITY,
            _c("svi_contract_version") != C.VULNERABILITY_CONTRACT,
            *map(_not_hash, ("input_set_sha256", "cms_content_sha256", "svi_snapshot_sha256")),
            *(_c(f"{s}_{n}_count") < 1 for s in ("cms", "svi") for n in ("page", "row")),
        ]
    )
    reason = F.lit(None).cast("string").alias("problem")
    parts = [
        audit.where(wrong).select(reason),
        _unmatched_lineage(county, audit, "cms", "content_sha256").select(reason),
        _unmatched_lineage(svi, audit, "svi", "snapshot_sha256").select(reason),
    ]
    return reduce(DataFrame.union, parts)


BUILD_RULES: dict[str, Rule] = {
    "build_input_audit_singleton": SetRule((BUILD,), _audit_singleton),
    "build_input_lineage_reconciles_facts": SetRule((BUILD, F_COUNTY, F_SVI), _build_lineage),
}


# -- Medicare --------------------------------------------------------------------


def _invalid_numeric() -> Column:
    return _any(_c(f"{m}_status") == "invalid_numeric" for m, _, _ in C.MEDICARE_METRICS)


def _bench_scope() -> Column:
    kind, key = _c("benchmark_geography_type"), _c("benchmark_geography_key")
    blank = F.coalesce("source_geography_code", F.lit("")) == ""
    return _any(
        [
            _c("source_age_level") != "All",
            ~kind.isin("state", "national"),
            (kind == "state") & ~full_match(key, "[0-9]{2}"),
            (kind == "national") & ((key != "US") | ~blank),
        ]
    )


def _county_fips_valid() -> Column:
    label = F.upper(F.trim("source_geography_description"))
    return ~full_match("county_fips", "[0-9]{5}") | (
        full_match(label, "DC-.*") & (_c("county_fips") != C.DISTRICT_COUNTY)
    )


def _county_scope() -> Column:
    label = F.upper(F.trim("source_geography_description"))
    level, code = _c("source_geography_level"), _c("source_geography_code")
    district = _all(
        [level == "State", _c("county_fips") == C.DISTRICT_COUNTY,
         code == C.DISTRICT_STATE, label == "DC"]
    )
    return _any(
        [
            _c("source_age_level") != "All",
            ~_c("county_geography_mapping_method").isin(
                "source_county_fips", "district_of_columbia_state_to_county_equivalent"
            ),
            ~((level == "County") | district),
            F.substring("county_fips", 1, 2).isin(*C.TERRITORY_PREFIXES),
            full_match(F.trim(code), "[0-9]{2}000") & full_match(label, "[A-Z]{2}-UNKNOWN"),
        ]
    )


def _district_unambiguous(stage: DataFrame) -> DataFrame:
    method = _c("county_geography_mapping_method")
    return (
        stage.where(_c("county_fips") == C.DISTRICT_COUNTY)
        .groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("candidates"),
            F.bool_or(method.startswith("district_of_columbia")).alias("from_state"),
            F.bool_or(method == "source_county_fips").alias("from_county"),
        )
        .where("candidates > 1 and from_state and from_county")
    )


def _users_above(county: DataFrame, bench: DataFrame) -> DataFrame:
    return _facts(county, bench).where("benes_op_dlys_cnt > benes_om_cnt")


def _fact_lineage_constant(county: DataFrame, bench: DataFrame) -> DataFrame:
    names = C.MEDICARE_LINEAGE
    lineage = county.select(*names).distinct().union(bench.select(*names).distinct()).distinct()
    return lineage.agg(
        F.count(F.lit(1)).alias("lineage_set_count"),
        F.min("source_id").alias("source_id"),
        F.min("source_content_sha256").alias("sha"),
    ).where((_c("lineage_set_count") != 1) | (_c("source_id") != C.MEDICARE) | _not_hash("sha"))


def _fact_bounds(county: DataFrame, bench: DataFrame) -> DataFrame:
    allowed = ("reported", "suppressed", "unavailable_blank", "unavailable_na")
    broken = [
        _outside(m, 0, 1) if share else _c(m) < 0 for m, _, share in C.MEDICARE_METRICS
    ] + [_status_mismatch(m, allowed) for m, _, _ in C.MEDICARE_METRICS]
    return _facts(county, bench).where(_any(broken))


def _lineage_missing() -> Column:
    return _any(
        [
            _c("source_id") != C.MEDICARE,
            is_blank("source_manifest_run_id"),
            _not_hash("source_content_sha256"),
            is_blank("source_retrieved_at_utc"),
        ]
    )


def _stage_matches_raw(raw: DataFrame, stage: DataFrame) -> DataFrame:
    expected = raw.where(county_scope()).agg(F.count(F.lit(1)).alias("expected_rows"))
    return expected.withColumn("actual_rows", _count(stage)).where("expected_rows <> actual_rows")


def _years_match(county: DataFrame, bench: DataFrame, years: DataFrame) -> DataFrame:
    observed = county.select("year").union(bench.select("year")).distinct()
    return R.set_difference(observed, years.select("year"))


def _one_latest(years: DataFrame) -> DataFrame:
    return years.agg(
        F.count_if("is_latest_cms_year").alias("flags"),
        F.max("year").alias("newest"),
        F.max(F.when(_c("is_latest_cms_year"), _c("year"))).alias("flagged"),
    ).where("flags <> 1 or newest <> flagged")


MEDICARE_RULES: dict[str, Rule] = {
    "cms_benchmark_fact_grain_unique": _grain(
        F_BENCH, "benchmark_geography_type", "benchmark_geography_key", "year"
    ),
    "cms_benchmark_fact_reconciles_stage": _same_rows(BENCH, F_BENCH),
    "cms_benchmark_grain_unique": _grain(
        BENCH, "benchmark_geography_type", "benchmark_geography_key", "year"
    ),
    "cms_benchmark_numeric_values_valid": RowRule(BENCH, _invalid_numeric),
    "cms_benchmark_scope": RowRule(BENCH, _bench_scope),
    "cms_county_fact_geography_resolves": SetRule(
        (F_COUNTY, "dim_county"),
        lambda f, d: f.join(d.select("county_fips"), "county_fips", "left_anti"),
    ),
    "cms_county_fact_grain_unique": _grain(F_COUNTY, "county_fips", "year"),
    "cms_county_fact_reconciles_stage": _same_rows(COUNTY, F_COUNTY),
    "cms_county_fips_valid": RowRule(COUNTY, _county_fips_valid),
    "cms_county_scope": RowRule(COUNTY, _county_scope),
    "cms_county_year_unique": _grain(COUNTY, "county_fips", "year"),
    "cms_dc_county_equivalent_unambiguous": SetRule((COUNTY,), _district_unambiguous),
    "cms_dialysis_users_not_above_beneficiaries": SetRule((F_COUNTY, F_BENCH), _users_above),
    "cms_fact_lineage_constant": SetRule((F_COUNTY, F_BENCH), _fact_lineage_constant),
    "cms_fact_metric_bounds_and_status": SetRule((F_COUNTY, F_BENCH), _fact_bounds),
    "cms_lineage_present": RowRule(COUNTY, _lineage_missing),
    "cms_numeric_values_valid": RowRule(COUNTY, _invalid_numeric),
    "cms_stage_reconciles_selected_raw": SetRule(
        (f"raw.{C.MEDICARE}", COUNTY), _stage_matches_raw
    ),
    "dim_year_has_one_latest": SetRule(("dim_year",), _one_latest),
    "dim_year_reconciles_facts": SetRule((F_COUNTY, F_BENCH, "dim_year"), _years_match),
}


# -- vulnerability index and county dimension ----------------------------------------


def _reconciled() -> Column:
    return _any(
        [
            _c("reconciliation_status") != "matched",
            ~_c("cms_present"),
            ~_c("svi_present"),
            _c("cms_row_count") != 1,
            _c("svi_row_count") != 1,
            _not_hash("cms_source_content_sha256"),
            _not_hash("svi_source_snapshot_sha256"),
        ]
    )


def _wrong_identity() -> list[Column]:
    state, county = _c("state_fips"), _c("county_fips")
    return [
        ~full_match(county, "[0-9]{5}"),
        ~full_match(state, "[0-9]{2}"),
        F.substring("county_fips", 1, 2) != state,
        state.isin(*C.TERRITORY_PREFIXES),
        (state == C.DISTRICT_STATE) & (county != C.DISTRICT_COUNTY),
    ]


def _dim_county_valid() -> Column:
    current, status = _c("is_current_county"), _c("geography_status")
    start, end = _c("observed_cms_start_year"), _c("observed_cms_end_year")
    source, version = _c("geography_source_id"), _c("geography_source_version")
    bad_current = [
        status != "current_in_scope",
        _c("svi_geography_vintage") != C.VULNERABILITY_VINTAGE,
        _c("boundary_discontinuity_warning").isNotNull(),
        source != C.VULNERABILITY,
        version != C.VULNERABILITY_CONTRACT,
        _not_hash("geography_source_snapshot_sha256"),
    ]
    bad_historical = [
        status != "historical_source_only",
        _c("svi_geography_vintage").isNotNull(),
        start.isNull() | end.isNull() | (start > end),
        _c("boundary_discontinuity_warning").isNull(),
        source != C.HISTORICAL_SOURCE,
        version != C.HISTORICAL_VERSION,
        _c("geography_source_manifest_run_id") != C.HISTORICAL_RUN,
        _c("geography_source_snapshot_sha256").isNotNull(),
    ]
    return _any(
        [
            *_wrong_identity(),
            ~status.isin("current_in_scope", "historical_source_only"),
            current & _any(bad_current),
            ~current & _any(bad_historical),
        ]
    )


def _svi_fips_valid() -> Column:
    blanks = [is_blank(n) for n in ("state_name", "state_abbreviation", "county_name")]
    return _any([*_wrong_identity(), *blanks, _c("source_object_id") <= 0])


def _svi_lineage() -> Column:
    return _any(
        [
            _c("source_id") != C.VULNERABILITY,
            is_blank("source_manifest_run_id"),
            _not_hash("source_snapshot_sha256"),
            is_blank("source_retrieved_at_utc"),
            _c("source_page_index") < 0,
            _c("source_page_offset") < 0,
            _not_hash("source_page_sha256"),
            _c("svi_vintage") != C.VULNERABILITY_VINTAGE,
            _c("acs_period_start") != C.ACS_START,
            _c("acs_period_end") != C.ACS_END,
        ]
    )


def _svi_values() -> Column:
    allowed = ("reported", "unavailable_sentinel", "unavailable_null")

    def broken(m: str) -> Column:
        raw, status = _c(f"{m}_raw"), _c(f"{m}_status")
        return (
            _status_mismatch(m, allowed)
            | (raw.isNull() & (status != "unavailable_null"))
            | ((F.trim(raw) == "-999") & (status != "unavailable_sentinel"))
        )

    return _any(broken(m) for m in C.VULNERABILITY_METRICS)


def _svi_cells(stage: DataFrame, fact: DataFrame) -> DataFrame:
    keys = ("county_fips", "svi_vintage")
    return R.cell_differences(stage, fact, keys, [c for c in columns(F_SVI) if c not in keys])


def _svi_raw(raw: DataFrame, stage: DataFrame) -> DataFrame:
    sha = "source_snapshot_sha256"

    def summary(df: DataFrame, key: str) -> DataFrame:
        # counted per key first: one shuffle, and no copy of the rows per distinct count
        per_key = df.groupBy(key).agg(
            F.count(F.lit(1)).alias("n"), F.min(sha).alias("low"), F.max(sha).alias("high")
        )
        return per_key.agg(
            F.sum("n").alias("n"),
            F.count(key).alias("keys"),
            F.coalesce(F.min("low") == F.max("high"), F.lit(False)).alias("one_snapshot"),
        )

    both = summary(raw, "STCNTY").withColumn("stage", R.one_row(summary(stage, "county_fips")))
    return both.where(
        "n <> stage.n or keys <> stage.keys or not one_snapshot or not stage.one_snapshot"
    )


VULNERABILITY_RULES: dict[str, Rule] = {
    "cms_svi_latest_current_reconciled": RowRule(RECON, _reconciled),
    "dim_county_geography_valid": RowRule("dim_county", _dim_county_valid),
    "historical_county_identities_do_not_overlap_current": SetRule(
        ("historical_county_identities", SVI),
        lambda h, s: R.shared_rows(h, s, ["county_fips"]),
    ),
    "svi_county_fips_unique": _grain(SVI, "county_fips"),
    "svi_county_fips_valid": RowRule(SVI, _svi_fips_valid),
    "svi_fact_grain_unique": _grain(F_SVI, "county_fips", "svi_vintage"),
    "svi_fact_reconciles_stage": SetRule((SVI, F_SVI), _svi_cells),
    "svi_lineage_present": RowRule(SVI, _svi_lineage),
    "svi_numeric_values_valid": RowRule(SVI, _svi_values),
    "svi_percentage_bounds": RowRule(SVI, lambda: _any(_outside(m, 0, 100) for m in C.PERCENTAGES)),
    "svi_rank_bounds": RowRule(SVI, lambda: _any(_outside(m, 0, 1) for m in C.RANKS)),
    "svi_stage_reconciles_raw": SetRule((f"raw.{C.VULNERABILITY}", SVI), _svi_raw),
}


# -- facilities -------------------------------------------------------------------


def _facility_codes() -> Column:
    return _any(
        _c(f"{p}_availability_status") == "invalid" for p in ("five_star", *C.FAMILIES)
    )


def _facility_characteristics() -> Column:
    return _any(
        [
            _c("dialysis_stations").isNull(),
            _c("dialysis_stations") < 0,
            *(~F.lower(F.trim(f"{n}_raw")).isin("yes", "no") for n, _ in C.FACILITY_YES_NO),
            _c("certification_date").isNull(),
        ]
    )


def _per_family(condition):
    """One violating row per facility and outcome family."""

    def run(stage: DataFrame) -> DataFrame:
        hits = [
            F.when((_c(f"{f}_availability_status") == "available") & condition(f), F.lit(f))
            for f in C.FAMILIES
        ]
        return stage.select(
            "ccn", F.explode(F.array_compact(F.array(*hits))).alias("measure_family")
        )

    return SetRule((FAC,), run)


def _interval_broken(f: str) -> Column:
    estimate = _c(f"{f}_estimate")
    return ~(
        (_c(f"{f}_lower_confidence_limit") <= estimate)
        & (estimate <= _c(f"{f}_upper_confidence_limit"))
    )


def _companions_missing(f: str) -> Column:
    numbers = ("denominator", "estimate", "lower_confidence_limit", "upper_confidence_limit")
    known = ("better_than_expected", "as_expected", "worse_than_expected")
    return _any(
        [
            _c(f"{f}_period_start").isNull(),
            _c(f"{f}_period_end").isNull(),
            ~_c(f"{f}_category").isin(*known),
            *(_c(f"{f}_{n}").isNull() | (_c(f"{f}_{n}") < 0) for n in numbers),
        ]
    )


def _facility_fact(stage, dim, fact, audit) -> DataFrame:
    wanted = {
        "facility_source_id": C.FACILITY,
        "facility_contract_version": C.FACILITY_CONTRACT,
    }
    present = ("manifest_run_id", "snapshot_sha256", "retrieved_at_utc", "page_count", "row_count")
    wrong = _any(
        [
            _c("build_format_version") != 2,
            *(R.is_distinct(_c(n), F.lit(v)) for n, v in wanted.items()),
            *(_c(f"facility_{n}").isNull() for n in present),
            _not_hash("input_set_sha256"),
            _not_hash("facility_snapshot_sha256"),
            _c("facility_page_count") != 1,
            _c("facility_row_count") < 1,
            _c("stage_rows") != _c("dimension_rows"),
            _c("stage_rows") != _c("fact_rows"),
        ]
    )
    counted = audit.withColumns(
        {"stage_rows": _count(stage), "dimension_rows": _count(dim), "fact_rows": _count(fact)}
    )
    unmatched = _unmatched_lineage(fact, audit, "facility", "snapshot_sha256")
    return counted.where(wrong).select("input_set_sha256").union(
        unmatched.select(F.lit(None).cast("string"))
    )


def _facility_raw(raw, stage, audit) -> DataFrame:
    def summary(df: DataFrame, key: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.col(f"`{key}`")).alias("ccns"))

    loaded = R.one_row(audit, "row_count", "distinct_ccn_count")
    both = summary(raw, C.CCN_HEADER).withColumns(
        {"stage": R.one_row(summary(stage, "ccn")), "audit": loaded}
    )
    return both.where(
        "n <> ccns or n <> stage.n or stage.n <> stage.ccns"
        " or stage.n <> audit.row_count or stage.ccns <> audit.distinct_ccn_count"
    )


def _star_broken() -> Column:
    rating, status = _c("five_star_rating"), _c("five_star_availability_status")
    return ((status == "available") & (rating.isNull() | _outside("five_star_rating", 1, 5))) | (
        (status == "not_available") & rating.isNotNull()
    )


def _periods_broken() -> Column:
    def broken(p: str) -> Column:
        start, end = _c(f"{p}_period_start"), _c(f"{p}_period_end")
        return start.isNull() | end.isNull() | (start > end)

    return _any(broken(p) for p in ("five_star", *C.FAMILIES))


def _geography_assigned() -> Column:
    return _any(
        [
            _c("county_fips").isNotNull(),
            _c("geography_match_status") != "not_attempted",
            _c("geography_match_method").isNotNull(),
            _c("geography_resolution_date").isNotNull(),
        ]
    )


FACILITY_RULES: dict[str, Rule] = {
    "facility_availability_codes_valid": RowRule(FAC, _facility_codes),
    "facility_characteristics_valid": RowRule(FAC, _facility_characteristics),
    "facility_confidence_intervals_valid": _per_family(_interval_broken),
    "facility_fact_grain_unique": _grain(F_FAC, "ccn", "source_snapshot_sha256"),
    "facility_fact_reconciles_stage": SetRule(
        (FAC, "dim_facility", F_FAC, BUILD), _facility_fact
    ),
    "facility_five_star_valid": RowRule(FAC, _star_broken),
    "facility_geography_deferred": RowRule("dim_facility", _geography_assigned),
    "facility_periods_valid": RowRule(FAC, _periods_broken),
    "facility_quality_companions_complete": _per_family(_companions_missing),
    "facility_stage_reconciles_raw": SetRule(
        (f"raw.{C.FACILITY}", FAC, f"raw.{C.FACILITY}_load_audit"), _facility_raw
    ),
}


# -- screening --------------------------------------------------------------------

CLASSES = (
    "is_dialysis_use_threshold_eligible", "is_higher_observed_dialysis_use",
    "dialysis_use_band", "is_higher_social_vulnerability", "social_vulnerability_band",
    "screening_data_status", "screening_insufficient_reason", "screening_quadrant",
)


def _reclassified(mart: DataFrame) -> DataFrame:
    stored = mart.withColumn("_stored", F.struct(*CLASSES)).drop(*CLASSES)
    return classify(stored).where(
        _any(R.is_distinct(_c(n), _c(f"_stored.{n}")) for n in CLASSES)
    )


def _latest_singular(years: DataFrame, threshold: DataFrame) -> DataFrame:
    flagged = years.agg(
        F.count_if("is_latest_cms_year").alias("flags"),
        F.max(F.when(_c("is_latest_cms_year"), _c("year"))).alias("latest"),
    )
    runs = threshold.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("cms_year").alias("years"),
        F.max("cms_year").alias("latest"),
    )
    return flagged.withColumn("run", R.one_row(runs)).where(
        "flags <> 1 or run.n <> 1 or run.years <> 1 or latest <> run.latest"
    )


def _national_threshold(mart: DataFrame, threshold: DataFrame) -> DataFrame:
    p75 = "dialysis_use_p75_threshold"
    return (
        mart.groupBy("state_fips")
        .agg(F.countDistinct(p75).alias("n"), F.min(p75).alias("state_threshold"))
        .where(
            (_c("n") != 1)
            | R.is_distinct(_c("state_threshold"), threshold.select(p75).scalar())
        )
    )


def _matched(
    counted: DataFrame, fact: DataFrame, keys: dict[str, str], values: tuple[str, ...], stamps: dict[str, str], prefix: str
) -> DataFrame:
    """``counted`` with ``__{prefix}_pairs``, the rows that each of its rows has in a left join with the
    fact on ``keys``, and ``__{prefix}_equal``, those among them that disagree in no value, status or stamp.

    The rows are counted, never paired: the equal ones are found by the values themselves,
    so a code that many counties share costs its distinct values and not its pairs.
    """
    pairs, equal = f"__{prefix}_pairs", f"__{prefix}_equal"
    names = counted.columns
    cells = [*values, *(f"{v}_status" for v in values), *stamps]
    here = {n: f"__{prefix}_{n}" for n in (*keys, *cells)}
    held = fact.groupBy(*keys, *cells).agg(F.count(F.lit(1)).alias("__held")).select(
        *(_c(n).alias(a) for n, a in here.items()), "__held"
    )
    totals = held.groupBy(*(here[k] for k in keys)).agg(F.sum("__held").alias("__total"))
    same_key = [_c(m) == _c(here[k]) for k, m in keys.items()]
    known = counted.join(totals, same_key, "left").drop(*(here[k] for k in keys))
    alike = _all([*same_key, *(_c(v).eqNullSafe(_c(here[v])) for v in values)])
    # a comparison with NULL is no disagreement
    differs = _any(
        [_c(f"{v}_status") != _c(here[f"{v}_status"]) for v in values] + [_c(m) != _c(here[n]) for n, m in stamps.items()]
    )
    agreed = F.when(_c("__held").isNotNull() & ~F.coalesce(differs, F.lit(False)), _c("__held"))
    found = known.join(held, alike, "left").groupBy(*names, "__total").agg(F.coalesce(F.sum(agreed), F.lit(0)).alias(equal))
    # without a partner the one row of the left join has NULL in every cell
    alone = _all(_c(v).isNull() for v in values).cast("bigint")
    return found.select(
        *names, F.coalesce("__total", F.lit(1)).alias(pairs),
        F.when(_c("__total").isNull(), alone).otherwise(_c(equal)).alias(equal),
    )


def _mart_matches_facts(mart: DataFrame, county: DataFrame, svi: DataFrame) -> DataFrame:
    """Rows of the mart beside their facts that disagree, counted.

    A row violates with each pair of its facts' rows but those that both agree, or with all if a hash of its own is none.
    """
    cms_values, svi_values = ("benes_om_cnt", "benes_op_dlys_pct"), ("rpl_themes",)

    def stamps(prefix: str, hash_name: str) -> dict[str, str]:
        return {n: f"{prefix}_{n}" for n in ("source_manifest_run_id", hash_name)}

    cms, vul = stamps("cms", "source_content_sha256"), stamps("svi", "source_snapshot_sha256")
    values = [n for v in (*cms_values, *svi_values) for n in (v, f"{v}_status")]
    own = _any(_not_hash(n) for n in ("input_set_sha256", cms["source_content_sha256"], vul["source_snapshot_sha256"]))
    rows = mart.groupBy(
        "county_fips", "cms_year", "svi_vintage", *values, *cms.values(), *vul.values(), F.coalesce(own, F.lit(False)).alias("__own")
    ).agg(F.count(F.lit(1)).alias("__rows"))
    rows = _matched(rows, county, {"county_fips": "county_fips", "year": "cms_year"}, cms_values, cms, "cms")
    rows = _matched(rows, svi, {"county_fips": "county_fips", "svi_vintage": "svi_vintage"}, svi_values, vul, "svi")
    # wide enough for the pairs of three relations under one code
    every, agreed = (
        _c(f"__cms_{n}").cast("decimal(19,0)") * _c(f"__svi_{n}").cast("decimal(19,0)") for n in ("pairs", "equal")
    )
    left = F.when(_c("__own"), every).otherwise(every - agreed)
    return rows.withColumn(WEIGHT, (_c("__rows") * left).cast("bigint")).where(_c(WEIGHT) > 0)


def _mart_counts(mart: DataFrame, counties: DataFrame, threshold: DataFrame) -> DataFrame:
    eligible = F.sum(_c("is_dialysis_use_threshold_eligible").cast("int"))
    counts = mart.agg(F.count(F.lit(1)).alias("rows"), eligible.alias("eligible"))
    return counts.withColumns(
        {
            "current": _count(counties.where("is_current_county")),
            "threshold_eligible": threshold.select("threshold_eligible_count").scalar(),
        }
    ).where("rows <> current or eligible <> threshold_eligible")


def _mart_current(mart: DataFrame, counties: DataFrame) -> DataFrame:
    """Rows of the mart that are not current or not reconciled, beside every county of their code, counted on both sides before they meet."""
    rows = mart.groupBy(
        "county_fips", "geography_status", "reconciliation_status", "cms_reconciliation_row_count", "svi_reconciliation_row_count"
    ).agg(F.count(F.lit(1)).alias("__rows"))
    dim = counties.groupBy("county_fips", _c("is_current_county").alias("_current")).agg(F.count(F.lit(1)).alias("__counties"))
    pairs = (_c("__rows") * F.coalesce("__counties", F.lit(1))).alias(WEIGHT)
    return rows.join(dim, "county_fips", "left").where(
        _any(
            [
                _c("_current").isNull() | ~_c("_current"),
                _c("geography_status") != "current_in_scope",
                _c("reconciliation_status") != "matched",
                _c("cms_reconciliation_row_count") != 1,
                _c("svi_reconciliation_row_count") != 1,
            ]
        )
    ).select("*", pairs)


def _summary_totals(mart: DataFrame, summary: DataFrame) -> DataFrame:
    use, vul = _c("is_higher_observed_dialysis_use"), _c("is_higher_social_vulnerability")
    status = _c("screening_data_status")
    actual = mart.agg(
        F.count(F.lit(1)).alias("total_screening_row_count"),
        F.count_if(status == "complete").alias("complete_data_count"),
        F.count_if(status == "insufficient_data").alias("insufficient_data_count"),
        F.count_if(use).alias("higher_use_count"),
        F.count_if(~use).alias("lower_use_count"),
        F.count_if(vul).alias("higher_vulnerability_count"),
        F.count_if(~vul).alias("lower_vulnerability_count"),
    )
    quadrant, n = _c("screening_quadrant"), _c("screening_row_count")
    known = _any(
        (_c("category_display_order") == order) & (quadrant == label)
        for order, label in C.QUADRANTS
    )
    single = ("screening_run_id", "input_set_sha256", "dialysis_use_p75_threshold",
              "cms_year", "svi_vintage")
    listed = summary.agg(
        F.count(F.lit(1)).alias("categories"),
        F.countDistinct("screening_quadrant").alias("quadrants"),
        F.countDistinct("category_display_order").alias("orders"),
        F.count_if(~known).alias("unknown"),
        F.min(n).alias("smallest"),
        F.sum(n).alias("all_rows"),
        F.sum(F.when(quadrant != "insufficient_data", n)).alias("complete_rows"),
        F.sum(F.when(quadrant == "insufficient_data", n)).alias("insufficient_rows"),
        *(F.countDistinct(c).alias(f"n_{c}") for c in single),
        *(F.max(c).alias(f"max_{c}") for c in actual.columns),
        F.max("threshold_eligible_count").alias("eligible"),
        F.max("threshold_excluded_count").alias("excluded"),
    ).withColumn("mart", R.one_row(actual))
    total = _c("mart.total_screening_row_count")
    return listed.where(
        _any(
            [
                *(_c(c) != len(C.QUADRANTS) for c in ("categories", "quadrants", "orders")),
                _c("smallest") < 0,
                _c("unknown") != 0,
                *(_c(f"n_{c}") != 1 for c in single),
                *(_c(f"max_{c}") != _c(f"mart.{c}") for c in actual.columns),
                _c("all_rows") != total,
                _c("complete_rows") != _c("mart.complete_data_count"),
                _c("insufficient_rows") != _c("mart.insufficient_data_count"),
                _c("eligible") != _c("mart.higher_use_count") + _c("mart.lower_use_count"),
                _c("eligible") + _c("excluded") != total,
            ]
        )
    )


def _threshold_valid() -> Column:
    eligible, excluded = _c("threshold_eligible_count"), _c("threshold_excluded_count")
    return _any(
        [
            _c("screening_definition_version") != C.SCREENING_VERSION,
            _c("threshold_metric") != "BENES_OP_DLYS_PCT",
            _c("threshold_quantile") != F.lit("0.75").cast("decimal(3,2)"),
            _c("threshold_method") != "continuous_linear_type_7",
            _c("current_county_count") != eligible + excluded,
            eligible < 1,
            excluded < 0,
            _outside("dialysis_use_p75_threshold", 0, 1),
            *map(_not_hash, ("input_set_sha256", "cms_source_content_sha256",
                             "svi_source_snapshot_sha256")),
        ]
    )


SCREENING_RULES: dict[str, Rule] = {
    "screening_classification_consistent": SetRule((MART,), _reclassified),
    "screening_latest_year_singular": SetRule(("dim_year", THRESHOLD), _latest_singular),
    "screening_national_threshold_fixed": SetRule((MART, THRESHOLD), _national_threshold),
    "screening_reconciles_facts_and_lineage": SetRule((MART, F_COUNTY, F_SVI), _mart_matches_facts),
    "screening_row_count_reconciles": SetRule((MART, "dim_county", THRESHOLD), _mart_counts),
    "screening_rows_current_and_reconciled": SetRule((MART, "dim_county"), _mart_current),
    "screening_summary_reconciles": SetRule((MART, SUMMARY), _summary_totals),
    "screening_threshold_valid": RowRule(THRESHOLD, _threshold_valid),
}

ASSERTIONS: dict[str, Rule] = (
    BUILD_RULES | MEDICARE_RULES | VULNERABILITY_RULES | FACILITY_RULES | SCREENING_RULES
)
