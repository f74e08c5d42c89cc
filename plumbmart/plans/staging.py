"""Staging models: each typed value stands beside its raw token and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbmart.functions import tokens as tk
from plumbmart.sources import contracts as C


def _label(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def county_scope() -> Column:
    """County rows of the states, plus the district's State row, age All only."""
    code = F.trim("BENE_GEO_CD")
    residual = tk.full_match(code, "[0-9]{2}000") & tk.full_match(
        _label("BENE_GEO_DESC"), "[A-Z]{2}-UNKNOWN"
    )
    county = (
        (F.col("BENE_GEO_LVL") == "County")
        & ~F.substring("BENE_GEO_CD", 1, 2).isin(*C.TERRITORY_PREFIXES)
        & ~residual
    )
    district = (
        (F.col("BENE_GEO_LVL") == "State")
        & (_label("BENE_GEO_DESC") == "DC")
        & (code == C.DISTRICT_STATE)
    )
    return (F.col("BENE_AGE_LVL") == "All") & (county | district)


def benchmark_scope() -> Column:
    """State rows with a two-digit in-scope code, and the national row."""
    code = F.trim("BENE_GEO_CD")
    state = (
        (F.col("BENE_GEO_LVL") == "State")
        & tk.full_match(code, "[0-9]{2}")
        & ~code.isin(*C.TERRITORY_PREFIXES)
    )
    national = (
        (F.col("BENE_GEO_LVL") == "National")
        & (_label("BENE_GEO_DESC") == "NATIONAL")
        & tk.is_blank("BENE_GEO_CD")
    )
    return (F.col("BENE_AGE_LVL") == "All") & (state | national)


def _medicare_columns() -> list[Column]:
    return [
        F.col("YEAR").cast("int").alias("year"),
        F.col("BENE_GEO_LVL").alias("source_geography_level"),
        F.col("BENE_GEO_DESC").alias("source_geography_description"),
        F.col("BENE_GEO_CD").alias("source_geography_code"),
        F.col("BENE_AGE_LVL").alias("source_age_level"),
        *tk.triples((m.upper(), m, kind) for m, kind, _ in C.MEDICARE_METRICS),
        *C.MEDICARE_LINEAGE,
    ]


def stg_cms_om_gv_county_year(medicare: DataFrame) -> DataFrame:
    from_state = F.col("BENE_GEO_LVL") == "State"
    return medicare.where(county_scope()).select(
        F.when(from_state, C.DISTRICT_COUNTY).otherwise(F.col("BENE_GEO_CD")).alias("county_fips"),
        F.when(from_state, "district_of_columbia_state_to_county_equivalent")
        .otherwise("source_county_fips")
        .alias("county_geography_mapping_method"),
        *_medicare_columns(),
    )


def stg_cms_om_gv_benchmark_year(medicare: DataFrame) -> DataFrame:
    national = F.col("BENE_GEO_LVL") == "National"
    return medicare.where(benchmark_scope()).select(
        F.when(national, "national").otherwise("state").alias("benchmark_geography_type"),
        F.when(national, "US").otherwise(F.trim("BENE_GEO_CD")).alias("benchmark_geography_key"),
        *_medicare_columns(),
    )


def stg_cdc_svi_county_2022(vulnerability: DataFrame) -> DataFrame:
    return vulnerability.select(
        F.col("STCNTY").alias("county_fips"),
        F.col("ST").alias("state_fips"),
        F.col("STATE").alias("state_name"),
        F.col("ST_ABBR").alias("state_abbreviation"),
        F.col("COUNTY").alias("county_name"),
        F.col(C.OBJECT_ID).cast("int").alias("source_object_id"),
        F.lit(C.VULNERABILITY_VINTAGE).alias("svi_vintage"),
        F.lit(C.ACS_START).alias("acs_period_start"),
        F.lit(C.ACS_END).alias("acs_period_end"),
        *tk.triples((m.upper(), m, "score") for m in C.VULNERABILITY_METRICS),
        *C.SNAPSHOT_LINEAGE,
        *C.PAGE_LINEAGE,
    )


def _header(name: str) -> Column:
    return F.col(f"`{name}`")


def _availability(prefix: str, code: Column, star: bool) -> list[Column]:
    return [
        code.alias(f"{prefix}_availability_code"),
        tk.availability_status(code, star=star).alias(f"{prefix}_availability_status"),
        tk.unavailability_reason(code).alias(f"{prefix}_unavailability_reason"),
    ]


def _period(prefix: str, text: Column) -> list[Column]:
    return [
        text.alias(f"{prefix}_period_raw"),
        tk.period_start(text).alias(f"{prefix}_period_start"),
        tk.period_end(text).alias(f"{prefix}_period_end"),
    ]


_ROLE_TYPING = {
    "category": tk.outcome_category,
    "denominator": lambda text: tk.whole_number(text, "bigint"),
    "estimate": tk.decimal_number,
    "lower_confidence_limit": tk.decimal_number,
    "upper_confidence_limit": tk.decimal_number,
}


def _outcome_columns(family: str) -> list[Column]:
    headers = C.OUTCOME_HEADERS[family]
    code = _header(headers["availability"])
    out = _period(family, _header(headers["period"]))
    out += _availability(family, code, star=False)
    for role, typing in _ROLE_TYPING.items():
        text = _header(headers[role])
        out.append(text.alias(f"{family}_{role}_raw"))
        out.append(tk.when_available(code, typing(text)).alias(f"{family}_{role}"))
    return out


def stg_cms_dialysis_facility(facility: DataFrame) -> DataFrame:
    chain, *offers = C.FACILITY_YES_NO
    stations = _header(C.STATIONS_HEADER)
    certified = _header(C.CERTIFIED_HEADER)
    star_code = _header(C.STAR_HEADERS["availability"])
    star = _header(C.STAR_HEADERS["rating"])

    def flag(name: str, header: str) -> list[Column]:
        text = _header(header)
        return [text.alias(f"{name}_raw"), tk.yes_no(text).alias(name)]

    return facility.select(
        *(_header(header).alias(name) for name, header in C.FACILITY_IDENTITY),
        *flag(*chain),
        _header(C.CHAIN_HEADER).alias("chain_organization"),
        stations.alias("dialysis_stations_raw"),
        tk.whole_number(stations).alias("dialysis_stations"),
        *(c for name, header in offers for c in flag(name, header)),
        certified.alias("certification_date_raw"),
        tk.full_date(certified).alias("certification_date"),
        *_period("five_star", _header(C.STAR_HEADERS["period"])),
        star.alias("five_star_rating_raw"),
        tk.when_available(star_code, tk.whole_number(star)).alias("five_star_rating"),
        *_availability("five_star", star_code, star=True),
        *(c for family in C.FAMILIES for c in _outcome_columns(family)),
        *C.FACILITY_LINEAGE,
    )
