"""What each published source must contain: labels, types, keys, lineage.

Everything here is a fixed value that has to equal the published source or the
governed contract for results to be right.
"""

from __future__ import annotations

# -- fixed values: logical sources and contract versions -----------------------

MEDICARE = "cms_om_gv"
MEDICARE_CONTRACT = "cms_om_gv.raw.v2"
VULNERABILITY = "cdc_svi_county_2022"
VULNERABILITY_CONTRACT = "cdc_svi_county_2022.raw.v1"
FACILITY = "cms_dialysis_facility"
FACILITY_CONTRACT = "cms_dialysis_facility.raw.v1"
HISTORICAL_SOURCE = "cms_om_gv_historical_identity_seed"
HISTORICAL_VERSION = "plan006.1"
HISTORICAL_RUN = "version-controlled-seed"
SCREENING_VERSION = "county_screening.v1"

VULNERABILITY_VINTAGE = 2022
ACS_START, ACS_END = 2018, 2022
TERRITORY_PREFIXES = ("60", "66", "69", "72", "78")
DISTRICT_STATE, DISTRICT_COUNTY = "11", "11001"
HASH_PATTERN = "[0-9a-f]{64}"

# -- fixed values: Medicare geographic variation file ---------------------------

MEDICARE_KEYS = ("YEAR", "BENE_GEO_LVL", "BENE_GEO_DESC", "BENE_GEO_CD", "BENE_AGE_LVL")
# (metric, kind, whether it is a share between 0 and 1)
MEDICARE_METRICS = (
    ("benes_om_cnt", "count", False),
    ("ma_prtcptn_rate", "rate", True),
    ("bene_dual_pct", "rate", True),
    ("benes_op_dlys_cnt", "count", False),
    ("benes_op_dlys_pct", "rate", True),
    ("op_dlys_visits_per_1000_benes", "rate", False),
    ("op_dlys_mdcr_stdzd_pymt_pc", "rate", False),
    ("acute_hosp_readmsn_pct", "rate", True),
    ("er_visits_per_1000_benes", "rate", False),
)
MEDICARE_COLUMNS = MEDICARE_KEYS + tuple(m.upper() for m, _, _ in MEDICARE_METRICS)
# The declared type of every column.
MEDICARE_TYPES = {
    "YEAR": "numeric",
    "BENE_GEO_LVL": "text",
    "BENE_GEO_DESC": "text",
    "BENE_GEO_CD": "text",
    "BENE_AGE_LVL": "text",
    "BENES_OM_CNT": "numeric",
    "MA_PRTCPTN_RATE": "numeric",
    "BENE_DUAL_PCT": "numeric",
    "BENES_OP_DLYS_CNT": "numeric",
    "BENES_OP_DLYS_PCT": "numeric",
    "OP_DLYS_VISITS_PER_1000_BENES": "numeric",
    "OP_DLYS_MDCR_STDZD_PYMT_PC": "numeric",
    "ACUTE_HOSP_READMSN_PCT": "numeric",
    "ER_VISITS_PER_1000_BENES": "numeric",
}
MEDICARE_TYPE_FAMILIES = {
    "text": ("CHAR", "CHARACTER", "STRING", "TEXT", "VARCHAR"),
    "numeric": (
        "BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "INTEGER", "NUMBER", "NUMERIC", "REAL",
    ),
}
# State-level pseudo rows that may carry a blank geography code.
BLANK_CODE_STATES = ("TERRITORY", "ZZ")
MEDICARE_LINEAGE = (
    "source_id",
    "source_manifest_run_id",
    "source_content_sha256",
    "source_retrieved_at_utc",
    "source_modified_at",
)

# -- fixed values: vulnerability index layer ------------------------------------

VULNERABILITY_KEYS = ("ST", "STATE", "ST_ABBR", "STCNTY", "COUNTY")
RANKS = ("rpl_themes", "rpl_theme1", "rpl_theme2", "rpl_theme3", "rpl_theme4")
PERCENTAGES = ("ep_pov150", "ep_uninsur", "ep_age65", "ep_disabl", "ep_limeng", "ep_noveh")
VULNERABILITY_METRICS = RANKS + PERCENTAGES
OBJECT_ID = "GRASP_ID"
VULNERABILITY_COLUMNS = (
    VULNERABILITY_KEYS + tuple(m.upper() for m in VULNERABILITY_METRICS) + (OBJECT_ID,)
)
VULNERABILITY_TYPES = (
    {name: "string" for name in VULNERABILITY_KEYS}
    | {m.upper(): "numeric" for m in VULNERABILITY_METRICS}
    | {OBJECT_ID: "oid"}
)
VULNERABILITY_TYPE_FAMILIES = {
    "string": ("esriFieldTypeString",),
    "numeric": (
        "esriFieldTypeDouble", "esriFieldTypeInteger",
        "esriFieldTypeSingle", "esriFieldTypeSmallInteger",
    ),
    "oid": ("esriFieldTypeOID",),
}
LAYER_IDENTITY = {
    "layer_id": "1",
    "layer_name": "SVI2022 US county",
    "object_id_field": OBJECT_ID,
}
SNAPSHOT_LINEAGE = (
    "source_id",
    "source_manifest_run_id",
    "source_snapshot_sha256",
    "source_retrieved_at_utc",
    "source_modified_at",
)
PAGE_LINEAGE = ("source_page_index", "source_page_offset", "source_page_sha256")

# -- fixed values: facility listing ----------------------------------------------

CCN_HEADER = "CMS Certification Number (CCN)"
# (column name in the models, header in the published file)
FACILITY_IDENTITY = (
    ("ccn", CCN_HEADER),
    ("facility_name", "Facility Name"),
    ("address_line_1", "Address Line 1"),
    ("address_line_2", "Address Line 2"),
    ("city", "City/Town"),
    ("state", "State"),
    ("zip_code", "ZIP Code"),
    ("source_county", "County/Parish"),
    ("telephone", "Telephone Number"),
    ("ownership_status", "Profit or Non-Profit"),
)
FACILITY_YES_NO = (
    ("chain_owned", "Chain Owned"),
    ("in_center_hemodialysis", "Offers in-center hemodialysis"),
    ("peritoneal_dialysis", "Offers peritoneal dialysis"),
    ("home_hemodialysis_training", "Offers home hemodialysis training"),
)
CHAIN_HEADER = "Chain Organization"
STATIONS_HEADER = "# of Dialysis Stations"
CERTIFIED_HEADER = "Certification Date"
STAR_HEADERS = {
    "period": "Five Star Date",
    "rating": "Five Star",
    "availability": "Five Star Data Availability Code",
}
OUTCOME_HEADERS = {
    "survival": {
        "period": "SMR Date",
        "availability": "Patient Survival data availability code",
        "category": "Patient Survival Category Text",
        "denominator": "Number of Patients included in survival summary",
        "estimate": "Mortality Rate (Facility)",
        "lower_confidence_limit": "Mortality Rate: Lower Confidence Limit (2.5%)",
        "upper_confidence_limit": "Mortality Rate: Upper Confidence Limit (97.5%)",
    },
    "hospitalization": {
        "period": "SHR Date",
        "availability": "Patient Hospitalization data availability Code",
        "category": "Patient hospitalization category text",
        "denominator": "Number of patients included in hospitalization summary",
        "estimate": "Hospitalization Rate (Facility)",
        "lower_confidence_limit": "Hospitalization Rate: Lower Confidence Limit (2.5%)",
        "upper_confidence_limit": "Hospitalization Rate: Upper Confidence Limit (97.5%)",
    },
    "readmission": {
        "period": "SRR Date",
        "availability": "Patient Hospital Readmission data availability Code",
        "category": "Patient Hospital Readmission Category",
        "denominator": "Number of hospitalizations included in hospital readmission summary",
        "estimate": "Readmission Rate (Facility)",
        "lower_confidence_limit": "Readmission Rate: Lower Confidence Limit (2.5%)",
        "upper_confidence_limit": "Readmission Rate: Upper Confidence Limit (97.5%)",
    },
}
FAMILIES = tuple(OUTCOME_HEADERS)
FACILITY_COLUMNS = (
    tuple(h for _, h in FACILITY_IDENTITY)
    + tuple(h for _, h in FACILITY_YES_NO)
    + (CHAIN_HEADER, STATIONS_HEADER, CERTIFIED_HEADER)
    + tuple(STAR_HEADERS.values())
    + tuple(h for headers in OUTCOME_HEADERS.values() for h in headers.values())
)
FACILITY_LINEAGE = (
    "source_id",
    "source_manifest_run_id",
    "source_snapshot_sha256",
    "source_retrieved_at_utc",
    "source_release",
    "source_modified_at",
)

# -- fixed values: screening --------------------------------------------------------

QUADRANTS = (
    (1, "higher_use_higher_vulnerability"),
    (2, "higher_use_lower_vulnerability"),
    (3, "lower_use_higher_vulnerability"),
    (4, "lower_use_lower_vulnerability"),
    (5, "insufficient_data"),
)
VULNERABILITY_CUT = "0.75"
