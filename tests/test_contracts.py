import pytest

from plumbmart.operators import row_checks as rc
from plumbmart.operators import schema_checks as sc
from plumbmart.operators.names import api_field_name
from plumbmart.plans.relations import RELATIONS, schema
from plumbmart.sources import contracts as C
from plumbmart.sources.files import columns_frame
from samples import county, medicare_row


def codes(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_declared_surface():
    fields = [f for fields in RELATIONS.values() for f in fields]
    assert sum(f.required for f in fields) == 287
    assert sum(f.unique for f in fields) == 13
    models = [r for r in RELATIONS if r.startswith(("stg_", "dim_", "fct_", "audit_", "int_", "mart_"))]
    assert len(models) == 15 and sum(len(RELATIONS[m]) for m in models) == 484
    assert (len(C.MEDICARE_COLUMNS), len(C.VULNERABILITY_COLUMNS), len(C.FACILITY_COLUMNS)) == (14, 17, 41)


@pytest.fixture
def required(spark):
    return spark.createDataFrame(list(C.MEDICARE_TYPES.items()), "name string, family string")


def test_schema_issues(spark, required):
    names = list(C.MEDICARE_COLUMNS)
    good = columns_frame(spark, [*names, "Z", "Y"],
                         [*("text" if C.MEDICARE_TYPES[n] == "text" else " double " for n in names), "x", "x"])
    assert sc.schema_issues(good, required, C.MEDICARE_TYPE_FAMILIES).count() == 0
    assert codes(sc.additive_columns(good, required), "name") == [("Y",), ("Z",)]
    bad = columns_frame(spark, [*names[1:], "BENE_GEO_CD"],
                        ["TEXT" if C.MEDICARE_TYPES[n] == "text" else "TEXT" for n in names[1:]] + ["TEXT"])
    got = codes(sc.schema_issues(bad, required, C.MEDICARE_TYPE_FAMILIES), "code", "field")
    assert ("missing_required_column", "YEAR") in got
    assert ("duplicate_required_column", "BENE_GEO_CD") in got
    assert ("incompatible_required_type", "BENES_OM_CNT") in got and len(got) == 11


def test_layer_identity(spark):
    kind = "layer_id int, layer_name string, object_id_field string"
    good = spark.createDataFrame([(1, C.LAYER_IDENTITY["layer_name"], C.OBJECT_ID)], kind)
    assert sc.identity_issues(good, C.LAYER_IDENTITY).count() == 0
    bad = spark.createDataFrame([(2, None, C.OBJECT_ID)], kind)
    assert codes(sc.identity_issues(bad, C.LAYER_IDENTITY), "code") == [
        ("unexpected_layer_id",), ("unexpected_layer_name",)]
    required = spark.createDataFrame(list(C.VULNERABILITY_TYPES.items()), "name string, family string")
    lower = columns_frame(spark, C.VULNERABILITY_COLUMNS, ["esrifieldtypestring"] * 17)
    issues = sc.schema_issues(lower, required, C.VULNERABILITY_TYPE_FAMILIES, noun="field", ignore_case=False)
    assert issues.count() == 17


def test_api_schema(spark):
    required = spark.createDataFrame(
        [(f"s{i}", api_field_name(h), h) for i, h in enumerate(C.FACILITY_COLUMNS)],
        "semantic string, api_field string, header string")
    kind = "api_field string, header string, declared_type string"
    rows = [(api_field_name(h), h, "Text ") for h in C.FACILITY_COLUMNS]
    good = spark.createDataFrame([*rows, ("more", "More", "text")], kind)
    assert sc.api_schema_issues(good, required).count() == 0
    assert codes(sc.additive_headers(good, required), "header") == [("More",)]
    bad = rows[1:] + [rows[1]] + [("x", "Same", "text"), ("y", "Same", "text")]
    bad[1] = (rows[2][0], "Other", "number")
    got = codes(sc.api_schema_issues(spark.createDataFrame(bad, kind), required), "code", "field")
    assert got == [
        ("ambiguous_required_csv_header", "s2"), ("duplicate_additive_csv_header", "Same"),
        ("duplicate_required_api_field", "s1"), ("incompatible_api_csv_mapping", "s2"),
        ("incompatible_api_transport_type", "s2"), ("missing_required_api_field", "s0")]


@pytest.mark.parametrize("header,name", [
    ("CMS Certification Number (CCN)", "cms_certification_number_ccn"),
    ("City/Town", "citytown"), ("# of Dialysis Stations", "of_dialysis_stations"),
    ("Mortality Rate: Lower Confidence Limit (2.5%)", "mortality_rate_lower_confidence_limit_25"),
    ("Offers in-center hemodialysis", "offers_incenter_hemodialysis"),
])
def test_api_names_follow_the_header(header, name):
    assert api_field_name(header) == name


def test_mapping_drift(spark):
    kind = "semantic string, header string, unit string, companion string"
    want = spark.createDataFrame([("a", "A", "u", None), ("b", "B", "u", "a"), ("c", "C", "u", None)], kind)
    attrs = {"header": "incompatible_csv_mapping", "unit": "incompatible_dictionary_unit",
             "companion": "incompatible_availability_companion"}
    seen = spark.createDataFrame([("a", "A", "w", None), ("b", "B", "u", None)], kind)
    assert codes(sc.mapping_issues(seen, want, "semantic", attrs), "code", "field") == [
        ("incompatible_availability_companion", "b"), ("incompatible_dictionary_unit", "a"),
        ("missing_required_mapping", "c")]
    clash = spark.createDataFrame([("a", "A", "w", None), ("b", "A", "u", "a"), ("c", "C", "u", None)], kind)
    got = sc.mapping_issues(clash, want, "semantic", attrs, {"header": "duplicate_csv_mapping_target"})
    assert codes(got, "code", "field") == [("duplicate_csv_mapping_target", "A")]


def test_enforced_contract(spark):
    good = spark.createDataFrame([(2024, True)], schema("dim_year"))
    assert sc.enforce_contract(good, schema("dim_year"), "dim_year") is good
    for bad in (good.drop("year"), good.withColumn("x", good.year), good.select("is_latest_cms_year", "year"),
                good.withColumn("year", good.year.cast("bigint"))):
        with pytest.raises(sc.ContractError):
            sc.enforce_contract(bad, schema("dim_year"), "dim_year")


def test_medicare_keys(spark):
    rows = [
        medicare_row("2024", "National", "National", ""), medicare_row("2024", "State", "Territory", " "),
        medicare_row("2024", "State", "zz", ""), medicare_row("2024", "State", "AL", ""),
        medicare_row("20x4", "County", "AL-x", "01001"), medicare_row(" ", "County", " ", "01001"),
        medicare_row(None, "County", "AL-x", "01001", age=""),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in C.MEDICARE_COLUMNS))
    assert codes(rc.medicare_key_issues(df), "code", "field") == [
        ("blank_grain_key", "BENE_AGE_LVL"), ("blank_grain_key", "BENE_GEO_CD"),
        ("blank_grain_key", "BENE_GEO_DESC"), ("blank_grain_key", "YEAR"),
        ("missing_grain_key", "YEAR"), ("unparseable_grain_key", "YEAR")]


def test_county_keys(spark):
    rows = [county("01001", "AL", 0, "1"), county("72001", "PR", 0, "2"), county("11002", "DC", 0, "3"),
            county("01003", "AL", 0, "0"), county("01003", "", 0, "07"), county("1100", "x", 0, "5")]
    rows[3]["ST"] = "02"
    df = spark.createDataFrame(
        [tuple(None if r[c] is None else str(r[c]) for c in C.VULNERABILITY_COLUMNS) for r in rows],
        ", ".join(f"`{c}` string" for c in C.VULNERABILITY_COLUMNS))
    assert codes(rc.county_key_issues(df), "code", "field") == [
        ("blank_grain_key", "ST_ABBR"), ("fips_prefix_mismatch", "STCNTY"), ("invalid_dc_fips", "STCNTY"),
        ("invalid_fips", "STCNTY"), ("invalid_object_id", "GRASP_ID"), ("invalid_object_id", "GRASP_ID"),
        ("territory_out_of_scope", "STCNTY")]


def test_facility_keys_and_duplicates(spark):
    values = ["012345", "", None, " ", "12345678901", "12a", "012345", "1"]
    df = spark.createDataFrame([(v, i + 2) for i, v in enumerate(values)], f"`{C.CCN_HEADER}` string, row_no int")
    assert codes(rc.facility_key_issues(df), "code") == [
        ("blank_ccn",), ("blank_ccn",), ("invalid_ccn_format",), ("invalid_ccn_format",), ("missing_ccn",)]
    renamed = df.withColumnRenamed(C.CCN_HEADER, "ccn")
    got = rc.duplicate_key_issues(renamed, ["ccn"], "row_no", "duplicate_ccn", renamed.ccn.rlike("^[0-9]+$"))
    assert codes(got, "code", "ccn", "row_order", "first_seen_at") == [("duplicate_ccn", "012345", 8, 2)]


def test_issues_tell_row_value_and_message(spark):
    values = ["012345", "", None, "12a", "012345", "1", "012345"]
    df = spark.createDataFrame([(v, "f", i + 2) for i, v in enumerate(values)], f"`{C.CCN_HEADER}` string, part string, row_number int")
    got = {(r.place.row_number, r.code, r.found, r.message.removeprefix(C.CCN_HEADER), r.first_seen_at and r.first_seen_at.row_number)
           for r in rc.facility_row_issues(df, ["part", "row_number"]).collect()}
    assert got == {
        (3, "blank_ccn", "", " is blank: ''", None), (4, "missing_ccn", None, " is missing: null", None),
        (5, "invalid_ccn_format", "12a", " is not a number of one to ten digits: '12a'", None),
        (6, "duplicate_ccn", "012345", " repeats an earlier row: '012345'", 2),
        (8, "duplicate_ccn", "012345", " repeats an earlier row: '012345'", 2)}
    assert rc.facility_row_issues(df.limit(0), ["part", "row_number"]).count() == 0
    rows = [(9, *medicare_row("20x4", "State", "AL", ""))]
    wide = spark.createDataFrame(rows, "row_number int, " + ", ".join(f"`{c}` string" for c in C.MEDICARE_COLUMNS))
    assert codes(rc.medicare_key_issues(wide, ["row_number"], told=True), "row_number", "code", "found", "message") == [
        (9, "blank_grain_key", "", "BENE_GEO_CD is blank: ''"),
        (9, "unparseable_grain_key", "20x4", "YEAR is not a whole number: '20x4'")]
