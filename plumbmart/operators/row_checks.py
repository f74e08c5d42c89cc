"""Row-level source contracts as jobs that return one row per issue."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbmart.functions.tokens import full_match
from plumbmart.operators.relational import later_occurrences
from plumbmart.sources import contracts as C

Check = tuple[str, str, Column]

MESSAGES = {
    "missing_grain_key": "is missing",
    "blank_grain_key": "is blank",
    "unparseable_grain_key": "is not a whole number",
    "invalid_fips": "is not a code of as many digits as it needs",
    "fips_prefix_mismatch": "does not begin with the code of its state",
    "territory_out_of_scope": "is a county of a territory",
    "invalid_dc_fips": "is not the one county of the district",
    "invalid_object_id": "is not a positive whole number",
    "missing_ccn": "is missing",
    "blank_ccn": "is blank",
    "invalid_ccn_format": "is not a number of one to ten digits",
    "duplicate_ccn": "repeats an earlier row",
}


def message(code: str, field: str, found: Column) -> Column:
    """What is wrong with a field, and its value as it stands."""
    value = F.coalesce(F.concat(F.lit("'"), found, F.lit("'")), F.lit("null"))
    return F.concat(F.lit(f"{field} {MESSAGES[code]}: "), value)


def row_issues(df: DataFrame, checks: Iterable[Check], keep: Sequence[str], told: bool = False) -> DataFrame:
    """``keep`` columns plus ``code`` and ``field`` for every check that holds; ``told`` adds the value ``found`` and a ``message``."""
    def issue(code: str, field: str) -> Column:
        found = F.col(f"`{field}`").cast("string")
        more = (found.alias("found"), message(code, field, found).alias("message")) if told else ()
        return F.struct(F.lit(code).alias("code"), F.lit(field).alias("field"), *more)

    hits = [F.when(condition, issue(code, field)) for code, field, condition in checks]
    found = F.explode(F.array_compact(F.array(*hits)))
    return df.select(*(F.col(f"`{k}`") for k in keep), found.alias("i")).select(
        *(F.col(f"`{k}`") for k in keep), "i.*"
    )


def _blank(name: str) -> Column:
    return full_match(f"`{name}`", r"\s*")


def _label(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def medicare_key_issues(df: DataFrame, keep: Sequence[str] = C.MEDICARE_KEYS, told: bool = False) -> DataFrame:
    """Missing, blank or unparseable grain keys.

    A blank geography code is allowed for the national row and for the two
    state-level pseudo rows only.
    """
    may_be_blank = (_label("BENE_GEO_LVL") == "NATIONAL") | (
        (_label("BENE_GEO_LVL") == "STATE") & _label("BENE_GEO_DESC").isin(*C.BLANK_CODE_STATES)
    )
    checks: list[Check] = [
        ("missing_grain_key", k, F.col(k).isNull()) for k in C.MEDICARE_KEYS
    ]
    for key in C.MEDICARE_KEYS:
        blank = _blank(key)
        if key == "BENE_GEO_CD":
            blank = blank & ~F.coalesce(may_be_blank, F.lit(False))
        checks.append(("blank_grain_key", key, blank))
    checks.append(
        ("unparseable_grain_key", "YEAR", ~_blank("YEAR") & ~full_match("YEAR", "[0-9]+"))
    )
    return row_issues(df, checks, keep, told)


def county_key_issues(
    df: DataFrame, keep: Sequence[str] = ("ST", "STCNTY", C.OBJECT_ID), told: bool = False
) -> DataFrame:
    """Blank labels, malformed or inconsistent codes, bad object ids."""
    def matches(name: str, pattern: str) -> Column:
        return F.coalesce(full_match(name, pattern), F.lit(False))

    state_ok, county_ok = matches("ST", "[0-9]{2}"), matches("STCNTY", "[0-9]{5}")
    both = state_ok & county_ok
    prefix = F.col("STCNTY").startswith(F.col("ST"))
    abroad = F.col("ST").isin(*C.TERRITORY_PREFIXES)
    checks: list[Check] = [
        ("blank_grain_key", n, F.col(n).isNull() | _blank(n))
        for n in ("STATE", "ST_ABBR", "COUNTY")
    ]
    checks += [
        ("invalid_fips", "ST", ~state_ok),
        ("invalid_fips", "STCNTY", ~county_ok),
        ("fips_prefix_mismatch", "STCNTY", both & ~prefix),
        ("territory_out_of_scope", "STCNTY", both & prefix & abroad),
        (
            "invalid_dc_fips", "STCNTY",
            both & prefix & (F.col("ST") == C.DISTRICT_STATE)
            & (F.col("STCNTY") != C.DISTRICT_COUNTY),
        ),
        ("invalid_object_id", C.OBJECT_ID, ~matches(C.OBJECT_ID, "[1-9][0-9]*")),
    ]
    return row_issues(df, checks, keep, told)


def facility_key_issues(df: DataFrame, keep: Sequence[str] = (C.CCN_HEADER,), told: bool = False) -> DataFrame:
    """Missing, blank or malformed certification numbers."""
    ccn = F.col(f"`{C.CCN_HEADER}`")
    blank = _blank(C.CCN_HEADER)
    checks: list[Check] = [
        ("missing_ccn", C.CCN_HEADER, ccn.isNull()),
        ("blank_ccn", C.CCN_HEADER, blank),
        ("invalid_ccn_format", C.CCN_HEADER, ~blank & ~full_match(ccn, "[0-9]{1,10}")),
    ]
    return row_issues(df, checks, keep, told)


def facility_row_issues(df: DataFrame, place: Sequence[str]) -> DataFrame:
    """Every issue of a facility file: ``place`` of the row, code, field, found, message, and for
    a well-formed number that repeats the place of the row it was ``first_seen_at``.

    ``place`` names the columns that order the rows, such as file and row number.
    """
    ccn = C.CCN_HEADER
    rows = df.select(F.struct(*place).alias("place"), F.col(f"`{ccn}`"))
    alone = facility_key_issues(rows, ["place"], told=True)
    well_formed = full_match(F.col(f"`{ccn}`"), "[0-9]{1,10}")
    repeated = later_occurrences(rows.where(well_formed).withColumnRenamed(ccn, "ccn"), ["ccn"], "place").select(
        "place", F.lit("duplicate_ccn").alias("code"), F.lit(ccn).alias("field"), F.col("ccn").alias("found"),
        message("duplicate_ccn", ccn, F.col("ccn")).alias("message"), "first_seen_at",
    )
    return alone.unionByName(repeated, allowMissingColumns=True)


def duplicate_key_issues(
    df: DataFrame, keys: Sequence[str], order: str, code: str, valid: Column | None = None
) -> DataFrame:
    """Each later row of a repeated key, with the row it was first seen at."""
    scope = df if valid is None else df.where(valid)
    return later_occurrences(scope.select(*keys, order), keys, order).select(
        F.lit(code).alias("code"), *keys, F.col(order).alias("row_order"), "first_seen_at"
    )
