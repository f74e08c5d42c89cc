"""Typing of raw text tokens into a value and a status.

Every function returns a Catalyst expression, so the typing stays inside
whole-stage code generation and costs no Python worker.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNT = "decimal(38,0)"
RATE = "decimal(38,10)"
SCORE = "decimal(18,10)"

# Availability codes and their published reasons.
AVAILABLE_CODE = "001"
UNAVAILABILITY_REASONS = {
    "199": "insufficient_patients",
    "201": "data_not_reported",
    "255": "inaccurate_measure",
    "258": "insufficient_history",
    "260": "insufficient_star_data",
    "261": "inaccurate_star_component",
    "270": "disaster_suppression",
    "280": "external_factors",
    "281": "external_factors_star_rating",
}
STAR_ONLY_CODES = ("260", "261", "281")
# Outcome categories as published.
OUTCOME_CATEGORIES = ("better than expected", "as expected", "worse than expected")
# Fixed value: the text that stands for a missing score.
SCORE_SENTINEL = "-999"


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def full_match(text: Column | str, pattern: str) -> Column:
    """Whole-string match; ``$`` would also accept a trailing newline."""
    return _col(text).rlike(rf"\A(?:{pattern})\z")


def is_blank(text: Column | str) -> Column:
    return F.coalesce(F.trim(_col(text)), F.lit("")) == ""


# -- counts and rates with publication gaps -----------------------------------


def _publication_gap(text: Column) -> Column:
    token = F.trim(text)
    return (
        F.when(is_blank(text), "unavailable_blank")
        .when(token == "*", "suppressed")
        .when(F.upper(token) == "NA", "unavailable_na")
    )


def count_value(text: Column | str) -> Column:
    token = F.trim(_col(text))
    return F.when(full_match(token, "[0-9]+"), token.try_cast(COUNT))


def count_status(text: Column | str) -> Column:
    return (
        _publication_gap(_col(text))
        .when(count_value(text).isNull(), "invalid_numeric")
        .otherwise("reported")
    )


def rate_value(text: Column | str, data_type: str = RATE) -> Column:
    return F.trim(_col(text)).try_cast(data_type)


def rate_status(text: Column | str, data_type: str = RATE) -> Column:
    return (
        _publication_gap(_col(text))
        .when(rate_value(text, data_type).isNull(), "invalid_numeric")
        .otherwise("reported")
    )


# -- scores with a sentinel ---------------------------------------------------


def score_value(text: Column | str, data_type: str = SCORE) -> Column:
    token = F.trim(_col(text))
    return F.when(token != SCORE_SENTINEL, token.try_cast(data_type))


def score_status(text: Column | str, data_type: str = SCORE) -> Column:
    token = F.trim(_col(text))
    return (
        F.when(token.isNull(), "unavailable_null")
        .when(token == SCORE_SENTINEL, "unavailable_sentinel")
        .when(token.try_cast(data_type).isNull(), "invalid_numeric")
        .otherwise("reported")
    )


# -- availability-gated fields ------------------------------------------------


def availability_status(code: Column | str, *, star: bool = False) -> Column:
    token = F.trim(_col(code))
    known = [c for c in UNAVAILABILITY_REASONS if star or c not in STAR_ONLY_CODES]
    return (
        F.when(token == AVAILABLE_CODE, "available")
        .when(token.isin(known), "not_available")
        .otherwise("invalid")
    )


def unavailability_reason(code: Column | str) -> Column:
    pairs = [F.lit(x) for pair in UNAVAILABILITY_REASONS.items() for x in pair]
    return F.create_map(*pairs)[F.trim(_col(code))]


def when_available(code: Column | str, value: Column) -> Column:
    return F.when(F.trim(_col(code)) == AVAILABLE_CODE, value)


def outcome_category(text: Column | str) -> Column:
    label = F.lower(F.trim(_col(text)))
    return F.when(label.isin(*OUTCOME_CATEGORIES), F.replace(label, F.lit(" "), F.lit("_")))


def whole_number(text: Column | str, data_type: str = "int") -> Column:
    """Text to integer, rounding halves away from zero; NULL when not a number."""
    token = F.nullif(F.trim(_col(text)), F.lit(""))
    return F.round(token.try_cast(RATE), 0).try_cast(data_type)


def decimal_number(text: Column | str, data_type: str = SCORE) -> Column:
    return F.nullif(F.trim(_col(text)), F.lit("")).try_cast(data_type)


def full_date(text: Column | str) -> Column:
    """A complete year-month-day only; a bare year or month stays NULL."""
    token = F.trim(_col(text))
    dashed = F.regexp_replace(token, r"\A([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})\z", "$1-$2-$3")
    return F.when(
        full_match(dashed, r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), dashed.try_cast("date")
    )


def yes_no(text: Column | str) -> Column:
    token = F.lower(F.trim(_col(text)))
    return F.when(token == "yes", True).when(token == "no", False)


def _period_part(text: Column | str, part: int) -> Column:
    piece = F.split_part(F.trim(_col(text)), F.lit("-"), F.lit(part))
    return F.try_to_date(piece, "dMMMyyyy")


def period_start(text: Column | str) -> Column:
    """First date of a ``ddMMMyyyy-ddMMMyyyy`` period."""
    return _period_part(text, 1)


def period_end(text: Column | str) -> Column:
    return _period_part(text, 2)


def epoch_millis_text(millis: Column | str) -> Column:
    """Epoch milliseconds as UTC text to the second, in any session time zone; NULL below 1."""
    later = F.when(_col(millis) >= 1, _col(millis))
    utc = F.to_utc_timestamp(F.timestamp_millis(later), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


# -- the value triple ---------------------------------------------------------


_VALUE = {"count": count_value, "rate": rate_value, "score": score_value}
_STATUS = {"count": count_status, "rate": rate_status, "score": score_status}


def triple(raw: Column | str, name: str, kind: str) -> list[Column]:
    """``<name>_raw``, ``<name>`` and ``<name>_status`` for one metric."""
    token = _col(raw)
    return [
        token.alias(f"{name}_raw"),
        _VALUE[kind](token).alias(name),
        _STATUS[kind](token).alias(f"{name}_status"),
    ]


def triples(metrics: Iterable[tuple[str, str, str]]) -> list[Column]:
    """Triples for ``(raw column, name, kind)`` in order."""
    return [c for raw, name, kind in metrics for c in triple(raw, name, kind)]
