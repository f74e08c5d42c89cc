"""Seed relations that are part of the mart's definition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbmart.plans.relations import schema
from plumbmart.sources.contracts import HISTORICAL_VERSION

# The published seed table, but for its version column.
_ROWS = (
    (
        "02261", "02", "Alaska", "AK", "Valdez-Cordova", "AK-Valdez-Cordova", 2014, 2018, "historical_source_only", False,
        "Historical CMS source identity; Alaska county-equivalent boundaries changed. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "02270", "02", "Alaska", "AK", "Wade Hampton", "AK-Wade Hampton", 2014, 2014, "historical_source_only", False,
        "Historical CMS source identity; Alaska county-equivalent boundaries changed. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "09001", "09", "Connecticut", "CT", "Fairfield", "CT-Fairfield", 2014, 2021, "historical_source_only", False,
        "Historical CMS source identity predates Connecticut planning-region geography in the 2022+ current surface. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "09003", "09", "Connecticut", "CT", "Hartford", "CT-Hartford", 2014, 2021, "historical_source_only", False,
        "Historical CMS source identity predates Connecticut planning-region geography in the 2022+ current surface. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "09005", "09", "Connecticut", "CT", "Litchfield", "CT-Litchfield", 2014, 2021, "historical_source_only", False,
        "Historical CMS source identity predates Connecticut planning-region geography in the 2022+ current surface. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "09007", "09", "Connecticut", "CT", "Middlesex", "CT-Middlesex", 2014, 2021, "historical_source_only", False,
        "Historical CMS source identity predates Connecticut planning-region geography in the 2022+ current surface. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "09009", "09", "Connecticut", "CT", "New Haven", "CT-New Haven", 2014, 2021, "historical_source_only", False,
        "Historical CMS source identity predates Connecticut planning-region geography in the 2022+ current surface. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "09011", "09", "Connecticut", "CT", "New London", "CT-New London", 2014, 2021, "historical_source_only", False,
        "Historical CMS source identity predates Connecticut planning-region geography in the 2022+ current surface. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "09013", "09", "Connecticut", "CT", "Tolland", "CT-Tolland", 2014, 2021, "historical_source_only", False,
        "Historical CMS source identity predates Connecticut planning-region geography in the 2022+ current surface. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "09015", "09", "Connecticut", "CT", "Windham", "CT-Windham", 2014, 2021, "historical_source_only", False,
        "Historical CMS source identity predates Connecticut planning-region geography in the 2022+ current surface. No successor allocation or longitudinal bridge is applied.",
    ),
    (
        "46113", "46", "South Dakota", "SD", "Shannon", "SD-Shannon", 2014, 2014, "historical_source_only", False,
        "Historical CMS source identity; the county name and FIPS changed after the observed row. No successor allocation or longitudinal bridge is applied.",
    ),
)


def historical_county_identities(spark: SparkSession) -> DataFrame:
    """County identities seen in older files but absent from the current index."""
    rows = [(*row, HISTORICAL_VERSION) for row in _ROWS]
    return spark.createDataFrame(rows, schema("historical_county_identities"))
