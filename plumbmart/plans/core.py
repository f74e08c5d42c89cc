"""Dimensions, facts and the key reconciliation between the two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbmart.operators.relational import flag_latest, one_row, reconcile_keys
from plumbmart.plans.relations import columns
from plumbmart.sources import contracts as C


def dim_county(svi_stage: DataFrame, county_stage: DataFrame, seed: DataFrame) -> DataFrame:
    """Current counties with their observed years, plus historical identities."""
    observed = county_stage.groupBy("county_fips").agg(
        F.min("year").alias("observed_cms_start_year"),
        F.max("year").alias("observed_cms_end_year"),
    )
    current = svi_stage.join(observed, "county_fips", "left").withColumns(
        {
            "geography_status": F.lit("current_in_scope"),
            "is_current_county": F.lit(True),
            "svi_geography_vintage": F.col("svi_vintage"),
            "boundary_discontinuity_warning": F.lit(None).cast("string"),
            "geography_source_id": F.col("source_id"),
            "geography_source_version": F.lit(C.VULNERABILITY_CONTRACT),
            "geography_source_manifest_run_id": F.col("source_manifest_run_id"),
            "geography_source_snapshot_sha256": F.col("source_snapshot_sha256"),
        }
    )
    historical = seed.withColumns(
        {
            "svi_geography_vintage": F.lit(None).cast("int"),
            "geography_source_id": F.lit(C.HISTORICAL_SOURCE),
            "geography_source_version": F.col("seed_version"),
            "geography_source_manifest_run_id": F.lit(C.HISTORICAL_RUN),
            "geography_source_snapshot_sha256": F.lit(None).cast("string"),
        }
    )
    names = columns("dim_county")
    return current.select(*names).unionByName(historical.select(*names))


def dim_year(county_stage: DataFrame, benchmark_stage: DataFrame) -> DataFrame:
    years = county_stage.select("year").union(benchmark_stage.select("year")).distinct()
    return flag_latest(years, "year", "is_latest_cms_year")


def dim_facility(facility_stage: DataFrame) -> DataFrame:
    """Facility identity; county assignment is deferred and says so."""
    return facility_stage.withColumns(
        {
            "county_fips": F.lit(None).cast("string"),
            "geography_match_status": F.lit("not_attempted"),
            "geography_match_method": F.lit(None).cast("string"),
            "geography_resolution_date": F.lit(None).cast("date"),
            "geography_provenance": F.lit("facility geography assignment is deferred"),
        }
    ).select(*columns("dim_facility"))


def fct_medicare_county_year(county_stage: DataFrame) -> DataFrame:
    return county_stage.select(*columns("fct_medicare_county_year"))


def fct_medicare_benchmark_year(benchmark_stage: DataFrame) -> DataFrame:
    return benchmark_stage.select(*columns("fct_medicare_benchmark_year"))


def fct_svi_county(svi_stage: DataFrame) -> DataFrame:
    return svi_stage.select(*columns("fct_svi_county"))


def fct_facility_quality_snapshot(facility_stage: DataFrame) -> DataFrame:
    return facility_stage.select(*columns("fct_facility_quality_snapshot"))


def audit_cms_svi_county_reconciliation(county_fact: DataFrame, svi_fact: DataFrame) -> DataFrame:
    """One row per county of either source, for the latest Medicare year."""
    latest = county_fact.agg(F.max("year")).scalar()
    medicare = county_fact.where(F.col("year") == latest)
    run, modified = "source_manifest_run_id", "source_modified_at"
    cms = one_row(medicare.select("year", run, "source_content_sha256", modified).distinct())
    svi = one_row(svi_fact.select("svi_vintage", run, "source_snapshot_sha256", modified).distinct())
    return (
        reconcile_keys(medicare, svi_fact, "county_fips", "cms", "svi")
        .withColumns({"_cms": cms, "_svi": svi})
        .select(
            "county_fips", "reconciliation_status", "cms_present", "svi_present",
            "cms_row_count", "svi_row_count",
            F.col("_cms.year").alias("cms_latest_year"),
            F.col(f"_cms.{run}").alias(f"cms_{run}"),
            F.col("_cms.source_content_sha256").alias("cms_source_content_sha256"),
            F.col(f"_cms.{modified}").alias(f"cms_{modified}"),
            F.col("_svi.svi_vintage").alias("svi_vintage"),
            F.col(f"_svi.{run}").alias(f"svi_{run}"),
            F.col("_svi.source_snapshot_sha256").alias("svi_source_snapshot_sha256"),
            F.col(f"_svi.{modified}").alias(f"svi_{modified}"),
        )
    )
