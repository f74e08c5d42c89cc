"""Screening: one national threshold, a two-by-two class, a five-row summary."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbmart.operators import evidence as ev
from plumbmart.operators.quantile import exact_quantile
from plumbmart.operators.relational import crowd_tasks, crowded_left_join, inline, one_row, scaffold
from plumbmart.plans.relations import columns
from plumbmart.sources import contracts as C

# What the class of a row is read from, beside the threshold.
CLASSIFIED = ("benes_op_dlys_pct", "benes_op_dlys_pct_status", "rpl_themes", "rpl_themes_status")


def reported(value: str) -> Column:
    """Eligible only when the status says reported and the value is there."""
    return (F.col(f"{value}_status") == "reported") & F.col(value).isNotNull()


def int_county_screening_threshold(
    build_audit: DataFrame,
    years: DataFrame,
    counties: DataFrame,
    county_fact: DataFrame,
    svi_fact: DataFrame,
) -> DataFrame:
    """The 75th percentile of the reported share over current counties."""
    latest = years.where("is_latest_cms_year").select("year").scalar()
    medicare = county_fact.where(F.col("year") == latest)
    share = "benes_op_dlys_pct"
    current = medicare.join(
        counties.where("is_current_county").select("county_fips"), "county_fips"
    ).select(share, f"{share}_status")
    unavailable = (F.col(f"{share}_status") != "reported") | F.col(share).isNull()
    counts = one_row(
        current.agg(
            F.count(F.lit(1)).alias("current"),
            F.count_if(reported(share)).alias("eligible"),
            F.count_if(unavailable).alias("excluded"),
        )
    )
    p75 = exact_quantile(current.where(reported(share)), share, alias="p75")
    stamps = ("source_manifest_run_id", "source_retrieved_at_utc", "source_modified_at")
    cms = one_row(medicare.select(*stamps, "source_content_sha256").distinct())
    svi = one_row(svi_fact.select("svi_vintage", *stamps, "source_snapshot_sha256").distinct())

    def lineage(prefix: str, hash_name: str) -> list[Column]:
        names = ("source_manifest_run_id", hash_name, *stamps[1:])
        return [F.col(f"_{prefix}.{n}").alias(f"{prefix}_{n}") for n in names]

    return (
        build_audit.withColumns(
            {
                "_year": latest,
                "_counts": counts,
                "_p75": p75.select("p75").scalar(),
                "_cms": cms,
                "_svi": svi,
            }
        )
        .select(
            F.lit(C.SCREENING_VERSION).alias("screening_definition_version"),
            F.col("build_id").alias("screening_run_id"),
            "input_set_sha256",
            "build_format_version",
            F.col("_year").alias("cms_year"),
            F.col("_svi.svi_vintage").alias("svi_vintage"),
            F.lit(share.upper()).alias("threshold_metric"),
            F.lit("0.75").cast("decimal(3,2)").alias("threshold_quantile"),
            F.lit("continuous_linear_type_7").alias("threshold_method"),
            F.col("_p75").alias("dialysis_use_p75_threshold"),
            F.col("_counts.current").alias("current_county_count"),
            F.col("_counts.eligible").alias("threshold_eligible_count"),
            F.col("_counts.excluded").alias("threshold_excluded_count"),
            *lineage("cms", "source_content_sha256"),
            *lineage("svi", "source_snapshot_sha256"),
        )
    )


class Sides(NamedTuple):
    """What the screening mart joins: its county rows and the index rows, by ``county_fips``, beside one run."""

    current: DataFrame
    known: DataFrame
    svi: DataFrame
    run: Column


def _sides(
    threshold: DataFrame,
    counties: DataFrame,
    county_fact: DataFrame,
    svi_fact: DataFrame,
    reconciliation: DataFrame,
) -> Sides:
    """The first joins share the key ``county_fips``, so each side is shuffled once. The
    one-row threshold arrives as a scalar and its year prunes the fact scan.
    """
    run = one_row(
        threshold,
        "screening_definition_version", "screening_run_id", "input_set_sha256",
        "cms_year", "svi_vintage", "dialysis_use_p75_threshold", "threshold_eligible_count",
    )
    stamps = ("source_manifest_run_id", "source_retrieved_at_utc", "source_modified_at")

    def stamped(df: DataFrame, prefix: str, hash_name: str) -> list[Column]:
        return [F.col(n).alias(f"{prefix}_{n}") for n in (*stamps, hash_name)]

    medicare = county_fact.where(F.col("year") == threshold.select("cms_year").scalar()).select(
        "county_fips", "benes_om_cnt", "benes_om_cnt_status",
        "benes_op_dlys_pct", "benes_op_dlys_pct_status",
        *stamped(county_fact, "cms", "source_content_sha256"),
    )
    svi = svi_fact.where(F.col("svi_vintage") == threshold.select("svi_vintage").scalar()).select(
        "county_fips", "acs_period_start", "acs_period_end", "rpl_themes", "rpl_themes_status",
        *stamped(svi_fact, "svi", "source_snapshot_sha256"),
    )
    checked = reconciliation.select(
        "county_fips", "reconciliation_status",
        F.col("cms_row_count").alias("cms_reconciliation_row_count"),
        F.col("svi_row_count").alias("svi_reconciliation_row_count"),
    )
    current = counties.where("is_current_county")
    known = (
        current.select(*(c for c in current.columns if c in columns("mart_county_screening")))
        .join(medicare, "county_fips", "left")
        .join(checked, "county_fips", "left")
    )
    return Sides(current, known, svi, run)


def mart_county_screening(
    threshold: DataFrame,
    counties: DataFrame,
    county_fact: DataFrame,
    svi_fact: DataFrame,
    reconciliation: DataFrame,
) -> DataFrame:
    """One row per current county: two components, their bands and the class.

    Current counties are rows of the index, so a code that repeats there repeats on both
    sides of its join, whose pairs are spread over tasks.
    """
    current, known, svi, run = _sides(threshold, counties, county_fact, svi_fact, reconciliation)
    joined = crowded_left_join(known, svi, "county_fips", like=current).withColumn("_run", run).select("*", "_run.*")
    return classify(joined).select(*columns("mart_county_screening"))


def _different(df: DataFrame, names: Iterable[str], alias: str) -> DataFrame:
    """The different rows of ``df`` in those of its columns, counted."""
    wanted = set(names)
    return df.groupBy(*(c for c in df.columns if c in wanted)).agg(F.count(F.lit(1)).alias(alias))


def _pairs() -> Column:
    """How many rows of the mart a row of counted sides stands for."""
    return F.col("_lefts") * F.coalesce("_rights", F.lit(1).cast("bigint"))


def counted_county_screening(
    threshold: DataFrame,
    counties: DataFrame,
    county_fact: DataFrame,
    svi_fact: DataFrame,
    reconciliation: DataFrame,
    names: Sequence[str],
    times: str,
) -> DataFrame:
    """The rows of the screening mart in the columns ``names``, counted in ``times`` and not repeated.

    Rows that agree in what is asked for are counted on either side before these meet, so
    a code that n counties share has as many rows here as its different county rows times
    its different scores, and scores of four decimals are few, whatever n is. How the join is
    spread is counted at once, so the relations should be stored.
    """
    current, known, svi, run = _sides(threshold, counties, county_fact, svi_fact, reconciliation)
    needed = {"county_fips", *names, *CLASSIFIED}
    lefts, rights = _different(known, needed, "_lefts"), _different(svi, needed, "_rights")
    like = _different(current, needed, "_lefts")
    tasks = crowd_tasks(like, rights, "county_fips")
    joined = crowded_left_join(lefts, rights, "county_fips", like=like, tasks=tasks)
    rows = classify(joined.withColumn("_run", run).select("*", "_run.*"))
    return rows.select(*names, _pairs().alias(times))


def county_screening_digests(
    threshold: DataFrame,
    counties: DataFrame,
    county_fact: DataFrame,
    svi_fact: DataFrame,
    reconciliation: DataFrame,
) -> tuple[DataFrame, int]:
    """Each different row of the screening mart as ``row_digest`` ``h`` with its number ``n``, and the tasks that share them.

    A code that n counties share has n times its different scores as different rows, and
    each has a digest of its own. So either side makes the text of its cells once, as runs
    between cells of the other in the order of names, and a pair joins the runs. The
    relations should be stored, as above.
    """
    current, known, svi, run = _sides(threshold, counties, county_fact, svi_fact, reconciliation)
    names = sorted(columns("mart_county_screening"))
    key = "county_fips"
    like, rights = _different(current, names, "_lefts"), _different(svi, names, "_rights")
    tasks = crowd_tasks(like, rights, key)
    lefts = use_flags(_different(known, names, "_lefts").withColumn("_run", run).select("*", "_run.*"))
    rights = vulnerability_flags(rights)

    def side(name: str) -> str:
        return "left" if name in lefts.columns else "right" if name in rights.columns else "pair"

    runs = [(where, f"_text{i}", list(run)) for i, (where, run) in enumerate(groupby(names, side))]

    def texts(df: DataFrame, where: str, *kept: str) -> DataFrame:
        return df.select(key, *kept, *(ev.row_text(run).alias(name) for at, name, run in runs if at == where))

    # the flags of a county without an index row
    absent = {"social_vulnerability_band": "insufficient_data"}

    def piece(where: str, name: str, run: list[str]) -> Column:
        if where == "pair":
            return ev.row_text(run)
        none = F.concat(*(ev.cell_text(F.lit(absent.get(c))) for c in run))
        return F.col(name) if where == "left" else F.coalesce(name, none)

    joined = crowded_left_join(
        texts(lefts, "left", "dialysis_use_band", "_lefts"), texts(rights, "right", "social_vulnerability_band", "_rights"),
        key, like=like, tasks=tasks,
    )
    rows = quadrants(joined.fillna(absent))
    return rows.select(F.sha2(F.concat(*(piece(*run) for run in runs)), 256).alias("h"), _pairs().alias("n")), tasks


def _band(ok: Column, high: Column, noun: str) -> Column:
    return (
        F.when(ok & high, f"higher_{noun}")
        .when(ok, f"lower_{noun}")
        .otherwise("insufficient_data")
    )


def use_flags(df: DataFrame) -> DataFrame:
    """Availability, flag and band of the Medicare component."""
    use_ok = reported("benes_op_dlys_pct")
    use_high = F.col("benes_op_dlys_pct") >= F.col("dialysis_use_p75_threshold")
    return df.withColumns(
        {
            "is_dialysis_use_threshold_eligible": use_ok,
            "is_higher_observed_dialysis_use": F.when(use_ok, use_high),
            "dialysis_use_band": _band(use_ok, use_high, "use"),
        }
    )


def vulnerability_flags(df: DataFrame) -> DataFrame:
    """Flag and band of the index component."""
    vul_ok = reported("rpl_themes")
    vul_high = F.col("rpl_themes") >= F.lit(C.VULNERABILITY_CUT).cast("decimal(3,2)")
    return df.withColumns(
        {
            "is_higher_social_vulnerability": F.when(vul_ok, vul_high),
            "social_vulnerability_band": _band(vul_ok, vul_high, "vulnerability"),
        }
    )


def quadrants(df: DataFrame) -> DataFrame:
    """Data status, reason and quadrant from the two bands."""
    no_use = F.col("dialysis_use_band") == "insufficient_data"
    no_vul = F.col("social_vulnerability_band") == "insufficient_data"
    return df.withColumns(
        {
            "screening_data_status": F.when(no_use | no_vul, "insufficient_data").otherwise(
                "complete"
            ),
            "screening_insufficient_reason": F.when(no_use & no_vul, "both_components_unavailable")
            .when(no_use, "dialysis_use_component_unavailable")
            .when(no_vul, "social_vulnerability_component_unavailable"),
            "screening_quadrant": F.when(no_use | no_vul, "insufficient_data").otherwise(
                F.concat_ws("_", "dialysis_use_band", "social_vulnerability_band")
            ),
        }
    )


def classify(df: DataFrame) -> DataFrame:
    """Availability, nullable flags, bands, data status, reason and quadrant."""
    return quadrants(vulnerability_flags(use_flags(df)))


def audit_screening_quadrant_summary(threshold: DataFrame, mart: DataFrame) -> DataFrame:
    """Every quadrant with its count, beside the run totals.

    The mart is read once: the totals are sums over the per-quadrant counts.
    """
    use, vul = F.col("is_higher_observed_dialysis_use"), F.col("is_higher_social_vulnerability")
    measures = {
        "screening_row_count": F.count(F.lit(1)),
        "complete_data_count": F.count_if(F.col("screening_data_status") == "complete"),
        "insufficient_data_count": F.count_if(
            F.col("screening_data_status") == "insufficient_data"
        ),
        "higher_use_count": F.count_if(use),
        "lower_use_count": F.count_if(~use),
        "higher_vulnerability_count": F.count_if(vul),
        "lower_vulnerability_count": F.count_if(~vul),
    }
    counted = mart.groupBy("screening_quadrant").agg(
        *(expr.alias(name) for name, expr in measures.items())
    )
    totals = counted.agg(
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in measures)
    ).withColumnRenamed("screening_row_count", "total_screening_row_count")
    categories = inline(
        mart.sparkSession, ("category_display_order", "screening_quadrant"), C.QUADRANTS
    )
    return (
        scaffold(categories, counted, "screening_quadrant", "screening_row_count")
        .withColumns({"_totals": one_row(totals), "_run": one_row(threshold)})
        .select("category_display_order", "screening_quadrant", "screening_row_count",
                "_totals.*", "_run.*")
        .select(*columns("audit_screening_quadrant_summary"))
    )
