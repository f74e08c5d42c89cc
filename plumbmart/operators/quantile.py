"""Exact continuous quantile (type 7) on decimals, global or per group.

Values are counted per distinct value with a map-side combine; the counts are put
in order by range partitioning and stored. A value's rank is the count before its
part plus the count before it in its part, so no task sees more than one part,
however the values are spread and however many rows a group has. Counting and
ranking use the declared type; only the last step, on two values a group, is wider.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbmart.operators.ordering import ordered, running_sum
from plumbmart.operators.relational import one_row

RESULT = "decimal(38,10)"


def exact_quantile(
    df: DataFrame,
    value: str,
    *,
    by: Sequence[str] = (),
    numerator: int = 3,
    denominator: int = 4,
    alias: str = "quantile",
) -> DataFrame:
    """``by`` columns, ``alias`` (decimal(38,10)) and ``value_count``.

    The interpolation is exact, truncated at the tenth place.
    """
    by = list(by)
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumnRenamed(value, "_v")
    )
    table = ordered(counted, [*(F.col(c) for c in by), F.col("_v")], "quantile")
    ranked = running_sum(table, "_n", "_before")
    groups = {c: f"_g{i}" for i, c in enumerate(by)}
    whole = ranked.groupBy(*(F.col(c).alias(g) for c, g in groups.items())).agg(
        F.sum("_n").alias("_total"), F.min("_before").alias("_start")
    )
    if by:
        same = [F.col(c).eqNullSafe(F.col(g)) for c, g in groups.items()]
        placed = ranked.join(whole, same).drop(*groups.values())
    else:
        placed = ranked.withColumn("_w", one_row(whole)).select("_v", "_n", "_before", "_w._total", "_w._start")
    rank = (F.col("_total") - 1) * numerator
    placed = placed.withColumns(
        {"_at": F.col("_before") - F.col("_start"), "_lo": F.floor(rank / denominator), "_hi": F.ceil(rank / denominator)}
    )
    picked = placed.where(_holds("_lo") | _holds("_hi")).groupBy(*by).agg(
        F.max(F.when(_holds("_lo"), F.col("_v"))).alias("_low"),
        F.max(F.when(_holds("_hi"), F.col("_v"))).alias("_high"),
        F.max("_total").alias("_total"),
    )
    terms = F.array(*(t.cast(RESULT) for t in _interpolation(numerator, denominator)))
    # a sum keeps scale and width of its type, which the sum of two columns does not
    each = picked.select(*by, "_total", F.explode(terms).alias("_t"))
    return each.groupBy(*by, "_total").agg(F.sum("_t").alias("_q")).select(
        *by, F.col("_q").cast(RESULT).alias(alias), F.col("_total").alias("value_count")
    )


def _interpolation(numerator: int, denominator: int) -> list[Column]:
    """Parts that add up to low + (high - low) * weight, whole numbers and fractions apart."""
    one, parts = F.lit(1).cast("decimal(1,0)"), F.lit(denominator).cast("decimal(4,0)")
    weight = F.pmod((F.col("_total") - 1) * numerator, F.lit(denominator)).cast("decimal(4,0)")

    def split(name: str) -> tuple[Column, Column]:
        x = F.col(name).cast(RESULT)
        return F.floor(x).cast("decimal(28,0)"), F.pmod(x, one).cast("decimal(10,10)")

    (low, low_rest), (high, high_rest) = split("_low"), split("_high")
    rise = high - low
    left = F.pmod(rise, parts).cast("decimal(4,0)")
    whole = ((rise - left) / parts).cast("decimal(28,0)") * weight
    rest = ((left + (high_rest - low_rest)) * weight).cast("decimal(24,10)")
    unit = (parts * F.lit("1E-10").cast("decimal(10,10)")).cast("decimal(14,10)")
    return [low, low_rest, whole, ((rest - F.pmod(rest, unit)).cast("decimal(24,10)") / parts)]


def _holds(rank: str) -> Column:
    """Whether a counted value covers the (zero-based) rank."""
    return (F.col(rank) >= F.col("_at")) & (F.col(rank) < F.col("_at") + F.col("_n"))
