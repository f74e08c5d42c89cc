import math
import random
from decimal import ROUND_DOWN, Decimal, getcontext

import pytest

from plumbmart.operators.quantile import exact_quantile

TENTH = Decimal("0.0000000001")


def brute(values, num=3, den=4):
    """Sort and interpolate; truncation applies to the rise, as values are exact."""
    getcontext().prec = 60
    values = sorted(values)
    place = (len(values) - 1) * num
    lo, w = divmod(place, den)
    hi = math.ceil(place / den)
    rise = (values[hi] - values[lo]) * w / den
    if rise < 0:
        raise AssertionError
    return values[lo] + rise.quantize(TENTH, rounding=ROUND_DOWN)


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v decimal(38,10)")


def test_published_example(spark):
    rows = [("a", Decimal(v)) for v in ("0.01", "0.02", "0.03", "0.04")]
    assert exact_quantile(frame(spark, rows), "v").collect()[0].quantile == Decimal("0.0325000000")


def test_groups_against_brute_force(spark):
    random.seed(11)
    rows = []
    for g in range(8):
        for _ in range(random.choice([1, 2, 3, 4, 7, 60])):
            scale = random.choice([2, 6, 14])
            rows.append((f"g{g}", Decimal(random.randint(-10**scale, 10**scale)) * TENTH))
    got = {r.g: r for r in exact_quantile(frame(spark, rows), "v", by=["g"]).collect()}
    for g in {g for g, _ in rows}:
        values = [v for k, v in rows if k == g]
        assert got[g].quantile == brute(values), g
        assert got[g].value_count == len(values)


@pytest.mark.parametrize("seed", [1, 2, 4])
def test_wide_magnitudes_and_close_values(spark, seed):
    """Huge, tiny, equal-as-double and negative values in one group."""
    random.seed(seed)
    values = [Decimal(10) ** random.randint(-10, 26) * random.choice([1, -1]) for _ in range(150)]
    close = Decimal("12345678901234567.0000000001")
    values += [close + TENTH * i for i in range(120)]
    for part in (values, values[:150], values[150:]):
        rows = [("a", v) for v in part]
        got = exact_quantile(frame(spark, rows), "v").collect()[0]
        assert got.quantile == brute(part)


def test_one_value_holding_most_rows(spark):
    rows = [("a", Decimal("0.5"))] * 400 + [("a", Decimal(i) / 1000) for i in range(100)]
    for num in (1, 2, 3):
        got = exact_quantile(frame(spark, rows), "v", numerator=num).collect()[0].quantile
        assert got == brute([v for _, v in rows], num)


def test_nulls_are_left_out_and_nothing_gives_no_row(spark):
    rows = [("a", None), ("a", Decimal(1))]
    assert exact_quantile(frame(spark, rows), "v", by=["g"]).collect()[0].value_count == 1
    empty = frame(spark, rows).where("v > 5")
    assert [r.quantile for r in exact_quantile(empty, "v").collect() if r.quantile is not None] == []
