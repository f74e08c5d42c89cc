"""Joins, set differences and scaffolds written as DataFrame transformations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Parts that the rows of one key are dealt out to, at most the bits of a bigint.
SALTS = 64
# Copies of a row that are made from one array.
REPEAT_BLOCK = 1000
# Rows of a crowded key that meet as many of the other side in one place.
CROWD_BLOCK = 256
# Pairs of such blocks that one task makes.
TASK_BLOCKS = 8


def one_row(df: DataFrame, *cols: str) -> Column:
    """The single row of ``df`` as a struct value usable in any expression.

    It runs once as a scalar subquery, so nothing is joined or multiplied; a
    second row stops the job instead of repeating every result row.
    """
    return df.select(F.struct(*(cols or df.columns))).scalar()


def is_distinct(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def orphan_rows(
    child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]]
) -> DataFrame:
    """Rows of ``child`` whose non-null key has no match in ``parent``."""
    present = child.dropna(subset=[c for c, _ in on])
    keys = parent.select(*(F.col(p).alias(c) for c, p in on))
    return present.join(keys, [c for c, _ in on], "left_anti")


def shared_rows(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key also exists in ``right``."""
    return left.join(right.select(*on), list(on), "left_semi")


def crowds(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The keys that both sides repeat, and the blocks that the rows of either are dealt out into."""

    def crowd(df: DataFrame, name: str) -> DataFrame:
        counted = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
        return counted.where(F.col("__n") > CROWD_BLOCK).select("__key", F.ceil(F.col("__n") / CROWD_BLOCK).cast("bigint").alias(name))

    return crowd(left, "__ls").join(crowd(right, "__rs"), "__key")


def crowd_tasks(left: DataFrame, right: DataFrame, key: str) -> int:
    """Tasks for a crowded join, so that each gets about ``TASK_BLOCKS`` pairs of blocks, however many there are."""
    blocks = crowds(left, right, key).agg(F.sum(F.col("__ls") * F.col("__rs"))).first()[0] or 0
    return max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks // TASK_BLOCKS))


def crowded_left_join(
    left: DataFrame, right: DataFrame, key: str, like: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """A left join on ``key`` whose pairs are spread over tasks where both sides repeat a key.

    Such a key has as many rows as its two counts multiplied, and nothing makes them
    fewer. Its rows are dealt out on either side into blocks of about ``CROWD_BLOCK``,
    and every block of the left meets every block of the right on its own, so no task
    has to write all pairs of a key. ``like`` is counted in place of ``left``, if that
    is dear to compute; it has the keys that are crowded there. ``tasks`` (see ``crowd_tasks``)
    fixes their number, which would else follow the bytes that go in and not the pairs that come
    out. Columns that begin with two underscores are the join's own.
    """
    both = crowds(left if like is None else like, right, key)

    def dealt(df: DataFrame, mine: str, theirs: str, at: str, over: str) -> DataFrame:
        names = [f"`{c}`" for c in df.columns]
        sized = df.join(both, F.col(key) == F.col("__key"), "left").withColumn(
            at, F.pmod(F.xxhash64(*names), F.coalesce(mine, F.lit(1)))
        )
        others = F.sequence(F.lit(0).cast("bigint"), F.coalesce(theirs, F.lit(1)) - 1)
        return sized.withColumn(over, F.explode(others))

    lefts = dealt(left, "__ls", "__rs", "__i", "__j").drop("__key", "__ls")
    rights = dealt(right, "__rs", "__ls", "__j", "__i").drop("__key", "__ls", "__rs").withColumn("__hit", F.lit(True))
    if tasks:
        lefts, rights = (side.repartition(tasks, key, "__i", "__j") for side in (lefts, rights))
    # sent out, the right side would leave the blocks of a key in the task where the left rows are
    joined = lefts.join(rights.hint("merge"), [key, "__i", "__j"], "left")
    # a crowded row has partners in some block, so its blocks without any say nothing
    return joined.where("__rs is null or __hit").drop("__i", "__j", "__rs", "__hit")


def reconcile_keys(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_name: str,
    right_name: str,
) -> DataFrame:
    """Presence and duplicate status of every key of two relations.

    Both sides are counted per key first, so the full join is one row per key
    and side, and reuses the partitioning of the two aggregations.
    """
    l_n, r_n = f"{left_name}_row_count", f"{right_name}_row_count"
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias(l_n))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias(r_n))
    many_l, many_r = F.col(l_n) > 1, F.col(r_n) > 1
    status = (
        F.when(F.col(l_n).isNull(), f"{right_name}_only")
        .when(F.col(r_n).isNull(), f"{left_name}_only")
        .when(many_l & many_r, "duplicate_both")
        .when(many_l, f"{left_name}_duplicate")
        .when(many_r, f"{right_name}_duplicate")
        .otherwise("matched")
    )
    return a.join(b, key, "full").select(
        key,
        status.alias("reconciliation_status"),
        F.col(l_n).isNotNull().alias(f"{left_name}_present"),
        F.col(r_n).isNotNull().alias(f"{right_name}_present"),
        F.coalesce(l_n, F.lit(0).cast("bigint")).alias(l_n),
        F.coalesce(r_n, F.lit(0).cast("bigint")).alias(r_n),
    )


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that do not identify exactly one row."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") != 1)


def _presence(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row of the two sides with its count on either, in one pass."""
    names = [f"`{c}`" for c in left.columns]
    tagged = left.select(*names, F.lit(1).alias("__l"), F.lit(0).alias("__r")).union(
        right.select(*names, F.lit(0), F.lit(1))
    )
    return tagged.groupBy(*names).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side not matched one for one by the other side."""
    over = _presence(left, right).withColumn("__n", F.abs(F.col("__l") - F.col("__r")))
    return _repeated(over, left.columns)


def _repeated(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of every row ``__n`` times."""
    # two short sequences instead of one array as long as the surplus
    blocks = F.sequence(F.lit(0), F.expr(f"(__n - 1) div {REPEAT_BLOCK}"))
    here = F.least(F.lit(REPEAT_BLOCK), F.col("__n") - F.col("__b") * REPEAT_BLOCK)
    repeated = counted.where("__n > 0").withColumn("__b", F.explode(blocks)).withColumn("__i", F.explode(F.sequence(F.lit(1), here)))
    return repeated.select(*(f"`{c}`" for c in columns))


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on one side only."""
    apart = _presence(left, right).where("(__l > 0) <> (__r > 0)")
    return apart.select(*(f"`{c}`" for c in left.columns))


def cell_differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], cells: Sequence[str]
) -> DataFrame:
    """Keys missing on one side, or with any cell that differs (NULL-safe).

    Rows of a repeated key are paired, equal rows first; each pair that differs and
    each row without a partner gives its key once, so the result is never longer
    than the two inputs together. A key with a NULL has no partner. One grouped
    union, no join: copies and hot keys are summed before the shuffle.
    """
    keys = list(keys)
    counted = _presence(left.select(*keys, *cells), right.select(*keys, *cells))
    none = F.lit(False)
    for k in keys:
        none = none | F.col(k).isNull()
    surplus = F.col("__l") - F.col("__r")
    apart = counted.where(none | (surplus != 0)).select(
        *keys,
        F.when(none, F.col("__l") + F.col("__r")).otherwise(F.greatest(surplus, F.lit(0))).alias("__l"),
        F.when(none, 0).otherwise(F.greatest(-surplus, F.lit(0))).alias("__r"),
    )
    pairs = apart.groupBy(*keys).agg(F.greatest(F.sum("__l"), F.sum("__r")).alias("__n"))
    return _repeated(pairs, keys)


def flag_latest(df: DataFrame, column: str, flag: str) -> DataFrame:
    """Mark the rows holding the maximum, without a one-partition window."""
    latest = df.agg(F.max(column)).scalar()
    return df.withColumn(flag, F.col(column) == latest)


def inline(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A few literal rows as a relation, without a Python worker."""
    literals = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in row) + ")"
        for row in rows
    )
    return spark.sql(f"select * from values {literals} as t({', '.join(names)})")


def scaffold(categories: DataFrame, counted: DataFrame, on: str, count: str) -> DataFrame:
    """Every category with its count, zero where nothing was counted."""
    return categories.join(counted.select(on, count), on, "left").withColumn(
        count, F.coalesce(F.col(count), F.lit(0).cast("bigint"))
    )


def later_occurrences(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Every row after the first of its key, with the place of that first row.

    Of the rows of a key that tie on ``order`` the one with the smallest digest is
    first, so reruns agree; of its exact copies all but one are later. Rows with a
    NULL in the key belong to no key and are left out. Exact copies are counted
    before the shuffle, and the other rows of a key are dealt out to ``SALTS`` parts,
    so neither a third of all rows under one key nor a third that are one row meet
    in one task; of a key one row a task of the first shuffle is compared.
    """
    keys, names = list(keys), [f"`{c}`" for c in df.columns]
    counted = df.dropna(subset=keys).groupBy(*names).agg(F.count(F.lit(1)).alias("__c"))
    digest = F.struct(F.xxhash64(*names).alias("a"), F.xxhash64(F.lit(1), *names).alias("b"))
    place = F.struct(F.col(f"`{order}`").alias("o"), digest.alias("d"))
    dealt = counted.withColumn("__salt", F.pmod(F.xxhash64(*names), F.lit(SALTS)).cast("int"))
    # a key's parts are the bits of one number, so its rows are added up once, before the shuffle too
    known = dealt.groupBy(*keys).agg(
        F.min(place).alias("__first"), F.sum("__c").alias("key_row_count"), F.bit_or(F.expr("shiftleft(1L, __salt)")).alias("__parts")
    ).where(F.col("key_row_count") > 1)
    bits = F.expr(f"filter(sequence(0, {SALTS - 1}), i -> getbit(__parts, i) = 1)")
    known = known.select(*keys, F.explode(bits).alias("__salt"), "__first", "key_row_count")
    # the place is taken again instead of being shuffled with every row
    found = dealt.join(known, [*keys, "__salt"])
    later = found.withColumn("__n", F.col("__c") - F.when(place == F.col("__first"), 1).otherwise(0))
    later = later.withColumn("first_seen_at", F.col("__first.o"))
    return _repeated(later, [*df.columns, "first_seen_at", "key_row_count"])
