"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source has a weight and at most ``epochs`` times its size in words to give.
Shares of the total go by weight; a source whose share is above its cap is
clamped there and the rest is shared among the others by weight, until none is
above. That state is one number, the *level* (words per unit of weight of the
open sources): a source is clamped exactly if its cap is below weight * level,
and the level only rises. So a round is one sum over the sources and the loop
ends when no further source is clamped.

A source then takes ``floor(target / size)`` whole repetitions of all its
documents and one fractional repetition: those documents with the smallest
seeded hash of their id that make up the words left over. Documents above the
mean size are taken first, in proportion, and the smaller ones make up what those
miss; so as far as there are small ones the target is missed by half a small
document at most (or by the rows that agree in id and size with the one at the
border, which are taken alike).

Scale: nothing but sums per source and per (source, hash range) is shuffled. The
border document is found by ranges of the hash: 4096 ranges, then 4096 within
the one that holds the border, then the rows of that one cell. So no
task sees a whole source, however large. Sources are numbered without a single
sorting task. The plan has one row a source; its join with the documents is
salted, so a source with a third of all rows spreads over the tasks.

Defined cases: a null text has size 0; a null source is a source of its own and
comes last; sources of size 0 have target 0; an empty table gives an empty one.
A null id is hashed as an empty one. Input columns named like a result are
replaced. Reruns agree, as the order is that of seeded hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbmart.llm.common import WORD, stored, without
from plumbmart.llm.ordering import ranked

EPOCHS = 3
SEED = "mix"
SALTS = 32
RANGES = 4096
RESULTS = ("size", "source_size", "target", "copies")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def order_hash(key: Column, seed: str) -> Column:
    """60 seeded pseudo-random bits of a key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def prepared(df: DataFrame, key: str, text: str, source: str, seed: str) -> DataFrame:
    """``df`` with its size (``__size``), its source as a non-null name, and its place in the seeded order."""
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit(""))
    ident = F.col(f"`{key}`")
    return df.withColumns(
        {"__size": word_count(F.col(f"`{text}`")), "__source": name, "__u": order_hash(ident, seed), "__id": F.coalesce(ident.cast("string"), F.lit(""))}
    )


def water_level(sources: DataFrame, total: int) -> float:
    """The level at which open sources give weight * level and the others their cap."""
    level = 0.0
    while True:
        clamped = F.col("cap") < F.col("weight") * level
        row = sources.agg(
            F.sum(F.when(clamped, F.col("cap")).otherwise(0)).alias("given"), F.sum(F.when(clamped, 0.0).otherwise(F.col("weight"))).alias("open")
        ).first()
        if not row.open:
            return level
        new = (total - (row.given or 0)) / row.open
        if new <= level:
            return level
        level = new


def targets(sizes: DataFrame, weight: Callable[[Column], Column], epochs: int = EPOCHS) -> DataFrame:
    """The target of every source: ``sizes`` has (__source, source_size); weights go by rank."""
    numbered = ranked(sizes, [F.col("__source") == "", F.col("__source")], "rank", "sources")
    sources = stored(numbered.withColumns({"weight": weight(F.col("rank")).cast("double"), "cap": F.col("source_size") * epochs}), "weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, total)
    return sources.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * level))


def border(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """Of every source the place of the last row that ``left`` words reach: (__source, last).

    ``rows`` has (__source, size, __u, __id) and ``goal`` (__source, left). The
    place is a struct (__u, __id, size); where the words end between two ranges
    of the hash, it is the beginning of a range with size -1.
    """

    def last_cell(cells: DataFrame, before: Column, *by: str) -> DataFrame:
        """Of every source the last cell that begins below what is left, and the words before it."""
        run = F.sum("words").over(Window.partitionBy("__source").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1))
        reached = cells.withColumn("before", F.coalesce(run, F.lit(0)) + before).where("before < left")
        last = reached.groupBy("__source").agg(F.max(F.struct(*by, "before")).alias("b"))
        return last.select("__source", *(F.col(f"b.{c}").alias(c) for c in by), F.col("b.before").alias("words_before"))

    split = rows.withColumns({"c1": F.shiftright("__u", 48), "c2": F.shiftright("__u", 36).bitwiseAND(RANGES - 1)})
    coarse = split.groupBy("__source", "c1").agg(F.sum("size").alias("words")).join(goal, "__source")
    first = stored(last_cell(coarse, F.lit(0), "c1"), "border1")
    fine = split.join(first, ["__source", "c1"]).groupBy("__source", "c1", "c2", "words_before").agg(F.sum("size").alias("words")).join(goal, "__source")
    second = stored(last_cell(fine, F.col("words_before"), "c1", "c2"), "border2")
    inner = split.join(second, ["__source", "c1", "c2"]).join(goal, "__source")
    run = F.sum("size").over(Window.partitionBy("__source").orderBy("__u", "__id", "size").rowsBetween(Window.unboundedPreceding, -1))
    reached = inner.withColumn("before", F.coalesce(run, F.lit(0)) + F.col("words_before")).where("before + size / 2 <= left")
    cut = reached.groupBy("__source").agg(F.max(F.struct("__u", "__id", "size")).alias("last"))
    begin = F.struct((F.shiftleft("c1", 48) + F.shiftleft("c2", 36)).alias("__u"), F.lit("").alias("__id"), F.lit(-1).cast("long").alias("size"))
    return second.select("__source", begin.alias("begin")).join(cut, "__source", "left").select("__source", F.coalesce("last", "begin").alias("last"))


def plan(rows: DataFrame, weight: Callable[[Column], Column], epochs: int = EPOCHS) -> DataFrame:
    """One row a source: target, whole repetitions, and the last documents of the fractional one.

    ``rows`` has (__source, size, __u, __id, large) and is read several times: store it.
    """
    goal = targets(rows.groupBy("__source").agg(F.sum("size").alias("source_size"), F.sum(F.when(F.col("large"), F.col("size")).otherwise(0)).alias("large_size")), weight, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("whole", whole).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = stored(goal.withColumn("large_left", F.col("left") * F.col("large_size") / F.greatest(F.col("source_size"), F.lit(1))), "targets")
    # Large documents first; what they miss of their part, the small ones make up.
    large = rows.where("large")
    last = stored(border(large, goal.select("__source", F.col("large_left").alias("left"))).withColumnRenamed("last", "last_large"), "large")
    given = large.join(last, "__source").where(F.struct("__u", "__id", "size") <= F.col("last_large")).groupBy("__source").agg(F.sum("size").alias("given"))
    goal = stored(goal.join(last, "__source", "left").join(given, "__source", "left").withColumn("small_left", F.col("left") - F.coalesce("given", F.lit(0))), "targets")
    small = border(rows.where("not large"), goal.select("__source", F.col("small_left").alias("left"))).withColumnRenamed("last", "last_small")
    return goal.join(small, "__source", "left").select("__source", "source_size", "target", "whole", "last_large", "last_small")


def mix(
    df: DataFrame, weight: Callable[[Column], Column], key: str = "doc_id", text: str = "text", source: str = "source", epochs: int = EPOCHS, seed: str = SEED, results: tuple[str, str, str, str] = RESULTS
) -> DataFrame:
    """``df`` with its size, its source's size and target, and the copies that the mix takes, under the names of ``results``."""
    rows = prepared(df, key, text, source, seed)
    light = stored(rows.select("__source", F.col("__size").alias("size"), "__u", "__id"), "sizes")
    mean = light.agg(F.avg("size")).first()[0] or 0.0
    per_source = stored(plan(light.withColumn("large", F.col("size") > mean), weight, epochs), "mix")
    salted = per_source.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = salted.select(*(F.col(c).alias(f"__{c.removeprefix('__')}") for c in salted.columns))
    joined = rows.withColumn("__salt", F.pmod(F.col("__u"), F.lit(SALTS)).cast("int")).join(salted, ["__source", "__salt"])
    # A source without a border there has nothing to take there.
    last = F.when(F.col("__size") > mean, F.col("__last_large")).otherwise(F.col("__last_small"))
    extra = F.coalesce(F.struct(F.col("__u"), F.col("__id"), F.col("__size").alias("size")) <= last, F.lit(False)) & (F.col("__whole") < epochs)
    made = dict(zip(results, (F.col("__size"), F.col("__source_size"), F.col("__target"), (F.col("__whole") + extra.cast("int")).cast("int")), strict=True))
    return joined.select(*(F.col(f"`{c}`") for c in without(df, *results).columns), *(c.alias(n) for n, c in made.items()))


def repeated(mixed: DataFrame, copies: str) -> DataFrame:
    """The rows of the mix: every row as often as it is taken."""
    times = F.when(F.col(copies) > 0, F.sequence(F.lit(1), F.col(copies))).otherwise(F.array().cast("array<int>"))
    return mixed.withColumn(copies, F.explode(times)).drop(copies)


def cycle(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating."""
    return (rank - 1) % 3 + 1
