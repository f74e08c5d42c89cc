"""N-gram Jaccard join of texts by MinHash banding.

``similar(df)`` finds all texts whose sets of five-word runs have a Jaccard
similarity of 0.8 or more: for every row its number of links, and the smallest
id that it can reach by links.

The method. A text's set is sketched by ``bands * rows`` minima of seeded hashes.
Two sets of similarity s agree in a whole band of r rows with probability s**r,
so ``band_plan`` takes the most rows for which the bands that the target recall
needs at the threshold stay within the number of hashes. Rows with an equal band
hash are shuffled together, and every pair of such a bucket is verified on the
full sets. The default recall is 0.9999999 a pair at the very threshold, and
more above it.

What keeps it linear. Equal texts are one class, of which one text is sketched
and compared; its copies count as links. A bucket whose members all meet in one
earlier band is dropped, as that band sees the same pairs. A pair is counted in the
first band where it agrees. Buckets above a size are dealt out in blocks, each
pair of blocks a group of its own, so no task holds an unbounded group; pairs are
counted inside the groups and never become rows: a group gives, for each of its
members, a number of links and one member that it is connected to.

Words are runs of characters other than ASCII white space, with A-Z lower-cased.
A text of one to four words has one run, the whole of it. Texts without a word
(null texts too) link with nothing.

Defined cases: rows that repeat are copies of each other. A null id takes part
but is never the smallest id; a component without any id has a null one. Other
columns are not returned. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from plumbmart.llm.common import WORD, by_value, stored
from plumbmart.llm.components import components
from plumbmart.llm.words import bytes_of, mixed, with_columns, word_hashes

by_value(__name__)

THRESHOLD = 0.8
RUN = 5
RECALL = 0.9999999
HASHES = 128
#: Words and texts of a bucket that go into one block, on average.
BLOCK_WORDS, BLOCK_TEXTS = 400_000, 1_000


def band_plan(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which the recall at the threshold holds with so many hashes."""
    best = None
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


def seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(23)
    draw = lambda: rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(), draw()


def runs_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of RUN words of each text, with the number of its first and of the next one's."""
    data, offsets = bytes_of(column)
    words, row = word_hashes(data, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1)
    long = n >= RUN
    runs = np.where(long, n - RUN + 1, (n > 0).astype(np.int64))
    starts = np.concatenate([[0], np.cumsum(n)])
    ends = np.concatenate([[0], np.cumsum(runs)])
    # One hash of the RUN words from each place on; a short text's words all go into its one run.
    padded = np.concatenate([words, np.zeros(RUN, np.uint64)])
    first = np.repeat(starts[:-1] - ends[:-1], runs) + np.arange(ends[-1])
    left = np.repeat(np.where(long, RUN, n), runs)
    total = np.zeros(len(first), np.uint64)
    for k in range(RUN):
        total = np.where(k < left, mixed(total * np.uint64(0x9E3779B97F4A7C15) + padded[first + k]), total)
    return total, ends


def sketch(column: pa.Array, bands: int, rows: int) -> list[pa.Array]:
    """The band hashes of each text; null for a text without words."""
    runs, ends = runs_of(column)
    some = np.flatnonzero(np.diff(ends))
    out = np.zeros((len(some), bands * rows), np.uint64)
    xor, times = seeds(bands * rows)
    # The texts are taken a few at a time, so that the products stay in the cache.
    for lo in range(0, len(some), 64):
        part = some[lo : lo + 64]
        a, b = ends[part[0]], ends[part[-1] + 1]
        heads = ends[part] - a
        h = runs[a:b]
        for k in range(bands * rows):
            out[lo : lo + len(part), k] = np.minimum.reduceat((h ^ xor[k]) * times[k], heads)
    keys = np.zeros((len(some), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + out[:, k::rows])
    at = np.zeros(len(ends) - 1, np.int32)
    at[some] = bands
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(at)]), pa.int32()), pa.array(keys.ravel().view(np.int64)))
    return [pc.if_else(pa.array(at > 0), lists, pa.scalar(None, lists.type))]


def sketches(df: DataFrame, text: str, bands: int, rows: int) -> DataFrame:
    """``df`` with ``__bands``, the band hashes of the text."""

    def start():
        return lambda column: sketch(column, bands, rows)

    return with_columns(df, text, [StructField("__bands", ArrayType(LongType()))], start)


class Union:
    """Components of the numbers below n."""

    def __init__(self, n: int):
        self.to = list(range(n))

    def find(self, k: int) -> int:
        while self.to[k] != k:
            self.to[k] = self.to[self.to[k]]
            k = self.to[k]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.to[max(a, b)] = min(a, b)


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many runs each set of ``left`` shares with each of ``right`` (numbers of sets)."""
    every = np.concatenate([sets[k] for k in (*left, *right)])
    runs, code, count = np.unique(every, return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1  # runs in one set only are not shared
    keep = count[code] > 1
    owner = np.repeat(np.arange(len(left) + len(right)), [len(sets[k]) for k in (*left, *right)])[keep]
    column = column[code][keep]
    out = np.zeros((len(left), len(right)), np.float32)
    width = max(1, 16_000_000 // max(1, len(left) + len(right)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        table = np.zeros((len(left) + len(right), min(width, int(column[b - 1]) - lo + 1)), np.float32)
        table[owner[a:b], column[a:b] - lo] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out


def group_links(table: pa.Table, threshold: float) -> pa.RecordBatch:
    """(key, links, root) of the members of one group that have a link.

    Pairs are those of the two blocks, or of all members if they are of one
    block, that agree in no band before this one.
    """
    all_keys, side = table.column("key").to_pylist(), table.column("side").to_numpy()
    members = [k for k in range(len(all_keys)) if not k or all_keys[k] != all_keys[k - 1]]
    keys, side = [all_keys[k] for k in members], side[members]
    table = table.take(pa.array(members))
    band = table.column("band")[0].as_py()
    weights = table.column("weight").to_numpy()
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(keys), -1)
    runs, ends = runs_of(table.column("text").combine_chunks())
    sets = [np.unique(runs[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
    sizes = np.array([len(s) for s in sets])
    n_left = int((side == side[0]).sum())
    one_block = n_left == len(keys)
    links, union = np.zeros(len(keys), np.int64), Union(len(keys))
    right = np.arange(0 if one_block else n_left, len(keys))
    for lo in range(0, n_left, 256):
        left = np.arange(lo, min(n_left, lo + 256))
        wanted = bands[left, band][:, None] == bands[right, band][None, :]
        for k in range(band):
            wanted &= bands[left, k][:, None] != bands[right, k][None, :]
        if one_block:
            wanted &= left[:, None] < right[None, :]
        # A set that is smaller by more than the threshold cannot be similar enough.
        a, b = sizes[left][:, None], sizes[right][None, :]
        wanted &= np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9
        x, y = np.nonzero(wanted)
        if not len(x):
            continue
        if len(x) <= 200:
            common = np.array([len(np.intersect1d(sets[left[a]], sets[right[b]], assume_unique=True)) for a, b in zip(x, y, strict=True)])
        else:
            common = common_counts(sets, left, right)[x, y]
        x, y = left[x], right[y]
        near = common >= threshold * (sizes[x] + sizes[y] - common) - 1e-9
        x, y = x[near], y[near]
        for a, b in zip(x.tolist(), y.tolist(), strict=True):
            union.join(a, b)
        np.add.at(links, x, weights[y])
        np.add.at(links, y, weights[x])
    some = np.flatnonzero(links).tolist()
    columns = [pa.array([keys[k] for k in some], pa.binary()), pa.array(links[some], pa.int64()), pa.array([keys[union.find(k)] for k in some], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["key", "links", "root"])


def linked(groups: DataFrame, threshold: float) -> DataFrame:
    """(key, links, root) from rows (bucket, i, j, side, band, key, weight, bands, text).

    The rows of a group are brought together and in order, so groups are read one
    after another; a group may run over several Arrow batches.
    """
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = groups.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            ids = np.stack([table.column(c).to_numpy() for c in ("bucket", "i", "j")])
            edges = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(0)) + 1).tolist()]
            for a, b in zip(edges, edges[1:], strict=False):
                yield group_links(table.slice(a, b - a), threshold)
            rest = table.slice(edges[-1])
        if rest is not None and rest.num_rows:
            yield group_links(rest, threshold)

    return sorted_.mapInArrow(run, "key binary, links long, root binary")


def with_key(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with ``__key``, the digest of its text, and the id under names of our own."""
    return df.withColumns({"__key": F.unhex(F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"))), "__id": F.col(f"`{key}`").cast("long")})


def same_row(a: str, b: str) -> Column:
    """Equality of ids that joins by hash: nulls are equal."""
    return (F.coalesce(F.col(a), F.lit(0)) == F.coalesce(F.col(b), F.lit(0))) & (F.col(a).isNull() == F.col(b).isNull())


def classes_of(df: DataFrame, key: str, text: str, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """The light rows (__id, __key, __bands) of ``df``, and one row for each class of equal texts.

    A class has key, first (its smallest id), weight (its rows), links (other rows
    linked with one of it), and keeper and keeper_id, the class that stands for
    its component and the smallest id there.
    """
    bands, rows = band_plan(threshold, recall)
    texts = with_key(df.select(key, text), key, text).select("__id", "__key", F.col(f"`{text}`").cast("string").alias("__words"))
    light = texts.withColumn("__bytes", F.octet_length("__words"))
    light = stored(sketches(light, "__words", bands, rows).drop("__words"), "sketches")
    some = light.where("__bands is not null").groupBy(F.col("__key").alias("key"))
    classes = stored(some.agg(F.min("__id").alias("first"), F.count("*").alias("weight"), F.max("__bytes").alias("bytes"), F.first("__bands").alias("bands")), "classes")

    each = classes.select("key", "bytes", F.posexplode("bands").alias("band", "bucket"))
    hits = each.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("size"), F.min("band").alias("band"), F.min("key").alias("low"), F.max("key").alias("high"), F.bit_xor(F.xxhash64("key")).alias("mark")
    ).where("n > 1")
    # Buckets with the same members have the same pairs: the first band's stays.
    kept = hits.groupBy("n", "low", "high", "mark").agg(F.min(F.struct("band", "bucket")).alias("b"), F.first("size").alias("size"))
    blocks = F.greatest(F.ceil(F.col("size") / (BLOCK_WORDS * 7)), F.ceil(F.col("n") / BLOCK_TEXTS)).cast("int")
    kept = stored(kept.select("b.band", "b.bucket", blocks.alias("blocks")), "buckets")
    own = F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).cast("int")
    dealt = each.drop("bytes", "band").join(kept, "bucket").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = stored(dealt.select("key", "bucket", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side")), "members")

    # One text of every class that has a bucket, by the key and the smallest id.
    needed = dealt.select("key").distinct().join(classes, "key")
    found = texts.join(needed, (F.col("__key") == F.col("key")) & same_row("__id", "first"))
    one = found.groupBy("key").agg(*(F.first(c).alias(c) for c in ("weight", "bands", "__words"))).withColumnRenamed("__words", "text")
    links = stored(linked(dealt.join(one, "key").select("bucket", "i", "j", "side", "band", "key", "weight", "bands", "text"), threshold), "links")

    counted = links.groupBy("key").agg(F.sum("links").alias("links"))
    reached = components(links.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("vertex", "key")
    joined = classes.drop("bands", "bytes").join(counted, "key", "left").join(reached, "key", "left").withColumn("component", F.coalesce("component", "key"))
    smallest = joined.groupBy("component").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "key")).alias("s"))
    named = joined.join(smallest.select("component", F.col("s.first").alias("keeper_id"), F.col("s.key").alias("keeper")), "component")
    return light, stored(named.select("key", "first", "weight", F.coalesce("links", F.lit(0)).alias("links"), "keeper", "keeper_id"), "classes")


def similar(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each row of ``df``: id, class_id, copy_of, n_links.

    ``class_id`` is the smallest id that links reach, ``copy_of`` the smallest
    with an equal text, ``n_links`` the number of other rows linked directly.
    """
    light, classes = classes_of(df, key, text, threshold, recall)
    joined = light.select("__id", "__key", F.col("__bands").isNotNull().alias("some")).join(classes, (F.col("__key") == F.col("key")) & F.col("some"), "left")
    return joined.select(
        F.col("__id").alias(key),
        F.when(F.col("some"), F.col("keeper_id")).otherwise(F.col("__id")).alias("class_id"),
        F.when(F.col("some"), F.col("first")).otherwise(F.col("__id")).alias("copy_of"),
        F.when(F.col("some"), F.col("links") + F.col("weight") - 1).otherwise(0).alias("n_links"),
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``df`` without those that are linked with a kept one, directly or on a path.

    Of each group the row with the smallest id stays, once. Texts without a word
    all stay.
    """
    _, classes = classes_of(df, key, text, threshold, recall)
    rows = with_key(df, key, text)
    wordless = ~F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).rlike(WORD)
    keepers = classes.where("key = keeper").select("key", "first")
    kept = rows.where(~wordless).join(keepers, (F.col("__key") == F.col("key")) & same_row("__id", "first"), "left_semi")
    kept = kept.dropDuplicates(["__key", "__id"])
    return kept.union(rows.where(wordless)).drop("__key", "__id")
