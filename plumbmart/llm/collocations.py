"""Collocations of each language by best-first growth of phrases under admissible bounds.

``collocations(df)`` returns each language's best phrases of 2 to ``longest``
words with their counts and score.

The score of a phrase is that of its weakest cut: floor(1000 * a * n / (l * r)),
with a, l, r the counts of the phrase and of its two parts and n all words of the
language. As r >= a, the cut behind a prefix p bounds the score of *every* phrase
that begins with p by floor(1000 * n / count(p)), and the first word is the most
frequent prefix, so growth is ordered by first words, rarest first.

The method. First words are expanded in waves of falling bound: those that make up
an eighth of a language's words, then all others. A wave grows its phrases a word
at a time, keeping those with ``least`` occurrences (no phrase is more frequent
than its prefix), counts the second parts of those that survive, and scores them.
A language is settled when its ``top``-th surviving score is above the bound of
every first word not expanded, so that not even a tie can come from there; only
languages that are not settled go into the next wave.

A phrase falls away if a longer candidate is as frequent. Then the phrase with one
word more at one side is as frequent too: all its occurrences have the same
neighbour there, which is seen where they are counted.

Scale. Every step is one pass over the texts that counts 64-bit hashes of phrases
in Arrow batches and sums them by Spark. What is frequent goes back to the next
pass as a bit table of at most ``2**BITS`` bits, whatever the number of phrases: a
filter that may pass too much but misses nothing. Counts of results are of the
phrases' strings, so hashes decide nothing but the test whether all neighbours are
equal (64 bits). Common words and phrases are summed before the shuffle, and the
number of rows of a language is never in one task: ranks are taken after each
partition has kept its best.

Null texts are empty, a null language is ``und``. Repeated rows count each time.
Texts are read whole; very long ones are hashed in chunks. Ties of the score go by
count, then by phrase. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbmart.llm.common import by_value, stored
from plumbmart.llm.words import BASE, BYTE_KEYS, LOWER, bytes_of, mixed, spans

by_value(__name__)

#: Bytes of text handled at once, or one longer text.
BLOCK = 4 << 20
#: A bit table has at most 2**BITS bits, and sixteen a key below that.
BITS = 28
#: The first wave's share of a language's words.
SHARE = 8

HARD = np.zeros(256, bool)
HARD[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
SEPARATES = HARD.copy()
SEPARATES[[0x20, 0x09]] = True


@dataclass
class Tokens:
    """Words of some rows in order: where they stand in ``text``, their hashes (language included), their piece and row."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    hash: np.ndarray
    piece: np.ndarray
    row: np.ndarray

    def phrase(self, first: int, words: int) -> str:
        last = first + words - 1
        whole = self.text[self.start[first] : self.start[last] + self.length[last]].tobytes().decode()
        if "  " in whole or "\t" in whole:
            return " ".join(x for x in whole.replace("\t", " ").split(" ") if x)
        return whole


def language_key(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def tokens(texts: pa.Array, langs: list[str]) -> Tokens:
    data, offsets = bytes_of(texts)
    data = LOWER[data]
    starts, lengths, hashes, pieces = [], [], [], []
    power = np.ones(1, np.uint64)
    breaks = 0
    for s, e in spans(data):
        b = data[s:e]
        solid = ~SEPARATES[b]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        edges = offsets[(offsets >= s) & (offsets < e)] - s
        first[edges] = solid[edges]
        at = np.flatnonzero(first)
        hard = np.cumsum(HARD[b])
        if len(at):
            inside = np.flatnonzero(solid)
            heads = np.searchsorted(inside, at)
            size = np.diff(np.append(heads, len(inside)))
            within = np.arange(len(inside)) - np.repeat(heads, size)
            if (longest := int(size.max())) > len(power):
                power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(longest, BASE)]))
            hashes.append(np.add.reduceat(BYTE_KEYS[b[inside]] * power[within], heads))
            starts.append(at + s)
            lengths.append(size)
            pieces.append(breaks + hard[at])
        breaks += int(hard[-1]) if len(hard) else 0
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start = join(starts, np.int64)
    row = np.searchsorted(offsets, start, "right") - 1
    keys = np.array([language_key(x) for x in langs], np.uint64)
    word = mixed(join(hashes, np.uint64) ^ keys[row]) if len(row) else np.zeros(0, np.uint64)
    return Tokens(data, start, join(lengths, np.int64), word, join(pieces, np.int64) + row, row)


def longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one word more."""
    return mixed(hashes * BASE + words)


@dataclass
class Bits:
    """Leading bits of hashes, as a table."""

    width: int
    table: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.width)
        return (self.table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bits(keys: DataFrame, column: str) -> Bits | None:
    """The bit table of a column of hashes; None if there are none. The driver gets 32 MB at most."""
    count = keys.count()
    if not count:
        return None
    width = min(BITS, max(16, (16 * count).bit_length()))
    at = F.shiftrightunsigned(F.col(column), 64 - width) + 1
    rows = keys.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m")).collect()
    table = np.zeros(max(1 << width >> 3, 4096), np.uint8)
    for b, m in rows:
        table[(b - 1) * 4096 : b * 4096] = np.frombuffer(m, np.uint8)
    return Bits(width, table)


def scan(docs: DataFrame, schema: str, work: Callable[[Tokens, list[str]], Iterator[list[pa.Array]]]) -> DataFrame:
    """Rows that ``work`` makes of the words of ``docs`` (lang, text), in Arrow batches."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(bytes_of(batch.column(1))[1])
            lo = 0
            while lo < len(sizes):
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), BLOCK, "right")) + lo)
                langs = batch.column(0).slice(lo, hi - lo).to_pylist()
                for columns in work(tokens(batch.column(1).slice(lo, hi - lo), langs), langs):
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                lo = hi

    return docs.mapInArrow(run, schema)


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def count_words(t: Tokens, langs: list[str]) -> Iterator[list[pa.Array]]:
    kinds, first, n = np.unique(t.hash, return_index=True, return_counts=True)
    words = [t.phrase(k, 1) for k in first.tolist()]
    yield [pa.array([langs[r] for r in t.row[first].tolist()], pa.string()), pa.array(words, pa.string()), signed(kinds), pa.array(n)]


def windows(t: Tokens, seeds: Bits, words: Bits, levels: dict[int, Bits], size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of phrases of ``size`` words: the first is a seed, all are frequent, as are the levels' prefixes."""
    at = np.flatnonzero(seeds.has(t.hash)) if len(t.hash) else np.zeros(0, np.int64)
    hashes = t.hash[at]
    for k in range(1, size):
        inside = at + k < len(t.hash)
        at, hashes = at[inside], hashes[inside]
        good = (t.piece[at + k] == t.piece[at]) & words.has(t.hash[at + k])
        if k > 1:
            good &= levels[k].has(hashes)
        at = at[good]
        hashes = longer(hashes[good], t.hash[at + k])
    return at, hashes


def count_grown(docs: DataFrame, seeds: Bits, words: Bits, levels: dict[int, Bits], size: int, least: int) -> DataFrame:
    """Hashes of the frequent phrases of ``size`` words; their counts may be too high, never too low."""
    shared = docs.sparkSession.sparkContext.broadcast((seeds, words, levels))

    def work(t: Tokens, langs: list[str]) -> Iterator[list[pa.Array]]:
        _, hashes = windows(t, *shared.value, size)
        kinds, n = np.unique(hashes, return_counts=True)
        yield [signed(kinds), pa.array(n)]

    counted = scan(docs, "h bigint, c bigint", work).groupBy("h").agg(F.sum("c").alias("c"))
    return stored(counted.where(F.col("c") >= least).select("h"), "phrases")


def read_grown(docs: DataFrame, seeds: Bits, words: Bits, levels: dict[int, Bits], least: int) -> DataFrame:
    """(lang, phrase, words, a, inner): the frequent phrases of all levels; ``inner`` if all have the same neighbour at a side."""
    shared = docs.sparkSession.sparkContext.broadcast((seeds, words, levels))

    def work(t: Tokens, langs: list[str]) -> Iterator[list[pa.Array]]:
        seeds, words, levels = shared.value
        zero = np.zeros(1, np.uint64)
        piece, h = np.concatenate([[-1], t.piece, [-1]]), np.concatenate([zero, t.hash, zero])
        for size in levels:
            at, hashes = windows(t, seeds, words, levels, size)
            kept = levels[size].has(hashes)
            at, hashes = at[kept], hashes[kept]
            if not len(at):
                continue
            order = np.argsort(hashes, kind="stable")
            at, hashes = at[order], hashes[order]
            heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            before = np.where(piece[at] == t.piece[at], h[at], np.uint64(0)).view(np.int64)
            after = np.where(piece[at + size + 1] == t.piece[at], h[at + size + 1], np.uint64(0)).view(np.int64)
            ends = [f.reduceat(x, heads) for x in (before, after) for f in (np.minimum, np.maximum)]
            first = at[heads].tolist()
            yield [
                pa.array([langs[r] for r in t.row[at[heads]].tolist()]), pa.array([t.phrase(k, size) for k in first]),
                pa.array(np.full(len(first), size, np.int32)), pa.array(np.diff(np.append(heads, len(at)))), *map(pa.array, ends),
            ]

    rows = scan(docs, "lang string, phrase string, words int, c bigint, b0 bigint, b1 bigint, a0 bigint, a1 bigint", work)
    summed = rows.groupBy("lang", "phrase", "words").agg(F.sum("c").alias("a"), F.min("b0").alias("b0"), F.max("b1").alias("b1"), F.min("a0").alias("a0"), F.max("a1").alias("a1"))
    inner = ((F.col("b0") == F.col("b1")) & (F.col("b0") != 0)) | ((F.col("a0") == F.col("a1")) & (F.col("a0") != 0))
    return summed.where(F.col("a") >= least).select("lang", "phrase", "words", "a", inner.alias("inner"))


def hashed(phrases: DataFrame) -> DataFrame:
    """(words, h) of phrases (lang, phrase)."""

    def work(t: Tokens, langs: list[str]) -> Iterator[list[pa.Array]]:
        size = np.bincount(t.row, minlength=len(langs))
        at = np.concatenate([[0], np.cumsum(size)[:-1]])
        hashes = t.hash[at] if len(t.hash) else np.zeros(0, np.uint64)
        for k in range(1, int(size.max(initial=0))):
            more = np.flatnonzero(size > k)
            hashes[more] = longer(hashes[more], t.hash[at[more] + k])
        yield [pa.array(size.astype(np.int32)), signed(hashes)]

    return scan(phrases.select("lang", "phrase"), "words int, h bigint", work)


def count_phrases(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, phrase, f) of given phrases of two words and more (lang, phrase), and of some others."""
    keys = stored(hashed(phrases), "second-parts")
    sizes = [r[0] for r in keys.select("words").distinct().collect()]
    wanted = {s: bits(keys.where(F.col("words") == s), "h") for s in sorted(sizes)}
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def work(t: Tokens, langs: list[str]) -> Iterator[list[pa.Array]]:
        wanted = shared.value
        at, hashes = np.arange(len(t.hash)), t.hash
        for k in range(1, max(wanted, default=1)):
            inside = at + k < len(t.hash)
            at, hashes = at[inside], hashes[inside]
            same = t.piece[at + k] == t.piece[at]
            at = at[same]
            hashes = longer(hashes[same], t.hash[at + k])
            if k + 1 in wanted and len(at):
                kept = np.flatnonzero(wanted[k + 1].has(hashes))
                _, first, n = np.unique(hashes[kept], return_index=True, return_counts=True)
                places = at[kept[first]].tolist()
                yield [pa.array([langs[r] for r in t.row[places].tolist()], pa.string()), pa.array([t.phrase(p, k + 1) for p in places], pa.string()), pa.array(n)]

    return scan(docs, "lang string, phrase string, c bigint", work).groupBy("lang", "phrase").agg(F.sum("c").alias("f"))


def expand(docs: DataFrame, seeds: DataFrame, words: DataFrame, totals: DataFrame, longest: int, least: int) -> DataFrame:
    """Scored survivors (lang, phrase, a, l, r, n, score) among the phrases that begin with a seed (lang, word, h, f)."""
    empty = docs.sparkSession.createDataFrame([], "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    first, every = bits(seeds, "h"), bits(words, "h")
    if first is None:
        return empty
    levels: dict[int, Bits] = {}
    for size in range(2, longest + 1):
        table = bits(count_grown(docs, first, every, levels, size, least), "h")
        if table is None:
            break
        levels[size] = table
    if not levels:
        return empty
    heads = seeds.select("lang", F.col("word").alias("__head"))
    grown = read_grown(docs, first, every, levels, least).withColumn("__head", F.substring_index("phrase", " ", 1))
    grown = stored(grown.join(heads, ["lang", "__head"], "left_semi").drop("__head"), "grown")
    kept = grown.where(~F.col("inner") | (F.col("words") == longest)).withColumn("__w", F.split("phrase", " ", -1))
    cuts = kept.select("lang", "phrase", "a", "__w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("__w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("__w", F.col("k") + 1, F.size("__w")), " ").alias("right"),
    )
    cuts = stored(cuts, "cuts")
    single = words.select("lang", F.col("word").alias("part"), F.col("f"))
    needed = cuts.where(F.instr("right", " ") > 0).select("lang", F.col("right").alias("phrase")).distinct()
    parts = single.union(count_phrases(docs, needed).select("lang", "phrase", "f"))
    lefts = single.union(grown.select("lang", "phrase", "a")).select("lang", F.col("part").alias("left"), F.col("f").alias("l"))
    joined = cuts.join(lefts, ["lang", "left"]).join(parts.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # 1000 * a * n and l * r can pass 64 bits; a decimal holds 38 digits and divides without rounding.
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    scored = joined.join(totals, "lang").withColumns(
        {"__up": (wide("a") * wide("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"), "__down": wide("l") * wide("r")}
    )
    scored = scored.withColumn("score", F.expr("cast(__up div __down as bigint)"))
    worst = F.min(F.struct("score", "k", "l", "r")).alias("__c")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(worst)
    return stored(best.select("lang", "phrase", "a", "__c.l", "__c.r", "n", "__c.score"), "scored")


def leading(scored: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top`` rows with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


def collocations(df: DataFrame, lang: str = "lang", text: str = "text", top: int = 2000, least: int = 100, longest: int = 5) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best ``top`` phrases."""
    docs = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    counted = scan(docs, "lang string, word string, h bigint, c bigint", count_words)
    counted = stored(counted.groupBy("lang", "word").agg(F.min("h").alias("h"), F.sum("c").alias("f")), "words")
    totals = stored(counted.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = waves(counted.where(F.col("f") >= least), totals)
    # The best score that a first word of a later wave allows.
    limits = words.where("wave > 0").groupBy("lang").agg(F.min("f").alias("__f")).join(totals, "lang")
    limits = stored(limits.select("lang", F.expr("cast(cast(n as decimal(18,0)) * 1000 div __f as bigint)").alias("bound")), "limits")
    found = expand(docs, words.where("wave = 0"), words, totals, longest, least)
    last = leading(found, top).where(F.col("rank") == top).select("lang", F.col("score").alias("__last"))
    open_ = limits.join(last, "lang", "left").where("__last is null or __last <= bound").select("lang")
    open_ = stored(open_, "unsettled")
    if open_.limit(1).count():
        rest = words.where("wave > 0").join(open_, "lang", "left_semi")
        found = found.union(expand(docs.join(open_, "lang", "left_semi"), rest, words, totals, longest, least))
    return leading(found, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def waves(words: DataFrame, totals: DataFrame) -> DataFrame:
    """``words`` with ``wave``: 0 for the rarest that make up a share of the language's words, 1 for the others."""
    step = F.floor(F.log2("f") * 8)
    mass = words.groupBy("lang", step.alias("step")).agg(F.sum("f").alias("mass")).join(totals, "lang")
    # At most some hundred steps a language.
    order = Window.partitionBy("lang").orderBy("step")
    sums = mass.withColumns({"__sum": F.sum("mass").over(order), "__place": F.row_number().over(order)})
    early = sums.where(f"__sum * {SHARE} <= n or __place = 1").groupBy("lang").agg(F.max("step").alias("__step"))
    return stored(
        words.join(early, "lang").select("lang", "word", "h", "f", F.when(step <= F.col("__step"), 0).otherwise(1).alias("wave")), "word-waves"
    )
