"""Language identification by prediction by partial matching (PPM).

``train(df)`` counts, for every language, how often each symbol follows each
context of up to two symbols, over all training documents. ``predict(df, model)``
codes every whole text with every language's frozen statistics; the shortest
exact code wins, and ``score`` is the probability that the code lengths give the
winner among the learned languages.

A symbol is a byte of the UTF-8 text: letters A-Z are lower-cased, the other
ASCII characters are one of two classes (digit, anything else), and the 128
bytes of other scripts stand for themselves. The tree has depth two. A symbol
seen n times in a context with N observations of d distinct symbols has
probability n / (N + d); an unseen one costs the escape d / (N + d) and is coded
in the next shorter context without the symbols that the longer one has (full
exclusion), and at last uniformly over the symbols left. A text begins behind
two blanks.

Scale: counting is one pass with map-side sums in dense arrays; what is shuffled
is bounded by symbols**3 a task and language. As statistics are frozen, all code
lengths fit one table of at most symbols**3 numbers a language (only contexts
that occur have a row), which is broadcast. Scoring is one pass of array look-ups
without a shuffle. Long texts are coded in pieces that keep their context.

Defined cases: null text or text without a letter gives ``und`` and score 0; so
does everything when there is nothing to learn from. Training skips rows with a
null text or language. Equal code lengths go to the smallest language value.
Repeated rows count as often as they occur. An input column named like a result
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from plumbmart.llm.common import by_value
from plumbmart.llm.words import CHUNK, bytes_of, row_sums, with_columns

by_value(__name__)

UNKNOWN = "und"
BLANK, DIGIT = 0, 1
#: The symbol of each byte: blank, digit, 26 letters, 128 other bytes.
SYMBOL = np.zeros(256, np.int64)
SYMBOL[48:58] = DIGIT
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(2, 28)
SYMBOL[128:] = np.arange(28, 156)
SYMBOLS = 156


@dataclass
class Model:
    """``cost[row_of[a * SYMBOLS + b], s]`` has, for each language, the bits of s behind a, b."""

    langs: list[str]
    row_of: np.ndarray
    cost: np.ndarray


def contexts(symbols: np.ndarray, offsets: np.ndarray, before: tuple[int, int] = (BLANK, BLANK)) -> np.ndarray:
    """The number of the two symbols before each place; rows begin behind blanks, the first behind ``before``."""
    one, two = np.empty_like(symbols), np.empty_like(symbols)
    one[1:], two[2:] = symbols[:-1], symbols[:-2]
    one[:1], two[:1], two[1:2] = before[1], before[0], before[1]
    starts = offsets[(offsets > 0) & (offsets < len(symbols))]
    one[starts] = two[starts] = BLANK
    second = starts + 1
    two[second[second < len(symbols)]] = BLANK
    return two * SYMBOLS + one


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of the bytes as (symbols, contexts, places where a row begins in the part)."""
    for lo in range(0, len(data), size):
        hi = min(len(data), lo + size)
        back = max(0, lo - 2)
        symbols = SYMBOL[data[back:hi]]
        inner = offsets[(offsets >= back) & (offsets < hi)] - back
        yield symbols[lo - back :], contexts(symbols, inner)[lo - back :], np.clip(offsets, lo, hi) - lo


def counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """How often each symbol follows each two symbols in each language: (lang, gram, n)."""
    source = df.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, n in held.items():
                grams = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(n[grams])], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            column = batch.column(0)
            for name in column.unique().to_pylist():
                if len(held) >= 8 and name not in held:
                    yield from flush()
                data, offsets = bytes_of(batch.column(1).filter(pa.compute.equal(column, name)))
                total = held.setdefault(name, np.zeros(SYMBOLS**3, np.int64))
                for symbols, context, _ in pieces(data, offsets):
                    grams, n = np.unique(context * SYMBOLS + symbols, return_counts=True) if len(symbols) < 50_000 else (slice(None), np.bincount(context * SYMBOLS + symbols, minlength=SYMBOLS**3))
                    total[grams] += n
        yield from flush()

    return source.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def code_lengths(n: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Bits of every symbol in every given context, for one language's counts (symbol cubed)."""
    cube = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    levels = [cube.reshape(-1, SYMBOLS)[context], cube.sum(axis=0)[context % SYMBOLS], cube.sum(axis=(0, 1))[None, :]]
    bits = np.zeros((len(context), SYMBOLS))
    open_ = np.ones((len(context), SYMBOLS), bool)  # symbols not coded yet, which the next level can code
    for level in levels:
        here = np.where(open_, level, 0)
        total, kinds = here.sum(1, keepdims=True), (here > 0).sum(1, keepdims=True)
        seen = here > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            bits += np.where(open_ & seen, np.log2((total + kinds) / np.maximum(here, 1)), 0)
            bits += np.where(open_ & ~seen & (kinds > 0), np.log2((total + kinds) / np.maximum(kinds, 1)), 0)
        open_ &= ~seen
    return bits + np.where(open_, np.log2(np.maximum(open_.sum(1, keepdims=True), 1)), 0)


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows with text and language. The driver gets counts of symbols only."""
    rows = counts(df, text, lang).toPandas()
    langs = sorted(rows["lang"].unique())
    # A context that no language has seen is coded as its last symbol behind a
    # first one that never occurs, whose counts are all zero.
    seen = np.unique(rows["gram"].to_numpy(np.int64) // SYMBOLS)
    row_of = np.arange(SYMBOLS**2) % SYMBOLS
    row_of[seen] = SYMBOLS + np.arange(len(seen))
    cost = np.zeros((SYMBOLS + len(seen), SYMBOLS, len(langs)), np.float32)
    for k, name in enumerate(langs):
        own = rows[rows["lang"] == name]
        n = np.zeros(SYMBOLS**3, np.int64)
        n[own["gram"].to_numpy(np.int64)] = own["n"]
        cost[SYMBOLS:, :, k] = code_lengths(n, seen)
        unseen = np.zeros((SYMBOLS, SYMBOLS, SYMBOLS), np.int64)
        unseen[1] = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS).sum(axis=0)
        cost[:SYMBOLS, :, k] = code_lengths(unseen.ravel(), np.arange(SYMBOLS))
    return Model(langs, row_of.astype(np.int32), cost)


def text_bits(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The exact code length of every row's bytes in every language."""
    flat = model.cost.reshape(-1, len(model.langs))
    total = np.zeros((len(offsets) - 1, len(model.langs)))
    for symbols, context, inner in pieces(data, offsets):
        total += row_sums(flat[model.row_of[context].astype(np.int64) * SYMBOLS + symbols], inner)
    return total


def predict(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language and a score from 0 to 1."""
    if not model.langs:
        kept = [c for c in df.columns if c.lower() not in (lang.lower(), score.lower())]
        return df.select(*(f"`{c}`" for c in kept), F.lit(UNKNOWN).alias(lang), F.lit(0.0).alias(score))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        names = np.array(model.langs, object)

        def compute(column: pa.Array) -> list[pa.Array]:
            bits = text_bits(model, *bytes_of(column))
            best = bits.argmin(1)
            share = 1 / np.exp2(np.clip(bits.min(1, keepdims=True) - bits, -1000, 0)).sum(1)
            return [pa.array(names[best], pa.string()), pa.array(share)]

        return compute

    done = with_columns(df, text, [StructField(lang, StringType()), StructField(score, DoubleType())], start)
    known = F.coalesce(F.col(f"`{text}`").cast("string").rlike(r"\p{L}"), F.lit(False))
    return done.withColumns({lang: F.when(known, F.col(lang)).otherwise(UNKNOWN), score: F.when(known, F.col(score)).otherwise(0.0)})
