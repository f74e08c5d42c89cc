"""Quality classifier: a sparse ensemble of rules over text statistics.

``statistics(df)`` adds fifteen statistics of every whole text. ``train`` fits
shallow boosted trees on labelled rows, takes the path to every node of them as a
conjunctive rule, fits a logistic model with a lasso penalty over the rules, and
keeps the rules with a weight. ``score`` compiles those into one Spark column
expression, so applying the model is ordinary Catalyst work.

The classifier may be fitted on a sample: at most ``TRAIN_ROWS`` labelled rows,
those with the smallest hash of their id (all of them below that). Statistics
and scores are those of all rows and whole texts.

Scale: statistics are one pass of array work in Arrow batches without a shuffle;
only numbers (no text) are joined with the labels. What reaches the driver is
the bounded sample of statistics; what goes back is an expression of bounded size.

Defined cases: a null text counts as empty; empty texts have statistics of zero
and get a score like any other. Conflicting labels of one id count by majority,
and not at all on a tie; null labels do not count. Without labels of both kinds
every score is the smoothed share of the one kind seen (0.5 with none). Input
columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from plumbmart.llm.common import by_value
from plumbmart.llm.words import CHUNK, LOWER, SPACE, bytes_of, row_sums, with_columns, word_hashes

by_value(__name__)

TRAIN_ROWS = 20_000
STATISTICS = (
    "__st_words", "__st_word_length", "__st_upper", "__st_digit", "__st_mark", "__st_stop", "__st_other", "__st_repeat",
    "__st_distinct", "__st_lines", "__st_line_words", "__st_marked_words", "__st_bare_marks", "__st_shouts", "__st_top_word",
)

UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".,;:?'\"-()"]] = True
MARK = ~(LETTER | DIGIT | STOP | SPACE)
MARK[:32] = False


def byte_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row: upper-case letters, letters, digits, marks, stops, bytes above ASCII, line ends, words that end in a mark, marks alone, words without lower case."""
    out = np.zeros((len(offsets) - 1, 11))
    for lo in range(0, len(data), CHUNK):
        hi = min(len(data), lo + CHUNK)
        b = data[lo:hi]
        before = np.empty(len(b), np.uint8)
        before[1:], before[0] = b[:-1], data[lo - 1] if lo else 32
        after = np.empty(len(b), np.uint8)
        after[:-1], after[-1] = b[1:], data[hi] if hi < len(data) else 32
        starts = offsets[(offsets >= lo) & (offsets < hi)] - lo
        before[starts] = 32
        ends = offsets[(offsets > lo) & (offsets <= hi)] - lo - 1
        after[ends] = 32
        solid = ~SPACE[b]
        first, last = solid & SPACE[before], solid & SPACE[after]
        mark = MARK[b]
        columns = (UPPER[b], LETTER[b], DIGIT[b], mark, STOP[b], b >= 128, b == 10, last & mark, first & last & mark, last & (b == 33), first)
        inner = np.clip(offsets, lo, hi) - lo
        for k, c in enumerate(columns):
            out[:, k] += row_sums(c, inner)
    return out


def features(column: pa.Array) -> np.ndarray:
    """The statistics of each text, in the order of STATISTICS."""
    data, offsets = bytes_of(column)
    rows = len(offsets) - 1
    upper, letters, digits, marks, stops, other, lines, marked, bare, shouts, _ = byte_features(data, offsets).T
    size = np.maximum(np.diff(offsets), 1)
    hashes, row = word_hashes(data, offsets)
    words = np.bincount(row, minlength=rows).astype(float)
    lengths = size - row_sums(SPACE[data], offsets)
    same = np.zeros(len(row), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    repeats = np.bincount(row[same], minlength=rows)
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    new = np.ones(len(r), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    distinct = np.bincount(r[new], minlength=rows)
    heads = np.flatnonzero(new)
    top = np.zeros(rows)
    np.maximum.at(top, r[heads], np.diff(np.append(heads, len(r))))
    n = np.maximum(words, 1)
    # Distinct words grow more slowly than words do: compare with words ** 0.8.
    return np.column_stack([
        np.log1p(words), np.where(words > 0, lengths / n, 0), upper / np.maximum(letters, 1), digits / size, marks / size, stops / size,
        other / size, repeats / n, distinct / n**0.8, np.log1p(lines), n / (lines + 1) * (words > 0), marked / n, bare / n, shouts / n, top / n,
    ])


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the statistics of its texts."""

    def start():
        return lambda column: [pa.array(c) for c in features(column).T]

    return with_columns(df, text, [StructField(s, DoubleType()) for s in STATISTICS], start)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, whether above, threshold), all of which must hold


@dataclass
class Model:
    rules: list[Rule]
    weights: list[float]
    intercept: float


def grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, rows: np.ndarray, depth: int, path: Rule, rules: list[Rule], update: np.ndarray, leaf: int) -> None:
    """One regression tree over binned statistics; records the rule of every node."""
    best = (1e-9, -1, 0)
    total, n = residual[rows].sum(), len(rows)
    if depth and n >= 2 * leaf:
        for f in range(x.shape[1]):
            if not len(cuts[f]):
                continue
            count = np.cumsum(np.bincount(bins[rows, f], minlength=len(cuts[f]) + 1))[:-1]
            left = np.cumsum(np.bincount(bins[rows, f], residual[rows], len(cuts[f]) + 1))[:-1]
            ok = (count >= leaf) & (n - count >= leaf)
            gain = np.where(ok, left**2 / np.maximum(count, 1) + (total - left) ** 2 / np.maximum(n - count, 1) - total**2 / n, 0)
            if gain.max() > best[0]:
                best = (gain.max(), f, int(gain.argmax()))
    _, f, k = best
    if f < 0:
        update[rows] = total / max(n, 1)
        return
    below = bins[rows, f] <= k
    for above, part in ((False, rows[below]), (True, rows[~below])):
        rule = (*path, (f, above, float(cuts[f][k])))
        rules.append(rule)
        grow(x, bins, cuts, residual, part, depth - 1, rule, rules, update, leaf)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, cut in rule:
        out &= (x[:, f] > cut) if above else (x[:, f] <= cut)
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.002, steps: int = 400) -> Model:
    """Rules from boosted trees, weighted by a logistic lasso (accelerated proximal gradient)."""
    prior = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(prior / (1 - prior)))
    if not len(y) or y.min() == y.max():
        return Model([], [], base)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1], method="lower")) for f in range(x.shape[1])]
    cuts = [c[c < x[:, f].max()] for f, c in enumerate(cuts)]
    bins = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    rng = np.random.default_rng(7)
    rules: list[Rule] = []
    margin = np.full(len(y), base)
    for _ in range(trees):
        # Each tree sees a random half, which makes the rules differ.
        rows = np.flatnonzero(rng.random(len(y)) < 0.5) if len(y) > 40 else np.arange(len(y))
        update = np.zeros(len(y))
        own: list[Rule] = []
        grow(x, bins, cuts, y - 1 / (1 + np.exp(-margin)), rows, depth, (), own, update, max(2, len(y) // 500))
        margin += update
        rules += own
    rules = list(dict.fromkeys(rules))
    z = np.column_stack([holds(r, x) for r in rules]).astype(np.float32) if rules else np.zeros((len(y), 0), np.float32)
    spread = z.std(0)
    z, rules, spread = z[:, spread > 1e-3], [r for r, s in zip(rules, spread, strict=True) if s > 1e-3], spread[spread > 1e-3]
    mean = z.mean(0)
    z = (z - mean) / spread
    w = np.zeros(z.shape[1])
    look, speed, b = w, 1.0, base
    step = 4 / max(np.linalg.norm(z.T @ z / len(y), 2), 1e-9) if len(w) else 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ look + b))) - y
        b -= error.mean()
        moved = look - step * (z.T @ error) / len(y)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        look, w, speed = new + (speed - 1) / faster * (new - w), new, faster
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return Model([rules[k] for k in kept], [float(w[k] / spread[k]) for k in kept], float(b - (w * mean / spread)[kept].sum()))


def labelled(stats: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Statistics with the majority label of their id as ``y``; ties have none."""
    votes = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__id")).agg(F.avg(F.col(label).cast("double")).alias("__share"))
    votes = votes.where("__share <> 0.5").select("__id", (F.col("__share") > 0.5).cast("double").alias("y"))
    return stats.join(votes, F.col(f"`{key}`") == F.col("__id")).drop("__id")


def train(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """The model of at most ``rows`` labelled rows, those with the smallest hash of their id."""
    sample = labelled(stats, labels, key, label).select(*STATISTICS, "y", F.xxhash64(key).alias("h"), key)
    got = sample.orderBy("h", key, *STATISTICS).limit(rows).toPandas()
    return fit(got[list(STATISTICS)].to_numpy(float), got["y"].to_numpy(float))


def score(stats: DataFrame, model: Model, score: str = "score") -> DataFrame:
    """``stats`` with the model as one column: the sigmoid of the weights of the rules that hold."""

    def condition(rule: Rule) -> Column:
        out = F.lit(True)
        for f, above, cut in rule:
            out &= (F.col(STATISTICS[f]) > cut) if above else (F.col(STATISTICS[f]) <= cut)
        return out

    margin = F.lit(model.intercept)
    for rule, weight in zip(model.rules, model.weights, strict=True):
        margin += F.when(condition(rule), weight).otherwise(0.0)
    return stats.withColumn(score, 1 / (1 + F.exp(-margin)))
