"""URL filter: rules first, then a character language-model ratio, in DataFrame operations only.

``judge(df, rules)`` adds host, path, the rule that fits, a score and a verdict.
A URL that no rule fits is judged by two smoothed variable-order Markov models
over its characters, one of accepted and one of rejected URLs: those that an
allow or a block rule fits. Its score is the log-likelihood difference per
symbol; it is allowed if the score reaches a threshold that is calibrated on
ruled URLs kept from training (one in five), where the share of accepted URLs
below it is nearest to the share of rejected ones above it.

A symbol is one of 32: letters in lower case, digits as one, ``/ . -``, any other
character, and the edge of the URL. The URL is read from behind its scheme, with
edges around it. Each model's probability of a symbol behind the two before it
is interpolated with those behind one and none and the uniform one (Witten-Bell:
an order weighs as its observations against its distinct symbols).

Scale: counts of triples are summed map-side, so a hot host costs nothing. The
model is one array of 32**3 numbers whatever the corpus, which the driver turns into a
literal, so scoring adds no join and no shuffle. The calibration sees at most 1,601 bins.

Defined cases: a null URL or one without ``://`` has empty host and path, is read
whole (null: as empty) and judged by the models. Without URLs of both kinds all
scores are 0 and the threshold is 0, so the verdict is allow. Repeated rows count
as often as they occur. Input columns named like a result are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbmart.llm.common import stored, without

ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-_^"
SIZE = len(ALPHABET)
EDGE = SIZE - 1
#: One labelled URL in so many calibrates the threshold instead of training the models.
CALIBRATION = 5
#: Scores are put into bins of 1/BINS for the calibration, from -LIMIT to LIMIT.
BINS, LIMIT = 100, 8
RESULTS = ("host", "path", "rule", "score", "verdict")

Rule = tuple[str, str, str]  # (verdict, host, path)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def triples(url: Column) -> Column:
    """The numbers of all runs of three symbols of a URL between its edges."""
    text = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://", ""))
    plain = F.translate(F.regexp_replace(text, r"[^a-z0-9/.\-]", "_"), "123456789", "0" * 9)
    padded = F.concat(F.lit("^^"), plain, F.lit("^"))
    at = lambda i: F.instr(F.lit(ALPHABET), F.substring(padded, i, F.lit(1))) - 1
    return F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: (at(i) * SIZE + at(i + 1)) * SIZE + at(i + 2))


def smoothed(counts: DataFrame) -> DataFrame:
    """The log-likelihood difference of every triple: (gram, ratio), dense.

    ``counts`` has (gram, good, bad). Rows of the tables here are at most SIZE**3.
    """
    spark = counts.sparkSession
    lower = spark.range(1).select(F.lit(0).cast("long").alias("gram"), F.lit(1.0 / SIZE).alias("p_good"), F.lit(1.0 / SIZE).alias("p_bad"))
    for order in range(3):
        size = SIZE ** (order + 1)
        grams = counts.groupBy((F.col("gram") % size).alias("gram")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        stats = [F.sum(c).alias(f"n_{c}") for c in ("good", "bad")] + [F.sum((F.col(c) > 0).cast("long")).alias(f"t_{c}") for c in ("good", "bad")]
        contexts = grams.groupBy(F.floor(F.col("gram") / SIZE).alias("context")).agg(*stats)
        dense = spark.range(size).select(F.col("id").alias("gram"), F.floor(F.col("id") / SIZE).alias("context"), (F.col("id") % (size // SIZE)).alias("shorter"))
        joined = dense.join(grams, "gram", "left").join(contexts, "context", "left")
        joined = joined.join(lower.withColumnRenamed("gram", "shorter"), "shorter")
        p = {}
        for c in ("good", "bad"):
            n, t = F.coalesce(F.col(f"n_{c}"), F.lit(0)), F.coalesce(F.col(f"t_{c}"), F.lit(0))
            own = (F.coalesce(F.col(c), F.lit(0)) + t * F.col(f"p_{c}")) / (n + t)
            p[c] = F.when(n > 0, own).otherwise(F.col(f"p_{c}")).alias(f"p_{c}")
        lower = stored(joined.select("gram", p["good"], p["bad"]), f"order{order}")
    return lower.select("gram", (F.log("p_good") - F.log("p_bad")).alias("ratio"))


def train(df: DataFrame, kind: Column, url: str) -> list[float]:
    """The differences of all SIZE**3 triples, from URLs of kind allow and block."""
    each = df.where(kind.isNotNull()).select(F.explode(triples(F.col(url))).alias("gram"), kind.alias("kind"))
    counts = each.groupBy("gram").agg(F.count_if(F.col("kind") == "allow").alias("good"), F.count_if(F.col("kind") == "block").alias("bad"))
    counts = stored(counts, "triples")
    rows = smoothed(counts).orderBy("gram").collect()
    seen = counts.agg(F.sum("good"), F.sum("bad")).first()
    # With one kind only there is nothing to compare.
    return [r.ratio if seen[0] and seen[1] else 0.0 for r in rows]


def score(url: Column, ratios: list[float]) -> Column:
    """The mean difference over the symbols of a URL and its end."""
    # Folded into one literal by the optimizer.
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    grams = triples(url)
    total = F.aggregate(grams, F.lit(0.0), lambda sum_, g: sum_ + F.element_at(table, (g + 1).cast("int")))
    return total / F.size(grams)


def threshold(scored: DataFrame, kind: Column) -> float:
    """The score at which the two kinds of error are nearest to each other."""
    bin_ = F.floor(F.greatest(F.least(F.col("score"), F.lit(float(LIMIT))), F.lit(-float(LIMIT))) * BINS)
    bins = scored.where(kind.isNotNull()).groupBy(bin_.alias("bin")).agg(F.count_if(kind == "allow").alias("good"), F.count_if(kind == "block").alias("bad"))
    bins = stored(bins, "bins")
    up, down = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("bin").rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = lambda part, c: F.coalesce(F.sum(c).over(part), F.lit(0)) / F.sum(c).over(every)
    errors = bins.select("bin", F.abs(F.try_subtract(share(up, "good"), share(down, "bad"))).alias("gap"), F.sum("good").over(every).alias("g"), F.sum("bad").over(every).alias("b"))
    best = errors.where("g > 0 and b > 0").agg(F.min(F.struct("gap", "bin")).alias("best"))
    found = best.first().best
    return found.bin / BINS if found else 0.0


def judge(df: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """``df`` with host, path, rule, score and verdict."""
    kept = without(df, *RESULTS)
    link = F.col(f"`{url}`").cast("string")
    parsed = kept.withColumns({"host": host_of(link), "path": path_of(link)})
    ruled = parsed.withColumn("__fit", fitting(rules, F.col("host"), F.col("path"))).withColumn("__url", link)
    digest = F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary"))
    kind, part = F.col("__fit.verdict"), F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % CALIBRATION
    model = train(ruled.where(part != 0).select("__fit", "__url"), kind, "__url")
    held = ruled.where(part == 0).select("__fit", score(F.col("__url"), model).alias("score"))
    limit = threshold(held, kind)
    scored = ruled.withColumn("score", score(F.col("__url"), model))
    own = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return scored.select(*kept.columns, "host", "path", F.col("__fit.rule").alias("rule"), "score", F.coalesce(kind, own).alias("verdict"))
