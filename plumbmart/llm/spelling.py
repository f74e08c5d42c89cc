"""Spelling variants: words one edit apart, found by a trie frontier of joins.

``words(df)`` counts the words of texts, ``near_pairs(words)`` finds the pairs one
edit apart, and ``forms(words)`` points each word to its frequent variant.

The method. The words are a trie, kept as a table of edges (node, label, child): a
node is the hash of a prefix, and chains without branches are one edge whose label
is the chain. A state is (word, position, node, edits). Each round joins the states
with the edges of their nodes: an edge that goes on as the word does leaves the
edits as they are, one that first differs is taken with that code point replaced,
inserted or deleted, if no edit was made before. A state that has used its edit and
its word at the end of another word is a neighbour. Rounds go on until no state is
left, at most as many as a path has branching nodes.

A trie is wide near its root, where every word would try every child. One edit
leaves one half of a word as it was, so words go into two tries, as they are and
reversed, and start at the node of their first half, whose branches are few; only
that half of the edge table is built. Pairs that both find count for the first.

Each neighbour is found once: the edit stands where the two words first differ,
and the path to a word is one. Hashes that collide can only make false paths,
which the distance of the two words themselves refutes.

Scale: distinct words are counted with a map-side combine, and all else grows with
the number of distinct words. A node has no more edges than there are letters, so
states a word are bounded by its length; a node that many words share is a join key
whose states Spark may split. Every round is a stored table. ``follow`` needs as
many rounds as the logarithm of the longest chain of forms.

A null text has no words; a null id counts as an empty one. Repeated rows count
each time. A word may be as long as a text. Ties between forms go to the smallest
in code-point order. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbmart.llm.common import stored

#: Letters of a run after A-Z are lower-cased.
RUN = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(df: DataFrame, key: str = "doc_id", text: str = "text", slip: int | None = 97, least_length: int = 5, least: int = 3) -> DataFrame:
    """(word, n): the runs of letters, lower-cased, with their number of occurrences.

    Where ``slip`` divides the crc32 of ``<key>:<run>``, the run loses the code
    point at that number modulo its length.
    """
    low = F.translate(F.col(f"`{text}`").cast("string"), UPPER, LOWER)
    runs = df.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("w"))
    if slip:
        runs = runs.withColumn("h", F.crc32(F.concat("k", F.lit(":"), "w").cast("binary")))
        at = "cast(h % length(w) as int)"
        lost = F.expr(f"concat(substring(w, 1, {at}), substring(w, {at} + 2))")
        runs = runs.withColumn("w", F.when(F.col("h") % slip == 0, lost).otherwise(F.col("w")))
    counted = runs.where(F.length("w") >= least_length).groupBy(F.col("w").alias("word")).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least)


def node(prefix: Column) -> Column:
    return F.xxhash64("rev", prefix)


def base(length: Column) -> Column:
    """Where a word of this length starts: behind its first half, rounded down; reversed, up."""
    return F.floor((length + F.col("rev")) / 2).cast("int")


def both_ways(words: DataFrame) -> DataFrame:
    """(key, rev, size, n): every word as it is and reversed."""
    ways = F.array(F.struct(F.col("word").alias("key"), F.lit(0).alias("rev")), F.struct(F.reverse("word").alias("key"), F.lit(1).alias("rev")))
    return words.select(F.explode(ways).alias("w"), "n").select("w.key", "w.rev", F.length("w.key").alias("size"), "n")


def trie(keys: DataFrame) -> DataFrame:
    """Edges (node, first, label, child, near, near_n, firsts) of the second halves.

    ``near`` is the word that ends at the child, ``first`` and ``firsts`` the code
    points that the label and the child's edges begin with.
    """
    first = base(F.col("size") - 1)
    prefixes = keys.withColumn("d", F.explode(F.sequence(first, F.col("size")))).select(
        "key", "rev", "size", "n", "d", node(F.substring(F.col("key"), F.lit(1), F.col("d"))).alias("node"),
        F.substring(F.col("key"), F.col("d") + 1, F.lit(1)).alias("next"), (F.col("d") <= base(F.col("size") + 1)).alias("start"),
    )
    kept = prefixes.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b"), F.max("start").alias("s")).where("a <> b or s or a = ''")
    placed = prefixes.select("key", "rev", "size", "n", "d", "node").join(kept.select("node"), "node", "left_semi")
    paths = placed.groupBy("key", "rev", "size", "n").agg(F.sort_array(F.collect_list(F.struct("d", "node"))).alias("p"))
    steps = paths.select("key", "size", "n", "p", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k")).select(
        F.expr("p[k - 1].node").alias("node"), F.expr("substring(key, p[k - 1].d + 1, p[k].d - p[k - 1].d)").alias("label"), F.expr("p[k].node").alias("child"),
        F.expr("if(k = size(p) - 1, key, null)").alias("near"), F.expr("if(k = size(p) - 1, n, null)").alias("near_n"),
    )
    edges = stored(steps.groupBy("node", "label", "child").agg(F.max("near").alias("near"), F.max("near_n").alias("near_n")), "steps")
    edges = edges.withColumn("first", F.left("label", F.lit(1)))
    # No more than there are letters.
    beyond = edges.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_set("first"), "").alias("firsts"))
    return edges.join(beyond, "child", "left")


#: Length of the common beginning of the rest of the word and the label; no word has a space.
COMMON = r"""case when startswith(rest, label) then length(label) when left(rest, 1) <> first then 0
  else length(regexp_extract(concat(rest, ' ', label), '^([^ ]*)[^ ]*+ \\1', 1)) end"""
#: Ways to take an edge: as the word goes on, or with its code point ``p`` replaced, inserted or deleted.
WAYS = ("as it is", "replaced", "inserted", "deleted")
FITS = """case way when 0 then p = length(label)
  when 1 then p < length(label) and length(rest) > p and startswith(substring(rest, p + 2), substring(label, p + 2))
  when 2 then p < length(label) and startswith(substring(rest, p + 1), substring(label, p + 2))
  else p < length(label) and length(rest) > p and startswith(substring(rest, p + 2), substring(label, p + 1)) end"""
USED = "length(label) + case way when 2 then -1 when 3 then 1 else 0 end"


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of words, both ways, that differ by exactly one edit. ``words`` is read several times."""
    keys = both_ways(words)
    edges = stored(trie(keys), "edges")
    at = base(F.col("size"))
    states = keys.select("key", "rev", at.alias("position"), node(F.substring(F.col("key"), F.lit(1), at)).alias("node"), F.lit(0).alias("edits"))
    rest = F.expr("substring(key, position + 1)").alias("rest")
    found: DataFrame | None = None
    while True:
        # One edit left: every edge of the node. None left: the edge that goes on as the word does.
        free = states.where("edits = 0").select("key", "rev", "position", "node", rest).join(edges, "node").withColumn("p", F.expr(COMMON))
        free = free.withColumn("way", F.explode(F.array(*map(F.lit, range(len(WAYS)))))).where(F.expr(FITS))
        free = free.withColumns({"position": F.col("position") + F.expr(USED), "edits": F.when(F.col("way") == 0, 0).otherwise(1)})
        bound = states.where("edits = 1").select("key", "rev", "position", "node", rest, F.expr("substring(key, position + 1, 1)").alias("first"))
        bound = bound.join(edges, ["node", "first"]).where("startswith(rest, label)")
        bound = bound.withColumns({"position": F.col("position") + F.length("label"), "edits": F.lit(1)})
        columns = ["key", "rev", "position", "child", "edits", "near", "near_n", "firsts"]
        moved = free.select(*columns).union(bound.select(*columns))
        left = F.length("key") - F.col("position")
        hit = F.col("near").isNotNull() & (left == 1 - F.col("edits"))
        # What has no edit left needs an edge that begins with its next code point.
        more = F.col("firsts").isNotNull() & ((F.col("edits") == 0) | ((left > 0) & F.expr("instr(firsts, substring(key, position + 1, 1)) > 0")))
        new = moved.select("key", "rev", "position", F.col("child").alias("node"), "edits", F.when(hit, F.col("near")).alias("near"), F.when(hit, F.col("near_n")).alias("near_n"), more.alias("more"))
        new = stored(new.where("near is not null or more"), "frontier")
        hits = new.where("near is not null").select("key", "rev", "near", "near_n")
        found = hits if found is None else found.union(hits)
        states = new.where("more").select("key", "rev", "position", "node", "edits")
        if not states.limit(1).count():
            break
    half = F.floor(F.length("word") / 2).cast("int")
    pairs = found.select(
        *(F.when(F.col("rev") == 1, F.reverse(c)).otherwise(F.col(c)).alias(name) for c, name in (("key", "word"), ("near", "near"))), "near_n", "rev"
    )
    # Reversed words find what differs in the first half; what is also found as it is counts there.
    once = (F.col("rev") == 0) | (F.left("word", half) != F.left("near", half))
    return pairs.where(once & (F.levenshtein("word", "near") == 1)).select("word", "near", "near_n")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain word, form, form's form ... ends. ``forms`` has (word, form) where there is a form."""
    state = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_ = state.select(F.col("word").alias("root"), F.col("root").alias("jump"))
        new = stored(state.join(next_, "root", "left").select("word", F.coalesce("jump", "root").alias("root"), F.col("jump").isNotNull().alias("moved")), "roots")
        state = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return state


def forms(words: DataFrame, factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of all ``words`` (word, n).

    The form is the near word of largest n, if that is ``factor`` times the word's.
    """
    words = stored(words.select("word", "n"), "words")
    shortest = words.agg(F.min(F.length("word"))).first()[0]
    if shortest is not None and shortest < 3:
        raise ValueError("words need three letters")
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("b"))
    joined = words.join(best, "word", "left")
    enough = -F.col("b.m") >= factor * F.col("n")
    done = stored(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("b.w")).alias("form"), F.when(enough, -F.col("b.m")).alias("form_n")),
        "forms",
    )
    roots = follow(done.where("form is not null"))
    return done.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
