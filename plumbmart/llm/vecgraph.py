"""Near duplicates among embeddings, found through a robust-pruned flat graph.

``near_duplicates(df)`` links all vectors of an equal label whose cosine is 0.93 or
more: for every row its number of links and the smallest id that links reach.

The method. Every vector is put into the shards of its two nearest clusters and of
those that a vector at the threshold from it may be nearest to. Each block of a shard gets a graph: candidates are a vector's
nearest ones in the block, and of two that lie in the same direction only the
nearer stays (robust pruning), with edges both ways. The adjacency lists that a vector has
from its shards are united. Then every vector is searched in each of its shards:
greedily with a small beam from the medoids of the blocks and from its own place,
and then through all vertices within a widened range until nothing new is in it.
What is found is verified by the cosine in double precision.

The recall is audited in every run: a sample of about AUDIT vectors, drawn alike from
classes of their number of links, is compared with all vectors of its label. If fewer than
``recall`` of the links were found, everything is done again with twice the reach, and
if it is still missed with all shards in reach, that is an error. If the sample has no
link, a warning says that the recall is unknown.

Scale: equal vectors of a label are one class. Shards are dealt out in blocks of
about BLOCK vectors, each pair of blocks a group of its own, so no group grows
with the data, however many vectors are alike. Pairs are counted inside groups
(in the first cluster that both vectors have) and never become rows: a group
gives for each member a number of links and one member it is connected to.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing; nor do vectors of
different length. A null id takes part but is never the smallest id. Rows that
repeat are copies. Other columns are not returned. An empty table gives an empty
one.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbmart.llm.common import by_value, stored
from plumbmart.llm.components import components
from plumbmart.llm.minhash import Union
from plumbmart.llm.vectors import centroids_of, digest, matrix, unit, usable, with_clusters

by_value(__name__)

THRESHOLD, OVERLAP, RECALL, AUDIT = 0.93, 2, 0.9, 200
#: How far into other clusters a vector at the threshold is expected, in standard deviations of a random direction: in simulation
#: (64 dimensions, random, 20 to 1,000 clusters) 0.994 to 0.999 of pairs at cosine 0.93 share a shard, in 2.8 to 5.8 shards a vector.
DEVIATIONS = 1
#: Vectors of a cluster, and of a block of a shard, on average.
CLUSTER, BLOCK = 1_000, 800
#: Candidates, kept edges, pruning factor, width of the beam, and how far below the threshold vertices are expanded.
CANDIDATES, DEGREE, ALPHA, BEAM, SLACK = 48, 20, 1.2, 8, 0.06


def pruned(x: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each of the unit vectors ``x``: robust pruning of the nearest, and edges back."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, np.int64) for _ in range(n)]
    distance = np.maximum(0, 1 - x @ x.T)
    np.fill_diagonal(distance, np.inf)
    width = min(CANDIDATES, n - 1)
    near = np.argpartition(distance, width - 1, axis=1)[:, :width]
    own = np.take_along_axis(distance, near, 1)
    order = np.argsort(own, axis=1, kind="stable")
    near, own = np.take_along_axis(near, order, 1), np.take_along_axis(own, order, 1)
    alive, kept = np.ones(near.shape, bool), np.zeros(near.shape, bool)
    for k in range(width):
        kept[:, k] = alive[:, k] & (kept.sum(1) < DEGREE)
        between = distance[near[:, k][:, None], near]
        alive &= ~(kept[:, k][:, None] & (ALPHA * between <= own))
    start, rank = np.nonzero(kept)
    end = near[start, rank]
    edges = np.unique(np.concatenate([start * n + end, end * n + start]))
    return np.split(edges % n, np.searchsorted(edges // n, np.arange(1, n)))


def searched(x: np.ndarray, graph: np.ndarray, entries: list[int], radius: float, lo: int, hi: int) -> np.ndarray:
    """Cosines of the vectors lo to hi with those that the search sees, -2 elsewhere.

    ``graph`` has each vertex's neighbours, filled up with -1.
    """
    q, n = hi - lo, len(x)
    cosine = np.full((q, n), -2, np.float32)
    rows = np.arange(q)
    cosine[:, entries] = x[lo:hi] @ x[entries].T
    cosine[rows, np.arange(lo, hi)] = 1
    expanded = np.zeros((q, n), bool)

    step = max(1, 500_000 // graph.shape[1])

    def expand(r: np.ndarray, c: np.ndarray) -> None:
        expanded[r, c] = True
        for a in range(0, len(r), step):
            new = graph[c[a : a + step]]
            row = np.broadcast_to(r[a : a + step, None], new.shape)[new >= 0]
            new = new[new >= 0]
            unseen = cosine[row, new] == -2
            pair = np.unique(row[unseen] * n + new[unseen])
            for b in range(0, len(pair), 50_000):
                row, new = np.divmod(pair[b : b + 50_000], n)
                cosine[row, new] = np.einsum("ij,ij->i", x[lo + row], x[new])

    while True:
        waiting = np.where(expanded, np.float32(-3), cosine)
        best = waiting.argmax(1)
        value = waiting[rows, best]
        last = np.partition(cosine, n - BEAM, axis=1)[:, n - BEAM] if n > BEAM else np.full(q, -2, np.float32)
        go = (value > -2) & (value >= last)
        if not go.any():
            break
        expand(rows[go], best[go])
    while True:
        r, c = np.nonzero((cosine >= radius) & ~expanded)
        if not len(r):
            return cosine
        expand(r, c)


def built(table: pa.Table) -> pa.Table:
    """(key, near) of the members of one block of one shard."""
    keys = table.column("key").to_pylist()
    near = pruned(unit(matrix(table.column("vector"))))
    return pa.table({"key": pa.array(keys, pa.binary()), "near": pa.array([[keys[k] for k in row] for row in near], pa.list_(pa.binary()))})


def group_links(table: pa.Table, threshold: float) -> pa.Table:
    """(key, links, root) of the members of one group, one or two blocks of a shard, that have a link."""
    table = table.sort_by([("side", "ascending"), ("key", "ascending")])
    keys, side = table.column("key").to_pylist(), table.column("side").to_numpy()
    x = unit(matrix(table.column("vector")))
    clusters = table.column("clusters").to_pylist()
    weights, cluster = table.column("weight").to_numpy(), table.column("cluster")[0].as_py()
    number = {k: i for i, k in enumerate(keys)}
    near = [[number[k] for k in row if k in number] for row in table.column("near").to_pylist()]
    graph = np.full((len(keys), max(1, max(map(len, near)))), -1, np.int64)
    for i, row in enumerate(near):
        graph[i, : len(row)] = row
    entries = []
    for s in np.unique(side):
        at = np.flatnonzero(side == s)
        entries.append(int(at[(x[at] @ x[at].mean(0)).argmax()]))
    one_block = side[0] == side[-1]
    short = x.astype(np.float32)
    links, union = np.zeros(len(keys), np.int64), Union(len(keys))
    found = []
    for lo in range(0, len(keys), 512):
        seen = searched(short, graph, entries, threshold - SLACK, lo, min(len(keys), lo + 512))
        r, c = np.nonzero(seen >= threshold - 1e-4)
        r += lo
        found.append(np.stack([np.minimum(r, c), np.maximum(r, c)])[:, r != c])
    a, b = np.unique(np.concatenate(found, axis=1), axis=1)
    other = np.ones(len(a), bool) if one_block else side[a] != side[b]
    a, b = a[other], b[other]
    exact = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
    a, b = a[exact], b[exact]
    first = np.array([min(set(clusters[i]).intersection(clusters[j])) == cluster for i, j in zip(a, b, strict=True)], bool)
    a, b = a[first], b[first]
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        union.join(i, j)
    np.add.at(links, a, weights[b])
    np.add.at(links, b, weights[a])
    some = np.flatnonzero(links).tolist()
    return pa.table({"key": pa.array([keys[k] for k in some], pa.binary()), "links": pa.array(links[some], pa.int64()), "root": pa.array([keys[union.find(k)] for k in some], pa.binary())})


def linked(classes: DataFrame, centroids: np.ndarray, overlap: int, threshold: float, deviations: float) -> DataFrame:
    """(key, links, root) found with so many clusters a vector."""
    placed = stored(with_clusters(classes, centroids, overlap, reach=(threshold, deviations)), "clusters")
    shards = placed.select("key", "label", F.size("vector").alias("size"), F.explode("clusters").alias("cluster"))
    blocks = shards.groupBy("label", "size", "cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("key", "cluster"), F.col("blocks")).cast("int")
    dealt = stored(shards.join(blocks, ["label", "size", "cluster"]).withColumn("own", own), "members")

    def block_graph(table: pa.Table) -> pa.Table:
        return built(table)

    graph = dealt.join(placed.select("key", "vector"), "key").groupBy("label", "size", "cluster", "own").applyInArrow(block_graph, "key binary, near array<binary>")
    united = stored(graph.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")

    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("key", "label", "size", "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    rows = pairs.join(placed.select("key", "vector", "weight", "clusters").join(united, "key"), "key")

    def search(table: pa.Table) -> pa.Table:
        return group_links(table, threshold)

    return stored(rows.groupBy("label", "size", "cluster", "i", "j").applyInArrow(search, "key binary, links long, root binary"), "links")


def audited(classes: DataFrame, links: DataFrame, threshold: float, sample: int = AUDIT) -> float | None:
    """The share of the links of vectors that have any which was found, by brute force, or None if no link was seen.

    The sample is bounded and drawn alike from vectors without a found link and with
    1, 2 to 3, 4 to 7 ... of them; each vector counts alike. The lower counts of the worst of
    those with links, and of all by the number of vectors that each stands for.
    """
    found = links.groupBy("key").agg(F.sum("links").alias("found"))
    kinds = classes.join(found, "key", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    kinds = stored(kinds.withColumn("kind", F.least(F.ceil(F.log2(F.col("found") + 1)), F.lit(12)).cast("int")), "audit")
    counts = {r.kind: r["count"] for r in kinds.groupBy("kind").count().collect()}
    share = -(-sample // max(1, len(counts)))
    chosen = [r for kind in counts for r in kinds.where(F.col("kind") == kind).orderBy(F.xxhash64("key", F.lit(3)), "key").limit(share).collect()]
    if not chosen:
        return None
    queries = classes.sparkSession.sparkContext.broadcast([(bytes(r.key), r.label, np.asarray(r.vector, float)) for r in chosen])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lists, weights = batch.column(2), batch.column(3).to_numpy()
            sizes = np.asarray(pa.compute.list_value_length(lists))
            found = []
            for key, label, vector in queries.value:
                at = [k for k, (n, l, own) in enumerate(zip(sizes, labels, keys, strict=True)) if n == len(vector) and l == label and own != key]
                if at:
                    near = unit(matrix(lists.take(pa.array(at)))) @ unit(vector[None, :])[0] >= threshold
                    found.append((key, int(weights[at][near].sum())))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())], names=["key", "true"])

    truth = classes.select("label", "key", "vector", "weight").mapInArrow(run, "key binary, true long").groupBy("key").agg(F.sum("true").alias("true"))
    true = {bytes(r.key): r.true for r in truth.collect()}
    parts: dict[int, list[float | None]] = {}
    for r in chosen:
        n = true.get(bytes(r.key), 0)
        parts.setdefault(r.kind, []).append(min(1.0, r.found / n) if n else None)
    shares, weights = [], []
    for kind, each in parts.items():
        seen = [x for x in each if x is not None]
        if seen:
            shares.append((kind, sum(seen) / len(seen)))
            weights.append(counts[kind] * len(seen) / len(each))
    if not shares:
        return None
    return min([sum(w * x for w, (_, x) in zip(weights, shares, strict=True)) / sum(weights), *(x for kind, x in shares if kind)])


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each row of ``df``: id, n_links, component_id, kept."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("__id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.col(f"`{label}`").cast("string").alias("label"))
    rows = rows.withColumn("some", usable(F.col("vector")) & F.col("label").isNotNull()).withColumn("key", digest(F.col("label"), F.col("vector")))
    classes = rows.where("some").groupBy("key").agg(F.min("__id").alias("first"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = stored(classes, "classes")
    centroids = centroids_of(classes, CLUSTER)
    deviations, overlap, limit = DEVIATIONS, OVERLAP, np.sqrt(max(1, centroids.shape[1] - 1))
    while True:
        links = linked(classes, centroids, overlap, threshold, deviations)
        share = audited(classes, links, threshold)
        if share is None:
            warnings.warn("no link among the audited vectors: recall unknown", stacklevel=2)
        if share is None or share >= recall:
            break
        if deviations >= limit:
            # Nothing is missed between shards any more.
            raise RuntimeError(f"recall {share:.3f} of {recall} with all shards in reach")
        deviations *= 2
    counted = links.groupBy("key").agg(F.sum("links").alias("links"))
    reached = components(links.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("vertex", "key")
    joined = classes.select("key", "first", "weight").join(counted, "key", "left").join(reached, "key", "left").withColumn("component", F.coalesce("component", "key"))
    smallest = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(joined.join(smallest, "component").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "classes")
    done = rows.select("__id", F.when(F.col("some"), F.col("key")).alias("key")).join(named, "key", "left")
    # An own name that joins with nothing has no class: it stands alone.
    alone = F.col("key").isNull()
    component = F.when(alone, F.col("__id")).otherwise(F.col("component_id"))
    return done.select(F.col("__id").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("__id"), F.lit(False)).alias("kept"))
