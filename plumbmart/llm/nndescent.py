"""Approximate nearest neighbours: NN-descent graphs on shards, searched greedily.

``nearest(df, queries)`` returns, for every query row, its k nearest other rows by
cosine: query_id, rank, vec_id, score.

The graphs. Every vector is a vertex of one shard: that of its nearest centroid, or one of
the blocks that a large one is dealt to. A task builds the graph of a shard. Every
vertex has its DEGREE nearest so far, at first those in its nearest clusters within the
shard. In a round of NN-descent, around every vertex the new ones of its neighbours
and of vertices that have it as a neighbour (MEET of either, drawn) meet all of these
(at most DEGREE of those that have it), and each keeps what is nearer than its DEGREE-th.
Rounds end when few edges are new. A vertex is then linked with its neighbours and with
vertices that have it as theirs, those first that few others have.

The search. A query goes to the shards of its nearest centroids. In each it holds a beam
of the best vertices seen, at first the middles of the clusters, one vertex of each part
that is linked with none of them, and itself. The best that are not expanded are expanded
until the whole beam is. All of the beam that may be among the k nearest, given single
precision, is compared in double precision on the original vectors, and the k best of a
query from all its shards are brought together.

How many shards and how wide: a sample of at most AUDIT queries is compared with all
vectors and searched in all shards, until ``recall`` of its neighbours is found; the fewest
shards that hold this are visited by all queries. Below it, the graphs are built anew in
double precision if queries miss it whose beam ends before the bound of single precision
(tight groups), and else the beams are twice as wide. The result is audited for the same
sample, and for at most AUDIT queries of those whose beam ends so. Below ``recall`` in either,
it is double precision again, or else more shards, then wider beams. If the recall is still
missed when the beam is as wide as the table, that is an error.

Scale: each vector is shuffled a few times, whatever the rounds and beams, which stay
within tasks. A shard has about SPREAD times the root of the vertices, at most twice that
and within MOST and COMPONENTS, which bound a task's memory. The queries of a shard are
dealt to tasks by SLICE. Work for graphs is in proportion to the vertices; that of a query
is in proportion to the shards it visits, which the sample decides: few if near vectors
share clusters, and a share of all if directions are spread evenly in many dimensions.
Vectors of one direction (equal ones and multiples, to DIGITS decimals of the largest
component) are one vertex, which keeps its k + 1 smallest ids, as no query needs more of
them; so copies, however many, make no large shard. The driver sees the centroids' sample and the audit's
queries only.

Ties: cosines that agree to DIGITS decimals are equal, as the last bits depend on the
order of a sum, and the smaller id comes first. The score is the cosine of the two
original vectors. The audit counts a row as found if one as near was returned. Directions
that differ by more than DIGITS decimals though their cosine rounds to 1 (multiples in
single precision) are vertices of their own, so among more of them than the beam holds
the smallest ids may be missed.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null id, take no part. Vectors of another dimension
than the query's are not compared. Rows that agree in their id are one row, that
with the smallest digest of its vector. Fewer candidates than k: all of them.
Other columns are not returned. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbmart.llm.common import by_value, stored
from plumbmart.llm.vectors import PER_CENTROID, centroids_of, digest, kmeans, matrix, unit, usable, with_clusters

by_value(__name__)

#: Neighbours of a vertex, new ones of either kind that meet in a round, rounds, share of new edges that ends them.
DEGREE, MEET, ROUNDS, ENOUGH = 24, 16, 8, 0.02
#: Clusters within a shard, blocks of them that are compared at first, clusters of a vertex, pairs that a task holds before it sorts them.
CLUSTER, BLOCK, OVERLAP, PIECE = 400, 1000, 2, 2**22
#: Vertices of a shard as a multiple of the root of all, the least and the most, and components at most; queries of a task.
SPREAD, LEAST, MOST, COMPONENTS, SLICE = 32, 2048, 2**15, 2**21, 4096
#: First width of the beam in each shard, vertices that are expanded in a round, and what single precision may add to a cosine.
BEAM, STEP, ROUNDING = 128, 16, 1e-6
RECALL, AUDIT = 0.95, 100
DIGITS = 12
SHARD = ["size", "cluster", "block"]


def listed(rows: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    """Lists of the values of each of n rows; ``rows`` is in order."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), pa.array(values))


def best(n: int, k: int, vertex: np.ndarray, other: np.ndarray, value: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrays (n, k) of others, values and marks: the k distinct others of the largest value of each vertex, -1 where it has fewer.

    Values are from -1 to 1. An other that comes without a mark too has none.
    """
    vertex = vertex.astype(np.int64)
    pair = (vertex * n + other) * 2 + mark
    order = np.argsort(pair)
    pair = pair[order] >> 1
    order = order[np.concatenate([[True], pair[1:] != pair[:-1]])] if len(pair) else order
    # One number sorts faster than two columns; a shard has less than 2**17 vertices.
    order = order[np.argsort(vertex[order] << 46 | ((1 - np.clip(value[order].astype(np.float64), -1, 1)) * 2**44).astype(np.int64))]
    vertex, other, value, mark = vertex[order], other[order], value[order], mark[order]
    place = np.arange(len(vertex)) - np.searchsorted(vertex, vertex)
    keep = place < k
    at = vertex[keep], place[keep]
    others, values, marks = np.full((n, k), -1, np.int32), np.full((n, k), -2, value.dtype), np.zeros((n, k), bool)
    others[at], values[at], marks[at] = other[keep], value[keep], mark[keep]
    return others, values, marks


def drawn(others: np.ndarray, marks: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """For each vertex at most k that have it among their marked others, -1 where there are fewer."""
    source, target = np.nonzero(marks)[0], others[marks]
    value = rng.random(len(source), dtype=np.float32)
    return best(len(others), k, target, source, value, np.zeros(len(source), bool))[0]


def first_graph(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The neighbours within the blocks of the nearest clusters, and the vertices in the middle of the clusters."""
    n, rng = len(x), np.random.default_rng(7)
    clusters = max(1, -(-n // CLUSTER))
    centroids = kmeans(x[rng.permutation(n)[: clusters * PER_CENTROID]], clusters)
    cosine = x @ centroids.T
    near = np.argsort(-cosine, axis=1, kind="stable")[:, :OVERLAP]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, x.dtype))]
    for c in range(clusters):
        own = rng.permutation(np.flatnonzero((near == c).any(1)))
        for at in np.array_split(own, max(1, -(-len(own) // BLOCK))):
            k = min(DEGREE, len(at) - 1)
            if k > 0:
                met = x[at] @ x[at].T
                np.fill_diagonal(met, -2)
                to = np.argpartition(-met, k - 1, axis=1)[:, :k]
                found.append((np.repeat(at, k), at[to].ravel(), np.take_along_axis(met, to, 1).ravel()))
    vertex, other, value = (np.concatenate(c) for c in zip(*found, strict=True))
    return *best(n, DEGREE, vertex, other, value, np.ones(len(vertex), bool)), np.unique(cosine.argmax(0))


def meetings(x: np.ndarray, others: np.ndarray, cosines: np.ndarray, new: np.ndarray, rng: np.random.Generator) -> Iterator[list[np.ndarray]]:
    """(vertex, other, cosine) nearer than the vertex's last neighbour, of all that meet, in pieces; what was drawn of ``new`` is no longer new."""
    n = len(x)
    at = np.argpartition(np.where(new, rng.random(new.shape, dtype=np.float32), 2), MEET - 1, axis=1)[:, :MEET]
    ok = np.take_along_axis(new, at, 1)
    left = np.concatenate([np.where(ok, np.take_along_axis(others, at, 1), -1), drawn(others, new, MEET, rng)], 1)
    right = np.concatenate([others, drawn(others, others >= 0, DEGREE, rng)], 1)
    np.put_along_axis(new, at, False, 1)
    last = cosines[:, -1]
    some = others >= 0
    source, target, value = np.nonzero(some)[0], others[some], cosines[some]
    nearer = value > last[target]
    found, held = [(target[nearer], source[nearer], value[nearer])], 0
    for a in range(0, n, 64):
        l, r = left[a : a + 64], right[a : a + 64]
        cosine = x[l] @ x[r].transpose(0, 2, 1)
        apart = (l >= 0)[:, :, None] & (r >= 0)[:, None, :] & (l[:, :, None] != r[:, None, :])
        for other, fits in ((0, cosine > last[l][:, :, None]), (1, cosine > last[r][:, None, :])):
            row, i, j = np.nonzero(fits & apart)
            ends = l[row, i], r[row, j]
            found.append((ends[other], ends[1 - other], cosine[row, i, j]))
            held += len(row)
        if held >= PIECE or a + 64 >= n:
            yield [np.concatenate(c) for c in zip(*found, strict=True)]
            found, held = [], 0


def graph_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vertex, other) of all links of the unit vectors, in order, and the vertices where a search begins."""
    n, rng = len(x), np.random.default_rng(5)
    others, cosines, new, middles = first_graph(x)
    for _ in range(ROUNDS):
        for found in meetings(x, others, cosines, new, rng):
            some = others >= 0
            vertex, other, value = (np.concatenate(c) for c in zip((np.nonzero(some)[0], others[some], cosines[some]), found, strict=True))
            others, cosines, new = best(n, DEGREE, vertex, other, value, np.concatenate([new[some], np.ones(len(found[0]), bool)]))
        if new.sum() <= ENOUGH * (others >= 0).sum():
            break
    some = others >= 0
    source, target = np.nonzero(some)[0], others[some].astype(np.int64)
    had = np.bincount(target, minlength=n)
    # Own neighbours come first, then those that few others lead to.
    rank = np.concatenate([np.ones(len(source)), -had[source] / n])
    links = best(n, 2 * DEGREE, np.concatenate([source, target]), np.concatenate([target, source]), rank, np.zeros(len(rank), bool))[0]
    part, before = np.arange(n), None
    to = np.where(links < 0, np.arange(n)[:, None], links)
    while before is None or (part != before).any():
        before = part
        part = np.minimum(part, part[to].min(1))
        np.minimum.at(part, to.ravel(), np.repeat(part, to.shape[1]))
        part = part[part]
    apart = np.setdiff1d(part, part[middles])
    some = links >= 0
    return np.nonzero(some)[0], links[some], np.union1d(middles, apart)


def beams(x: np.ndarray, links: np.ndarray, starts: np.ndarray, own: np.ndarray, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The beams of the queries after all of them are expanded, in order: vertices, len(x) where there are fewer, and cosines.

    ``links`` has a row for each vertex and one for the vertex len(x) that is none; ``own``: the query's own vertex, or len(x).
    """
    n, rows = len(x), len(queries)
    base = np.arange(rows)[:, None] * (n + 1)
    seen, owner = np.zeros(rows * (n + 1), bool), np.zeros(rows * (n + 1), np.int32)
    ids = np.concatenate([np.broadcast_to(starts, (rows, len(starts))), own[:, None]], 1)
    # A query's own vertex may be a start.
    ids[:, :-1][ids[:, :-1] == own[:, None]] = n
    cosines = np.concatenate([queries @ x[starts].T, np.where(own < n, 1, -2).astype(x.dtype)[:, None]], 1)
    cosines[ids == n] = -2
    seen[base + ids] = seen[base + n] = True
    done = np.zeros(ids.shape, bool)
    while True:
        if ids.shape[1] > width:
            keep = np.argpartition(-cosines, width - 1, axis=1)[:, :width]
            ids, cosines, done = (np.take_along_axis(a, keep, 1) for a in (ids, cosines, done))
        open_ = np.where(done | (ids == n), -3, cosines)
        step = min(STEP, open_.shape[1])
        top = np.argpartition(-open_, step - 1, axis=1)[:, :step]
        live = np.take_along_axis(open_, top, 1) > -3
        if not live.any():
            break
        np.put_along_axis(done, top, True, 1)
        flat = (links[np.where(live, np.take_along_axis(ids, top, 1), n)].reshape(rows, -1) + base).ravel()
        flat = flat[~seen[flat]]
        # The same vertex may come from several.
        mark = np.arange(len(flat), dtype=np.int32)
        owner[flat] = mark
        flat = flat[owner[flat] == mark]
        seen[flat] = True
        row, vertex = np.divmod(flat, n + 1)
        value = np.concatenate([np.zeros(0, x.dtype), *(np.einsum("ij,ij->i", queries[row[a : a + 1024]], x[vertex[a : a + 1024]]) for a in range(0, len(row), 1024))])
        count = np.bincount(row, minlength=rows)
        place = np.arange(len(row)) - (np.cumsum(count) - count)[row]
        more, values = np.full((rows, count.max()), n, np.int64), np.full((rows, count.max()), -2, x.dtype)
        more[row, place], values[row, place] = vertex, value
        ids, cosines, done = np.concatenate([ids, more], 1), np.concatenate([cosines, values], 1), np.concatenate([done, np.zeros(more.shape, bool)], 1)
    order = np.argsort(-cosines, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(cosines, order, 1)


def vertices_of(df: DataFrame, key: str, vector: str, copies: int) -> tuple[DataFrame, DataFrame]:
    """(id, vertex, vector) of every row that takes part, and (vertex, vector, ids), one row for each direction."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")) & F.col("id").isNotNull()).withColumn("digest", digest(F.col("vector")))
    rows = rows.groupBy("id").agg(F.min_by("vector", "digest").alias("vector"))

    def directions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, out = batch.column(1), [b""] * batch.num_rows
            sizes = np.asarray(pa.compute.list_value_length(lists))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = matrix(lists.take(pa.array(at)))
                # -0.0 becomes 0.0
                x = np.round(x / np.abs(x).max(axis=1, keepdims=True), DIGITS) + 0.0
                for k, row in zip(at, x, strict=True):
                    out[k] = hashlib.blake2b(row.tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=["id", "vector", "digest"])

    rows = stored(rows.select("id", "vector").mapInArrow(directions, "id long, vector array<double>, digest binary"), "rows")
    ids = rows.withColumn("n", F.row_number().over(Window.partitionBy("digest").orderBy("id"))).where(F.col("n") <= copies).groupBy("digest").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    heads = stored(ids.withColumn("vertex", F.col("ids")[0]), "ids")
    vertices = heads.join(rows.select(F.col("id").alias("vertex"), "vector"), "vertex").select("vertex", "vector", "ids")
    return rows.join(heads.select("digest", "vertex"), "digest").select("id", "vertex", "vector"), stored(vertices, "vertices")


def share_of(vertices: DataFrame, count: int) -> int:
    """The vertices of a shard."""
    d = vertices.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return min(max(LEAST, int(SPREAD * count**0.5)), MOST, max(1, COMPONENTS // d.d)) if d else 1


def sharded(vertices: DataFrame, centroids: np.ndarray, share: int) -> DataFrame:
    """(vertex, vector) with the SHARD columns."""
    placed = with_clusters(vertices.select("vertex", "vector"), centroids, 1).select("vertex", "vector", F.size("vector").alias("size"), F.col("clusters")[0].alias("cluster"))
    placed = stored(placed, "placed")
    # A cluster may have twice as many as its share.
    counts = placed.groupBy("size", "cluster").agg(F.count("*").alias("members"))
    most = F.least(F.lit(2.0 * share), F.greatest(F.lit(1.0), F.lit(2 * COMPONENTS) / F.col("size")))
    blocks = counts.select("size", "cluster", F.ceil(F.col("members") / most).cast("int").alias("blocks"))
    return placed.join(blocks, ["size", "cluster"]).select("vertex", "vector", "size", "cluster", F.pmod(F.xxhash64("vertex"), "blocks").cast("int").alias("block"))


GRAPH = "size int, cluster int, block int, vertex long, vector array<double>, links array<int>, start boolean"


def graphs(shards: DataFrame, real: str) -> DataFrame:
    """The rows of every shard with their links, as places in the order of the vertices, and whether a search begins there."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vertex")
        vertex, other, starts = graph_of(unit(matrix(table.column("vector"))).astype(real))
        start = np.zeros(len(table), bool)
        start[starts] = True
        return table.append_column("links", listed(vertex, other, len(table))).append_column("start", pa.array(start))

    return shards.select(*SHARD, "vertex", "vector").groupBy(*SHARD).applyInArrow(run, GRAPH)


def search(queries: DataFrame, graph: DataFrame, centroids: np.ndarray, k: int, probes: int, width: int, real: str) -> DataFrame:
    """(query, rank, cut, others, scores) of each query (vertex, vector) and shard of its ``probes`` nearest centroids: its k nearest others there.

    ``rank`` is the place of the shard's centroid. ``cut``: the beam ends before all that may be among these by ``real`` numbers.
    """
    routed = with_clusters(queries.select("vertex", "vector"), centroids, probes).select(F.col("vertex").alias("query"), F.col("vector").alias("own"), F.size("vector").alias("size"), F.posexplode("clusters").alias("rank", "cluster"))
    routed = routed.join(graph.select(*(F.col(c).alias(c) for c in SHARD)).distinct(), ["size", "cluster"])
    slices = routed.groupBy(*SHARD).agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
    asked = routed.join(slices, SHARD).withColumn("slice", F.pmod(F.xxhash64("query"), "slices").cast("int"))
    dealt = graph.join(slices, SHARD).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    rounding = ROUNDING if real == "float32" else 10.0**-DIGITS

    def run(shard: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query", "rank", "cut", "others", "scores"]
        shard, asked = shard.sort_by("vertex"), asked.sort_by("query")
        vertex, query = shard.column("vertex").to_numpy(), asked.column("query").to_numpy()
        n = len(vertex)
        if not len(query) or not n:
            return pa.Table.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.float64()))], names=names)
        x, q = unit(matrix(shard.column("vector"))), unit(matrix(asked.column("own")))
        lists = shard.column("links").combine_chunks()
        sizes = np.asarray(pa.compute.list_value_length(lists))
        links = np.full((n + 1, max(1, sizes.max())), n, np.int64)
        links[:-1][np.arange(links.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
        starts = np.flatnonzero(shard.column("start").to_numpy())
        own = np.searchsorted(vertex, query)
        own = np.where(vertex[np.minimum(own, n - 1)] == query, own, n)
        short, wanted = x.astype(real), q.astype(real)
        cut, rows, others, scores = np.zeros(len(query), bool), [], [], []
        block = min(32, max(1, 2**21 // (n + 1)))
        for a in range(0, len(query), block):
            ids, cosines = beams(short, links, starts, own[a : a + block], wanted[a : a + block], width)
            for b in range(len(ids)):
                i = a + b
                keep = (ids[b] < n) & (ids[b] != own[i])
                at, near = ids[b][keep], cosines[b][keep]
                if len(at) > k:
                    bound = near[k - 1] - 2 * rounding
                    cut[i] = ids.shape[1] >= width and near[-1] >= bound
                    at = at[near >= bound]
                score = np.clip(x[at] @ q[i], -1, 1)
                order = np.lexsort((vertex[at], -np.round(score, DIGITS)))[:k]
                rows.append(np.full(len(order), i))
                others.append(vertex[at][order])
                scores.append(score[order])
        row = np.concatenate(rows)
        lists = [listed(row, np.concatenate(c), len(query)) for c in (others, scores)]
        return pa.Table.from_arrays([pa.array(query), pa.array(asked.column("rank").to_numpy()), pa.array(cut), *lists], names=names)

    left = dealt.select(*SHARD, "slice", "vertex", "vector", "links", "start").groupBy(*SHARD, "slice")
    right = asked.select(*SHARD, "slice", "query", "own", "rank").groupBy(*SHARD, "slice")
    return left.cogroup(right).applyInArrow(run, "query long, rank int, cut boolean, others array<long>, scores array<double>")


def united(parts: DataFrame, vertices: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, cut, found): for each query vertex the k + 1 best (score, id), its own ids among them."""
    best_ = lambda column, n: F.slice(F.sort_array(F.collect_list(column)), 1, n)
    each = parts.select("query", "cut", F.explode_outer(F.arrays_zip("scores", "others")).alias("o"))
    each = each.select("query", "cut", F.when(F.col("o").isNotNull(), F.struct((-F.round(F.col("o.scores"), DIGITS)).alias("minus"), F.col("o.others").alias("vertex"))).alias("o"))
    # A vertex has its smallest id as its name, so the best vertices hold the best ids.
    near = each.groupBy("query").agg(F.max("cut").alias("cut"), best_("o", k).alias("o"))
    own = F.array(F.struct(F.lit(-1.0).alias("minus"), F.col("vertex").alias("vertex")))
    near = queries.select("vertex").join(near.withColumnRenamed("query", "q"), F.col("vertex") == F.col("q"), "left").select(
        F.col("vertex").alias("query"), F.coalesce("cut", F.lit(False)).alias("cut"), F.concat(own, F.coalesce("o", F.array().cast("array<struct<minus:double,vertex:bigint>>"))).alias("o")
    )
    pairs = near.select("query", "cut", F.explode("o").alias("o")).select("query", "cut", "o.minus", "o.vertex")
    ids = pairs.join(vertices.select("vertex", "ids"), "vertex").select("query", "cut", "minus", F.explode("ids").alias("id"))
    return ids.groupBy("query").agg(best_(F.struct("minus", "id"), k + 1).alias("found"), F.max("cut").alias("cut"))


def compared(pairs: DataFrame) -> DataFrame:
    """(query, score, ids) of rows (query, own, vector, ids): cosines in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            sizes = np.asarray(pa.compute.list_value_length(batch.column(1)))
            for size in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == size))
                score[at] = np.einsum("ij,ij->i", unit(matrix(batch.column(1).take(at))), unit(matrix(batch.column(2).take(at))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(score, -1, 1)), batch.column(3)], names=["query", "score", "ids"])

    return pairs.select("query", "own", "vector", "ids").mapInArrow(run, "query long, score double, ids array<long>")


def true_ones(chosen: DataFrame, vertices: DataFrame, k: int) -> DataFrame:
    """(query, least, all) of a bounded number of query vertices: the cosine of the last of its k nearest others and their number, by brute force."""
    rows = chosen.join(vertices.select(F.col("vertex").alias("query"), "vector"), "query").collect()
    queries = vertices.sparkSession.sparkContext.broadcast([(r.query, np.asarray(r.vector, float)) for r in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids = np.asarray(pa.compute.list_value_length(batch.column(0))), batch.column(1)
            found = []
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                asked = [(query, vector) for query, vector in queries.value if len(vector) == size]
                if asked:
                    cosine = np.round(unit(np.stack([v for _, v in asked])) @ unit(matrix(batch.column(0).take(pa.array(at)))).T, DIGITS)
                    for (query, _), row in zip(asked, cosine, strict=True):
                        last = np.partition(row, -min(k + 1, len(row)))[-min(k + 1, len(row))]
                        top = np.flatnonzero(row > last)
                        top = [*top, *np.flatnonzero(row == last)[: k + 1 - len(top)]]
                        # The values decide, not which of equal ones.
                        found += [(query, float(row[t]), i) for t in top for i in ids[int(at[t])].as_py()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], kind) for c, kind in enumerate((pa.int64(), pa.float64(), pa.int64()))], names=["query", "score", "id"])

    every = vertices.select("vector", "ids").mapInArrow(run, "query long, score double, id long").where("query <> id")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return every.withColumn("n", place).where(F.col("n") <= k).groupBy("query").agg(F.min("score").alias("least"), F.count("id").alias("all"))


def sampled(queries: DataFrame, sample: int = AUDIT) -> DataFrame:
    return queries.orderBy(F.xxhash64("query", F.lit(5)), "query").limit(sample)


def audited(found: DataFrame, vertices: DataFrame, k: int, sample: int = AUDIT) -> tuple[float, float]:
    """The share of the k nearest others, or of others as near, that was found, by brute force, of a bounded sample of query vertices.

    Those whose beam was cut are a sample of their own, with a share of its own.
    """
    parts = [sampled(found.where(c), sample) for c in ("true", "cut")]
    truth = true_ones(parts[0].union(parts[1]).select("query").distinct(), vertices, k)
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query")), 1, k)
    hit = F.size(F.filter(others, lambda x: -x["minus"] >= F.col("least") - 2 * 10.0**-DIGITS))
    sums = truth.join(found, "query").select("cut", hit.alias("hit"), "all").groupBy("cut").agg(F.sum("hit"), F.sum("all")).collect()
    # One drawn from all queries that was cut adds to its own sample.
    shares = {r.cut: r[1] / r[2] for r in sums}
    return (sum(r[1] for r in sums) / sum(r[2] for r in sums) if sums else 1.0), shares.get(True, 1.0)


def tried(truth: DataFrame, parts: DataFrame, vertices: DataFrame, k: int) -> list[float]:
    """The share of the true ones that a search of the first shard, the first two and so on has found."""
    total = truth.agg(F.sum("all")).first()[0]
    if not total:
        return [1.0]
    each = parts.select("query", "rank", F.explode(F.arrays_zip("scores", "others")).alias("o")).select("query", "rank", "o.scores", F.col("o.others").alias("vertex"))
    # Copies of the query are its own vertex, which needs no search.
    own = truth.select("query", F.lit(0).alias("rank"), F.lit(1.0).alias("scores"), F.col("query").alias("vertex"))
    hits = each.union(own).join(truth, "query").where(F.round("scores", DIGITS) >= F.col("least") - 2 * 10.0**-DIGITS).join(vertices.select("vertex", "ids"), "vertex")
    hits = hits.select("query", "all", "rank", F.explode("ids").alias("id")).where("id <> query")
    place = F.row_number().over(Window.partitionBy("query").orderBy("rank", "id"))
    by = {r.rank: r["count"] for r in hits.withColumn("n", place).where(F.col("n") <= F.col("all")).groupBy("rank").count().collect()}
    return (np.cumsum([by.get(r, 0) for r in range(max(by, default=0) + 1)]) / total).tolist()


def nearest(df: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found of every row for which ``queries`` holds of its id."""
    members, vertices = vertices_of(df, key, vector, k + 1)
    members = stored(members, "members")
    asked = stored(members.where(queries), "queries")
    starts = stored(asked.select("vertex").distinct().join(vertices.select("vertex", "vector"), "vertex"), "starts")
    count = vertices.count()
    share = share_of(vertices, count)
    centroids = centroids_of(vertices.withColumnRenamed("vertex", "key"), share)
    shards = stored(sharded(vertices, centroids, share), "shards")
    some = sampled(starts.withColumnRenamed("vertex", "query")).select(F.col("query").alias("vertex"), "vector")
    truth = stored(true_ones(some.select(F.col("vertex").alias("query")), vertices, k), "truth")

    def searched(asked: DataFrame) -> DataFrame:
        return stored(search(asked, graph, centroids, k, probes, width, real), "parts")

    real, width, probes = "float32", BEAM, max(1, len(centroids))
    graph = stored(graphs(shards, real), "graph")
    # What a sample needs decides how many shards all queries visit, and how wide their beams are.
    while (shares := tried(truth, parts := searched(some), vertices, k))[-1] < recall and width < count:
        cut = truth.join(parts.where("cut").select("query").distinct(), "query", "left_semi")
        if real == "float32" and tried(cut, parts, vertices, k)[-1] < recall:
            real = "float64"
            graph = stored(graphs(shards, real), "graph")
        else:
            width *= 2
    probes = next((n for n, share in enumerate(shares, 1) if share >= recall), probes)
    while True:
        found = stored(united(searched(starts), vertices, starts, k), "found")
        every, tight = audited(found, vertices, k)
        held = min(every, tight)
        if held >= recall:
            break
        if real == "float32" and tight < recall:
            real = "float64"
            graph = stored(graphs(shards, real), "graph")
        elif probes < len(centroids):
            probes = min(2 * probes, len(centroids))
        elif width >= count:
            raise RuntimeError(f"recall {held:.3f} of {recall} with a beam of the whole table")
        else:
            width *= 2
    each = asked.select("id", "vertex").join(found, asked["vertex"] == found["query"]).select(F.col("id").alias("query"), F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, k).alias("f"))
    pairs = each.select("query", F.explode("f.id").alias("id"))
    pairs = pairs.join(members.select("id", "vector"), "id").join(asked.select(F.col("id").alias("query"), F.col("vector").alias("own")), "query")
    out = compared(pairs.select("query", "own", "vector", F.array("id").alias("ids"))).select("query", "score", F.col("ids")[0].alias("id"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc(F.round("score", DIGITS)), "id"))
    return out.select(F.col("query").alias("query_id"), place.cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
