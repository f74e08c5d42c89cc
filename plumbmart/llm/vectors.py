"""Helpers for tables of vectors: which take part, classes of equal ones, clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from plumbmart.llm.common import by_value

by_value(__name__)

#: Centroids are fitted on at most this many vectors for each, and at most so many centroids.
PER_CENTROID, MAX_CENTROIDS = 32, 8_192


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: finite components, none null, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def digest(*columns: Column) -> Column:
    """16 bytes that equal values share; -0.0 counts as 0.0 and whole numbers as such."""
    return F.unhex(F.md5(F.to_json(F.struct(*(c.alias(f"c{k}") for k, c in enumerate(columns)))).cast("binary")))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column whose lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids of unit vectors by spherical k-means from a seeded start."""
    rng = np.random.default_rng(11)
    centroids = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[a : a + 4096] @ centroids.T).argmax(1) for a in range(0, len(x), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        size = np.sqrt((sums * sums).sum(1))
        centroids = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centroids)
    return centroids


def centroids_of(df: DataFrame, per_cluster: int, key: str = "key", vector: str = "vector") -> np.ndarray:
    """Centroids for clusters of about ``per_cluster`` vectors, fitted on the vectors with the smallest hashes.

    Vectors of the most common dimension only; at most MAX_CENTROIDS centroids and
    PER_CENTROID vectors for each reach the driver.
    """
    sizes = df.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return np.zeros((0, 1))
    k = min(MAX_CENTROIDS, max(1, -(-sizes[0]["count"] // per_cluster)))
    sample = df.where(F.size(vector) == sizes[0].d).orderBy(F.xxhash64(key), key).limit(k * PER_CENTROID).select(vector).toPandas()
    x = unit(np.stack([np.asarray(v, float) for v in sample[vector]]))
    return kmeans(x, min(k, len(x)))


def with_clusters(df: DataFrame, centroids: np.ndarray, overlap: int, vector: str = "vector", name: str = "clusters", reach: tuple[float, float] | None = None) -> DataFrame:
    """``df`` with the ``overlap`` nearest clusters of each vector; those of another dimension are in cluster 0.

    With ``reach`` (threshold, deviations) also those that are within_reach().
    """
    shared = df.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(vector))
            fits = np.asarray(pa.compute.list_value_length(lists)) == c.shape[1]
            out: list[list[int]] = [[0]] * len(lists)
            if fits.any():
                at = np.flatnonzero(fits)
                x = unit(matrix(lists.take(pa.array(at))))
                near = within_reach(x, c, *reach, overlap) if reach else np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :overlap].tolist()
                for k, row in zip(at, near, strict=True):
                    out[k] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, ArrayType(IntegerType()))]))


def within_reach(x: np.ndarray, c: np.ndarray, threshold: float, deviations: float, least: int) -> list[list[int]]:
    """For each unit vector the clusters that a vector at the threshold from it may be nearest to, at least the ``least`` nearest.

    Such a vector is x cos + u sin with u at right angles to x. It is nearer to a centroid
    c than to the nearest one n if (c - n) u sin > (n - c) x cos, and (c - n) u is at most
    the length of c - n across x; for a random direction u its standard deviation is that
    by the root of the dimensions. From that root on, ``deviations`` miss nothing.
    """
    threshold, d = max(threshold, 1e-3), max(1, x.shape[1] - 1)
    factor = np.sqrt(max(0.0, 1 - threshold * threshold)) / threshold * min(1.0, deviations / np.sqrt(d))
    own, out = (c * c).sum(1), []
    for a in range(0, len(x), 512):
        cosine = x[a : a + 512] @ c.T
        order = np.argsort(-cosine, axis=1, kind="stable")
        first = order[:, 0]
        gap = cosine[np.arange(len(first)), first][:, None] - cosine
        across = np.sqrt(np.maximum(0, own[first][:, None] + own - 2 * c[first] @ c.T - gap * gap))
        fits = gap <= factor * across + 1e-9
        out += [row[f | (np.arange(len(row)) < least)].tolist() for row, f in zip(order, np.take_along_axis(fits, order, 1), strict=True)]
    return out
