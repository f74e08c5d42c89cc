"""Words and bytes of Arrow text columns as numpy arrays, and columns computed from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from plumbmart.llm.common import by_value, without

by_value(__name__)

#: Bytes handled at once; intermediate arrays take about fifty times as much.
CHUNK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: One random number for each byte, and the base of the polynomial, both from fixed seeds.
BYTE_KEYS = np.random.default_rng(17).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, and where each row's begin; a null has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def spans(data: np.ndarray, chunk: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of about ``chunk`` bytes that begin at white space, so that no word is cut."""
    start = 0
    while start < len(data):
        stop = start + chunk
        if stop < len(data):
            back = np.flatnonzero(SPACE[data[start + 1 : stop + 1]])
            if len(back):
                stop = start + 1 + int(back[-1])
            else:
                step = stop
                while step < len(data) and not SPACE[data[step : step + chunk]].any():
                    step += chunk
                stop = step + int(np.argmax(SPACE[data[step : step + chunk]])) if step < len(data) else len(data)
        stop = min(stop, len(data))
        yield start, stop
        start = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word in order, and the index of the row it stands in."""
    hashes, rows = [], []
    power = np.ones(1, np.uint64)
    for start, stop in spans(data):
        b = data[start:stop]
        solid = ~SPACE[b]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        edges = offsets[(offsets >= start) & (offsets < stop)] - start
        first[edges] = solid[edges]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        at = np.flatnonzero(solid)
        heads = np.searchsorted(at, starts)
        lengths = np.diff(np.append(heads, len(at)))
        within = np.arange(len(at)) - np.repeat(heads, lengths)
        if (longest := int(lengths.max())) > len(power):
            power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(longest, BASE)]))
        letters = (LOWER[b] if lower else b)[at]
        hashes.append(mixed(np.add.reduceat(BYTE_KEYS[letters] * power[within], heads)))
        rows.append(np.searchsorted(offsets, starts + start, "right") - 1)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(rows)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one a byte, first axis) over each row's bytes."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0, dtype=np.float64)
    return out


def with_columns(df: DataFrame, text: str, fields: Sequence[StructField], start: Callable[[], Callable[[pa.Array], list[pa.Array]]], block: int = 8 << 20) -> DataFrame:
    """``df`` with columns computed from its text, in Arrow batches and without a shuffle.

    ``start`` is called once a task and returns the function from a text column to
    the new columns. It gets at most about ``block`` bytes of text at once, or one
    text. Input columns named like a new one, in any case, are replaced.
    """
    kept = without(df, *(f.name for f in fields))
    names = [*kept.columns, *(f.name for f in fields)]
    source = kept.withColumn("__text", F.col(f"`{text}`").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            sizes = np.diff(bytes_of(column)[1])
            lo = 0
            while lo < len(sizes):
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), block, "right")) + lo)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *compute(part.column(part.num_columns - 1))], names=names)
                lo = hi

    return source.mapInArrow(run, StructType([*kept.schema.fields, *fields]))
