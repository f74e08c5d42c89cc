"""A two-level n-gram trie in Elias-Fano form, as plain bytes that numpy maps without copying.

Level one has the words that are contexts, sorted; its pointers say where each
one's successors begin. Level two has the successors as ranks in the shard's
list of words, sorted within a context; adding the context's number times the
number of words makes the whole level one rising sequence. Pointers and
successors are stored by Elias and Fano's code: the low bits of every number
packed, the high bits as a bit vector of ones and steps. Every successor has one
byte for its discounted probability and every context one for its back-off mass,
both indices into a codebook of up to 255 values (0: exactly zero).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from plumbmart.llm.common import by_value

by_value(__name__)


def ef_encode(values: np.ndarray) -> bytes:
    """Bytes of a rising sequence of unsigned 64-bit numbers."""
    n = len(values)
    if not n:
        return np.array([0, 0], "<u8").tobytes()
    width = max(0, int(values[-1]).bit_length() - n.bit_length())
    low = values & np.uint64((1 << width) - 1)
    bits = ((low[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if width else np.zeros((n, 0), np.uint8)
    high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    marks = np.zeros(int(high[-1]) + 1, np.uint8)
    marks[high] = 1
    return b"".join([np.array([n, width], "<u8").tobytes(), np.packbits(bits.ravel()).tobytes(), np.packbits(marks).tobytes()])


def ef_decode(data: bytes | memoryview) -> np.ndarray:
    """The sequence that ``ef_encode`` wrote."""
    n, width = (int(x) for x in np.frombuffer(data, "<u8", 2))
    if not n:
        return np.zeros(0, np.uint64)
    packed = np.frombuffer(data, np.uint8, offset=16)
    size = (n * width + 7) // 8
    low = np.zeros(n, np.uint64)
    if width:
        bits = np.unpackbits(packed[:size], count=n * width).reshape(n, width)
        for k in range(width):
            low |= bits[:, k].astype(np.uint64) << np.uint64(k)
    high = np.flatnonzero(np.unpackbits(packed[size:]))[:n] - np.arange(n)
    return (high.astype(np.uint64) << np.uint64(width)) | low


#: The probability of each code: none for 0, then from 1 down to 10 ** -10.
PROBABILITY = np.concatenate([[0.0], 10.0 ** (-np.arange(255) * 10 / 254)])


def quantised(values: np.ndarray) -> np.ndarray:
    """The nearest code of each probability; 0 stays 0."""
    with np.errstate(divide="ignore"):
        steps = np.rint(-np.log10(values) * 254 / 10)
    return np.where(values > 0, np.clip(steps, 0, 254) + 1, 0).astype(np.uint8)


@dataclass
class Trie:
    """One shard: sorted hashes of its contexts and words, and the coded levels."""

    contexts: np.ndarray
    words: np.ndarray
    pointers: bytes
    successors: bytes
    codes: np.ndarray
    backoff: np.ndarray

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray, n: np.ndarray) -> Trie:
        """From distinct pairs of word hashes, sorted, with their counts above zero."""
        contexts, start = np.unique(first, return_index=True)
        sizes = np.diff(np.append(start, len(first)))
        words, rank = np.unique(second, return_inverse=True)
        total = np.add.reduceat(n, start) if len(n) else np.zeros(0, np.int64)
        # The share of mass that the successors of a context give to the others (absolute
        # discounting); the discount is Ney's estimate from the pairs seen once and twice.
        once, twice = int((n == 1).sum()), int((n == 2).sum())
        discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
        codes = quantised((n - discount) / np.repeat(total, sizes) if len(n) else np.zeros(0))
        back = quantised(discount * sizes / np.maximum(total, 1))
        base = np.repeat(np.arange(len(contexts), dtype=np.uint64) * np.uint64(max(1, len(words))), sizes)
        return cls(contexts, words, ef_encode(start.astype(np.uint64)), ef_encode(base + rank.astype(np.uint64)), codes, back)

    def to_bytes(self) -> bytes:
        parts = [x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes() for x in (self.contexts, self.words, self.pointers, self.successors, self.codes, self.backoff)]
        return np.array([len(p) for p in parts], "<u8").tobytes() + b"".join(parts)

    @classmethod
    def map(cls, data: bytes) -> Trie:
        """The trie in ``data``, of which nothing is copied."""
        view, ends = memoryview(data), 48 + np.cumsum(np.frombuffer(data, "<u8", 6)).astype(int)
        parts = [view[int(a) : int(b)] for a, b in zip([48, *ends], ends, strict=False)]
        kinds = ("<u8", "<u8", None, None, "u1", "u1")
        return cls(*(p if k is None else np.frombuffer(p, k) for p, k in zip(parts, kinds, strict=True)))

    def backoffs(self, contexts: np.ndarray) -> np.ndarray:
        """The code of the back-off mass of each context; that of 1 where it is unknown."""
        if not len(self.contexts):
            return np.ones(len(contexts), np.uint8)
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        return np.where(self.contexts[at] == contexts, self.backoff[at], np.uint8(1))

    def lookup(self) -> Successors:
        return Successors(self)


class Successors:
    """The decoded successor level of one trie, to answer blocks of queries."""

    def __init__(self, trie: Trie):
        self.trie = trie
        self.level = ef_decode(trie.successors)
        self.pointers = np.append(ef_decode(trie.pointers).astype(np.int64), len(self.level))

    def codes(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The code of the discounted probability of each pair; 0 where it is unknown.

        The successor's rank is searched relative to its context: in the part of
        the level that the context's pointers bound.
        """
        t = self.trie
        if not len(t.contexts):
            return np.zeros(len(first), np.uint8)
        c = np.minimum(np.searchsorted(t.contexts, first), len(t.contexts) - 1)
        w = np.minimum(np.searchsorted(t.words, second), len(t.words) - 1)
        known = (t.contexts[c] == first) & (t.words[w] == second)
        wanted = c.astype(np.uint64) * np.uint64(len(t.words)) + w.astype(np.uint64)
        at = np.clip(np.searchsorted(self.level, wanted), self.pointers[c], np.maximum(self.pointers[c + 1] - 1, self.pointers[c]))
        return np.where(known & (self.level[at] == wanted), t.codes[at], np.uint8(0))
