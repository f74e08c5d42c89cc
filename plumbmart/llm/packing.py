"""Best-fit packing by bin completion: documents cut into pieces, pieces put together into sequences.

``token_pieces`` encodes texts and cuts the ids into pieces, ``pack`` gives every
piece a sequence and an offset in it, ``sequences`` joins the ids of each sequence.

The method. Pieces of equal length are interchangeable, so a packing is settled
by how many pieces each length has: at most one count for each length up to the
capacity, however many rows there are. ``fillings`` searches that histogram by
bin completion: take the largest length left, enumerate the fillings of the room
beside it that no other filling dominates (B is dominated by A if the pieces of B
fit, in groups, into the places of A's pieces), least waste first, and go on with
the rest, depth first. A branch ends where the waste already made plus the bound
on the rest (sum of lengths, and Martello and Toth's bound on pieces that cannot
share) leaves no better packing than the incumbent, which is the best-fit
decreasing packing at first. A filling is applied as often as its pieces last
before smaller multiples are tried, so equal pieces cost one step.

The search ends when the incumbent meets the lower bound, when all branches are
settled, or after ``EFFORT`` nodes; the last leaves the best packing found, never
worse than best-fit decreasing. ``Packing.bound`` tells how far it can be from the
least number.

Scale: encoding is a map. Pieces are range-partitioned by (length, keys) and
numbered without one task seeing them all, so a length that a third of all pieces
have spreads over tasks. Only the histogram (``capacity`` rows at most) reaches
the driver, and only the list of fillings goes to the tasks, whose size depends on
the capacity alone. All tables between jobs are written to the shared folder.

Null and empty texts have the end id alone. Repeated rows are pieces of their own;
ties of all keys may take each other's places. Empty tables give empty results. An
input column named like a result column, in any case, is replaced. A length that
is null, below 1 or above the capacity is an error.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from plumbmart.llm.bpe import ASCII_SPLIT, byte_letters
from plumbmart.llm.common import by_value, without
from plumbmart.llm.ordering import ordered

by_value(__name__)

#: Nodes of the search; steps and fillings of the enumeration at one node.
EFFORT = 4_000
STEPS = 2_000
CHOICES = 32
#: Characters encoded at once, and bytes of encoded words kept between blocks.
BLOCK = 1_000_000
MEMORY = 96 << 20
OVERHEAD = 180
#: White space that no token spans.
WHITE = re.compile(r"[^\x20\x09-\x0D]+")
# Fixed values of the file format: its split pattern over lower-cased text of Latin letters, which end before U+02B0.
BEYOND = re.compile("[^\x00-\u02af]")
PLAIN_SPLIT = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºÀ-ÖØ-öø-ʯ]+|[0-9²³¹¼½¾]|[^\x09-\x0D\x20\x85\xA0a-z0-9ªµº²³¹¼½¾À-ÖØ-öø-ʯ]+"
)

Filling = tuple[tuple[int, int], ...]


@dataclass
class Packing:
    """Fillings, each with how many sequences have it; ``bound`` is a lower bound of the number of sequences."""

    fillings: list[tuple[Filling, int]]
    bound: int

    @property
    def count(self) -> int:
        return sum(times for _, times in self.fillings)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The least number of sequences that the lengths can need: by their sum, and by pieces that cannot share."""
    lengths = np.arange(capacity + 1)
    number, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * lengths)])
    k = np.arange(1, capacity // 2 + 1)
    half = capacity // 2
    big = number[-1] - number[capacity - k + 1]
    middle = number[capacity - k + 1] - number[half + 1]
    middle_sum = total[capacity - k + 1] - total[half + 1]
    small_sum = total[half + 1] - total[k]
    rest = np.maximum(small_sum - (middle * capacity - middle_sum), 0)
    each = big + middle + -(-rest // capacity)
    return int(max(each.max(initial=0), -(-total[-1] // capacity)))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on the histogram: a bin that takes a piece is the tightest one for the next of that length."""
    room: dict[int, list[tuple[Filling, int]]] = {capacity: []}
    for length in map(int, np.flatnonzero(counts)[::-1]):
        left = int(counts[length])
        for space in sorted(s for s in room if s >= length and s < capacity):
            if not left:
                break
            each = space // length
            groups, room[space] = room.pop(space), []
            for filling, times in groups:
                full = min(times, left // each)
                part = left - full * each if full < times else 0
                if full:
                    room.setdefault(space - each * length, []).append(((*filling, (length, each)), full))
                if part:
                    room.setdefault(space - part * length, []).append(((*filling, (length, part)), 1))
                left -= full * each + part
                if times > full + (part > 0):
                    room[space].append((filling, times - full - (part > 0)))
        each = capacity // length
        for times, pieces in ((left // each, each), (1, left % each)):
            if times and pieces:
                room.setdefault(capacity - pieces * length, []).append((((length, pieces),), times))
    merged: Counter[Filling] = Counter()
    for groups in room.values():
        for filling, times in groups:
            merged[filling] += times
    return list(merged.items())


def dominates(a: Sequence[int], b: Sequence[int]) -> bool:
    """Whether the pieces of ``b`` fit, in groups, into the places of the pieces of ``a`` (both largest first)."""
    if sum(b) > sum(a) or (b and not a):
        return False
    if len(a) * len(b) > 64:
        # The exact test grows exponentially; not knowing only keeps a filling.
        return False

    def place(k: int, rooms: tuple[int, ...]) -> bool:
        if k == len(b):
            return True
        tried = set()
        for j, r in enumerate(rooms):
            if r >= b[k] and r not in tried:
                tried.add(r)
                if place(k + 1, (*rooms[:j], r - b[k], *rooms[j + 1 :])):
                    return True
        return False

    return place(0, tuple(a))


def completions(counts: np.ndarray, capacity: int, largest: int, waste: int) -> list[Filling]:
    """Undominated fillings around one piece of the largest length that waste at most ``waste``, least waste first.

    Only maximal fillings are made, larger pieces first; a piece that fills the
    room exactly dominates all others. At most ``STEPS`` steps and ``CHOICES``
    fillings.
    """
    room = capacity - largest
    have = counts.copy()
    have[largest] -= 1
    if room and have[room]:
        return [_filling([largest, room])]
    lengths = [int(x) for x in np.flatnonzero(have[: room + 1])[::-1]]
    below = np.concatenate([np.cumsum([x * int(have[x]) for x in reversed(lengths)])[::-1], [0]]) if lengths else np.zeros(1)
    smallest = lengths[-1] if lengths else capacity + 1
    found: list[tuple[int, tuple[int, ...]]] = []
    stack: list[tuple[int, int, tuple[int, ...]]] = [(0, room, ())]
    steps = 0
    while stack and steps < STEPS and len(found) < CHOICES:
        k, left, chosen = stack.pop()
        steps += 1
        while k < len(lengths) and lengths[k] > left:
            k += 1
        if left - int(below[k]) > waste:
            continue
        if k == len(lengths) or left < smallest:
            if left <= waste and _maximal(have, chosen, left):
                found.append((left, chosen))
                if not left and len(chosen) <= 1:
                    break
            continue
        length = lengths[k]
        most = min(int(have[length]), left // length)
        # The last pushed is tried first: as many of the largest as there is room for.
        for n in range(0, most + 1):
            stack.append((k + 1, left - n * length, (*chosen, *([length] * n))))
    found.sort(key=lambda f: (f[0], len(f[1])))
    kept: list[tuple[int, ...]] = []
    for _, pieces in found:
        if not any(dominates(other, pieces) for other in kept):
            kept.append(pieces)
    return [_filling([largest, *pieces]) for pieces in kept]


def _maximal(have: np.ndarray, chosen: Sequence[int], left: int) -> bool:
    """Whether no piece left over fits into the room left."""
    spare = have[: left + 1].copy()
    for x in chosen:
        if x <= left:
            spare[x] -= 1
    return not spare.any()


def _filling(pieces: Sequence[int]) -> Filling:
    return tuple(sorted(Counter(pieces).items(), reverse=True))


def fillings(histogram: dict[int, int], capacity: int, effort: int = EFFORT) -> Packing:
    """As few sequences as the search finds for pieces counted by length."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if length is None or not 1 <= length <= capacity:
            raise ValueError(f"a piece of length {length} does not fit into {capacity}")
        counts[length] = n
    best = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    fewest = sum(times for _, times in best)
    # Frames of the path: moves left to try, the move made, and the sequences used by then.
    path: list[list] = []
    used, nodes = 0, 0

    def moves() -> Iterator[tuple[Filling, int]]:
        total = int((counts * np.arange(capacity + 1)).sum())
        # Waste that the rest may make and still beat the incumbent by one sequence.
        waste = (fewest - 1 - used) * capacity - total
        largest = int(np.flatnonzero(counts)[-1])
        options = [(f, min(int(counts[x]) // n for x, n in f)) for f in completions(counts, capacity, largest, min(waste, capacity))]
        yield from options
        yield from ((f, 1) for f, times in options if times > 1)

    def apply(move: tuple[Filling, int], sign: int) -> None:
        for x, n in move[0]:
            counts[x] -= sign * n * move[1]

    if fewest > bound:
        path.append([moves(), None, 0])
    while path and nodes < effort and fewest > bound:
        frame = path[-1]
        if frame[1] is not None:
            apply(frame[1], -1)
            frame[1] = None
        used = frame[2]
        move = next(frame[0], None)
        if move is None:
            path.pop()
            continue
        nodes += 1
        apply(move, 1)
        frame[1] = move
        used += move[1]
        if not counts.any():
            if used < fewest:
                fewest, best = used, [f[1] for f in path]
        elif used + lower_bound(counts, capacity) < fewest:
            path.append([moves(), None, used])
    return Packing(best, bound)


def pack(df: DataFrame, length: str, keys: Sequence[str], capacity: int = 4096, sequence: str = "sequence_id", offset: str = "offset") -> DataFrame:
    """``df`` with a sequence number and an offset in it for every row, a piece of the given length.

    Rows of equal length take places in the order of ``keys``. ``df`` is read twice,
    so it should be a stored table.
    """
    kept = without(df, sequence, offset)
    table, parts = ordered(kept.withColumn("__length", F.col(f"`{length}`").cast("long")), [F.col("__length"), *(F.col(f"`{k}`") for k in keys)], "pieces")
    # At most one row a length.
    histogram = {r[0]: r[1] for r in table.groupBy("__length").count().collect()}
    packing = fillings(histogram, capacity)
    ranked = table.join(parts.select("__part", "__before"), "__part").withColumn("__rank", F.col("__before") + F.col("__at") - 1)
    shared = df.sparkSession.sparkContext.broadcast(places(histogram, packing))
    names = [*kept.columns, sequence, offset]
    source = ranked.select(*(f"`{c}`" for c in kept.columns), "__length", "__rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, lengths, per, sequences, offsets = shared.value
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(first, rank, "right") - 1
            turn = rank - first[at]
            placed = [sequences[at] + turn // per[at], offsets[at] + turn % per[at] * lengths[at]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *(pa.array(p, pa.int64()) for p in placed)], names=names)

    return source.mapInArrow(run, StructType([*kept.schema.fields, StructField(sequence, LongType()), StructField(offset, LongType())]))


def places(histogram: dict[int, int], packing: Packing) -> tuple[np.ndarray, ...]:
    """Runs of ranks (pieces by length ascending, from 0): first rank, length, pieces a sequence, first sequence, offset."""
    next_rank, at = {}, 0
    for x in sorted(histogram):
        next_rank[x], at = at, at + histogram[x]
    runs, sequence = [], 0
    for filling, times in packing.fillings:
        offset = 0
        for x, n in filling:
            runs.append((next_rank[x], x, n, sequence, offset))
            next_rank[x] += n * times
            offset += n * x
        sequence += times
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return tuple(table[:, k].copy() for k in range(5))


class Words:
    """Ids of texts by the tokenizers library, which sees each distinct word of a block once.

    White space is dropped by the tokenizer and never inside a token, so the ids of
    a text are those of its words. A text of Latin letters, which no normal form
    changes, without a special token's mark is lower-cased and split further, as the
    tokenizer itself does.
    """

    def __init__(self, file: str):
        # The cores belong to Spark's tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(file)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.letters = {b: c for b, c in enumerate(byte_letters()) if chr(b) != c}
        self.packed = [k.to_bytes(4, "little") for k in range(self.library.get_vocab_size())]
        self.ids: dict[str, bytes] = {}
        self.held = 0

    def split(self, text: str) -> tuple[bool, list[str]]:
        """Whether the words are such that BPE applies to each as it is, and the words."""
        if "<|" not in text:
            lower = text.lower()
            if text.isascii():
                return True, ASCII_SPLIT.findall(lower)
            if not BEYOND.search(text) and not BEYOND.search(lower):
                return True, PLAIN_SPLIT.findall(lower)
        return False, WHITE.findall(text)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers of each text."""
        out = []
        for start, stop in _blocks([len(x) for x in texts], BLOCK):
            split = [self.split(x) for x in texts[start:stop]]
            if self.held > MEMORY:
                self.ids, self.held = {}, 0
            for plain, learn in ((True, self.learn), (False, self.learn_whole)):
                learn(list(set().union(*(words for kind, words in split if kind is plain)) - self.ids.keys()))
            out.extend(b"".join(map(self.ids.__getitem__, words)) for _, words in split)
        return out

    def learn(self, words: list[str]) -> None:
        """Encode words that the tokenizer neither changes nor splits, by its model alone."""
        tokenize, packed = self.model.tokenize, self.packed
        for word in words:
            spelled = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([packed[t.id] for t in tokenize(spelled)])
            self.ids[word] = ids
            self.held += len(word) + len(ids) + OVERHEAD

    def learn_whole(self, words: list[str]) -> None:
        """Encode many words as one text; a token belongs to the word that its first character stands in."""
        for start, stop in _blocks([len(w) + 1 for w in words], BLOCK):
            part = words[start:stop]
            done = self.library.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(done.ids, "<u4")
            starts = np.array([a for a, _ in done.offsets], np.int64)
            begin = np.cumsum([0, *(len(w) + 1 for w in part[:-1])])
            edges = np.searchsorted(starts, np.append(begin, begin[-1] + len(part[-1]) + 1)).tolist()
            packed = ids.tobytes()
            for k, word in enumerate(part):
                self.ids[word] = packed[4 * edges[k] : 4 * edges[k + 1]]
                self.held += len(word) + 4 * (edges[k + 1] - edges[k]) + OVERHEAD


def _blocks(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to ``limit`` at most, or of one."""
    start, held = 0, 0
    for k, size in enumerate(sizes):
        if k > start and held + size > limit:
            yield start, k
            start, held = k, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def token_pieces(df: DataFrame, path: str, text: str = "text", end: int = 1, capacity: int = 4096) -> DataFrame:
    """One row for each piece of each text's ids, closed by the id ``end`` and cut every ``capacity``.

    Adds ``piece`` (from 0), ``start`` (ids before it) and ``ids`` (a binary of
    little-endian unsigned 32-bit integers) to the columns other than the text.
    """
    with open(path, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    kept = without(df, text, "piece", "start", "ids")
    source = df.select(*(F.col(f"`{c}`") for c in kept.columns), F.col(f"`{text}`").cast("string").alias("__text"))
    names = [*kept.columns, "piece", "start", "ids"]
    last = np.array([end], "<u4").tobytes()
    size = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            texts = [x or "" for x in column.to_pylist()]
            for start, stop in _blocks([len(x) for x in texts], BLOCK):
                rows, piece, body = [], [], []
                for k, ids in enumerate(words.encode(texts[start:stop])):
                    ids += last
                    for n, at in enumerate(range(0, len(ids), size)):
                        rows.append(k)
                        piece.append(n)
                        body.append(ids[at : at + size])
                part = batch.slice(start, stop - start).take(pa.array(rows, pa.int64()))
                added = [pa.array(piece, pa.int32()), pa.array(np.array(piece, np.int64) * capacity), pa.array(body, pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *added], names=names)

    added = [StructField("piece", IntegerType()), StructField("start", LongType()), StructField("ids", BinaryType())]
    return source.mapInArrow(run, StructType([*kept.schema.fields, *added]))


def sequences(placed: DataFrame, ids: str = "ids", sequence: str = "sequence_id", offset: str = "offset") -> DataFrame:
    """The ids of every sequence, its pieces joined in the order of their offsets: a group is one sequence, of bounded size."""
    pieces = F.sort_array(F.collect_list(F.struct(F.col(f"`{offset}`").alias("o"), F.col(f"`{ids}`").alias("i"))))
    joined = F.aggregate(pieces, F.lit(b""), lambda whole, p: F.concat(whole, p["i"]))
    return placed.groupBy(sequence).agg(joined.alias(ids))
