"""BPE encoding and decoding by prefix-sharing trie traversal.

``encode_decode(df, model)`` adds the token ids and, if asked for, the decoded text of every row.

The method. In a BPE vocabulary whose tokens each come from one merge, the
encoding of a string is settled by the *last token* of each of its prefixes: the
last token of a prefix is the longest vocabulary token that ends there and may
stand behind the last token of what comes before it. So the distinct words of a
block of text go into a trie, a depth-first walk hands each node the last tokens
of its path, and a prefix that many words share is encoded once. A word's ids
are read back from its leaf. The last character of a word carries the end mark,
so leaves are edges of their own.

Two tokens L, R may be neighbours if no merge crosses their border while both
grow: the right edge of L and the left edge of R each pass through a chain of
tokens, and a merge of two edge tokens that are alive at its rank would cross.

Scale: rows are independent, so there is no shuffle. A task holds one block of
about a million characters (or one longer word), its trie, and two memories of
bounded size: words already encoded, counted in bytes, and completed edges of the
automaton. Lost tasks are simply run again.

Nulls and texts without tokens give empty ids and an empty decoded text. Rows
repeat as they come. An input column named like a result column is replaced.
Texts are processed whole, in pieces cut before white space, which no token
spans. Code points that are unassigned in this Python's Unicode tables are left
to the tokenizer file's own normaliser, as its tables may be newer.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from plumbmart.llm.common import by_value, without

by_value(__name__)

#: Characters of text handled at once; bytes of encoded words, and completed edges, kept between blocks.
BLOCK = 1_000_000
MEMORY = 48 << 20
EDGES = 300_000
#: What a kept word takes besides its letters, ids and decoded text.
OVERHEAD = 250
#: A longer word is encoded along one path instead of in the trie.
LONG_WORD = 1_000

# Fixed values of the file format: the split pattern, over lower-cased text.
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0D\x20a-z0-9]+")
SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Model:
    """Tables of a tokenizer file: tokens, merges, which tokens may be neighbours, and which end where.

    Tokens are numbers. The tokens that end a string are found by an automaton
    over all prefixes of tokens: ``ends[state]`` are the tokens that are suffixes
    of the string read so far, longest first.
    """

    END = "</w>"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.text = f.read()
        file = json.loads(self.text)
        model = file["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != self.END or file.get("decoder"):
            raise ValueError("the file must hold a BPE model with word ends and no decoder")
        vocab: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.count = 1 + max([*vocab.values(), *self.special.values()])
        self.string = [""] * self.count
        for t, k in vocab.items():
            self.string[k] = t
        #: Of each token the two it is merged from (itself twice if it is a symbol), and the rank of that merge.
        self.parts = [(k, k) for k in range(self.count)]
        self.born = [-1] * self.count
        self.rank: dict[int, int] = {}
        for k, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = vocab[a], vocab[b], vocab[a + b]
            if self.born[whole] >= 0 or max(self.born[a], self.born[b]) >= k:
                raise ValueError("every token must come from one merge of earlier tokens")
            self.parts[whole], self.born[whole], self.rank[a * self.count + b] = (a, b), k, k
        self.fits: dict[int, bool] = {}
        # A token that the merges never leave standing cannot be in an encoding.
        usable: set[int] = set()
        for t in sorted(vocab.values(), key=self.born.__getitem__):
            a, b = self.parts[t]
            if a == t or (a in usable and b in usable and not self.crosses(a, b, self.born[t])):
                usable.add(t)
        self.size = [len(t.removesuffix(self.END)) for t in self.string]
        self.build(usable)

    def symbols(self, token: int) -> list[str]:
        """Characters of a token; the end mark belongs to the last."""
        text = self.string[token]
        if not text.endswith(self.END) or text == self.END:
            return list(text)
        return [*text[: -len(self.END) - 1], text[-len(self.END) - 1 :]]

    def build(self, usable: set[int]) -> None:
        """The automaton: ``goto`` (completed as it is used), ``fail`` and ``ends`` of every state."""
        self.completed = 0
        self.goto: list[dict[str, int] | None] = [{}]
        own: list[int] = [-1]
        for t in sorted(usable):
            state = 0
            for c in self.symbols(t):
                if self.goto[state] is None:
                    self.goto[state] = {}
                edges = self.goto[state]
                if c not in edges:
                    edges[c] = len(self.goto)
                    self.goto.append(None)
                    own.append(-1)
                state = edges[c]
            own[state] = t
        self.fail = [0] * len(self.goto)
        self.ends: list[tuple[int, ...]] = [()] * len(self.goto)
        queue = [0]
        self.trie = [dict(e) if e else None for e in self.goto]
        for state in queue:
            for c, child in (self.trie[state] or {}).items():
                self.fail[child] = self.follow(self.fail[state], c) if state else 0
                below = self.ends[self.fail[child]]
                self.ends[child] = (own[child], *below) if own[child] >= 0 else below
                queue.append(child)

    def follow(self, state: int, c: str) -> int:
        """The next state, which is kept for the next time."""
        edges = self.goto[state]
        if edges is not None and c in edges:
            return edges[c]
        new = self.follow(self.fail[state], c) if state else 0
        if edges is None:
            edges = self.goto[state] = {}
        edges[c] = new
        self.completed += 1
        return new

    def forget(self) -> None:
        """Back to the edges of the trie, once many more were completed."""
        if self.completed > EDGES:
            self.goto = [dict(e) if e else None for e in self.trie]
            self.goto[0] = self.goto[0] or {}
            self.completed = 0

    def edge(self, token: int, side: int, limit: int) -> list[tuple[int, int]]:
        """The tokens at one edge of ``token`` as it grows, each with the rank that consumes it."""
        chain = [(token, limit)]
        while (part := self.parts[token][side]) != token:
            chain.append((part, self.born[token]))
            token = part
        return chain

    def crosses(self, left: int, right: int, limit: int) -> bool:
        """Whether a merge ranked below ``limit`` joins the two tokens across their border."""
        for a, a_ends in self.edge(left, 1, limit):
            for b, b_ends in self.edge(right, 0, limit):
                k = self.rank.get(a * self.count + b)
                # Of two equal merges the left one goes first: it wins against
                # b's own growth and loses against a's.
                if k is not None and k < a_ends and k < limit and k <= b_ends:
                    return True
        return False

    def neighbours(self, left: int, right: int) -> bool:
        if len(self.fits) > 500_000:
            self.fits.clear()
        fits = self.fits[left * self.count + right] = not self.crosses(left, right, 1 << 60)
        return fits

    def last_token(self, state: int, lasts: list[int]) -> int:
        """The last token of a prefix, from its state and the last tokens of the shorter prefixes."""
        depth = len(lasts) + 1
        for t in self.ends[state]:
            size = self.size[t]
            if size == depth:
                return t
            before = lasts[depth - size - 1]
            fits = self.fits.get(before * self.count + t)
            if fits or (fits is None and self.neighbours(before, t)):
                return t
        raise ValueError("the vocabulary lacks a byte")

    def read_back(self, token: int, lasts: list[int]) -> list[int]:
        """The tokens of a path, from its last token back to its first."""
        tokens, at = [token], len(lasts) + 1
        while at := at - self.size[token]:
            token = lasts[at - 1]
            tokens.append(token)
        tokens.reverse()
        return tokens

    def encode_words(self, words: list[tuple[str, str]]) -> Iterator[tuple[str, list[int]]]:
        """Pairs of a word and its tokens, for distinct words and their spelling in byte letters."""
        trie: dict = {}
        for w, word in words:
            if len(w) > LONG_WORD:
                lasts: list[int] = []
                state = 0
                for c in w[:-1]:
                    state = self.follow(state, c)
                    lasts.append(self.last_token(state, lasts))
                yield word, self.read_back(self.last_token(self.follow(state, w[-1] + self.END), lasts), lasts)
                continue
            node = trie
            for c in w[:-1]:
                child = node.get(c)
                if child is None:
                    child = node[c] = {}
                node = child
            node[w[-1] + self.END] = word
        lasts = []
        goto, follow, last_token = self.goto, self.follow, self.last_token
        stack = [(iter(trie.items()), 0)]
        while stack:
            edges, state = stack[-1]
            here = goto[state]
            for c, child in edges:
                below = here.get(c) if here else None
                if below is None:
                    below = follow(state, c)
                    here = goto[state]
                token = last_token(below, lasts)
                if child.__class__ is str:
                    yield child, self.read_back(token, lasts)
                else:
                    lasts.append(token)
                    stack.append((iter(child.items()), below))
                    break
            else:
                stack.pop()
                if stack:
                    lasts.pop()


class Encoder:
    """Encodes texts in blocks with one model; keeps words between blocks up to a bound."""

    def __init__(self, model: Model, decode: bool = True):
        self.model = model
        self.decode = decode
        self.held = 0
        self.letters = {b: c for b, c in enumerate(byte_letters()) if chr(b) != c}
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}
        self.packed = [k.to_bytes(4, "little") for k in range(model.count)]
        self.special = {s: np.uint32(i).tobytes() for s, i in model.special.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, model.special)) + ")") if model.special else None
        self.known: set[str] = set(map(chr, range(128)))
        self.library = None

    def words(self, text: str) -> list[str]:
        """The pieces of a text without special tokens that BPE is applied to."""
        if text.isascii():
            return ASCII_SPLIT.findall(text.lower())
        new = set(text) - self.known
        if any(unicodedata.category(c) == "Cn" for c in new):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_str(self.model.text)
            steps = self.library
            letter_byte = {c: b for b, c in enumerate(byte_letters())}
            pieces = steps.pre_tokenizer.pre_tokenize_str(steps.normalizer.normalize_str(text))
            return [bytes(letter_byte[c] for c in p).decode() for p, _ in pieces]
        self.known |= new
        # Lower case is per character here, so a final sigma is like any other.
        return SPLIT.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def pieces(self, text: str) -> Iterator[str]:
        """Cuts of a long text before white space."""
        start = 0
        while len(text) - start > BLOCK:
            cut = max(text.rfind(" ", start + 1, start + BLOCK), text.rfind("\n", start + 1, start + BLOCK))
            if cut <= start:
                found = re.compile(r"[ \n]").search(text, start + BLOCK)
                if not found:
                    break
                cut = found.start()
            yield text[start:cut]
            start = cut
        yield text[start:] if start else text

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text (empty if not asked for), of each text."""
        out: list[tuple[list[bytes], list[str]]] = [([], []) for _ in texts]
        block: list[tuple[int, list[str]]] = []
        size = 0
        for k, text in enumerate(texts):
            marked = self.special_split and "<|" in text
            for part in self.special_split.split(text) if marked else (text,):
                if marked and part in self.special:
                    block.append((k, [part]))
                    continue
                for piece in self.pieces(part):
                    if piece:
                        block.append((k, self.words(piece)))
                        size += len(piece)
                    if size >= BLOCK:
                        self.flush(block, out)
                        block, size = [], 0
        self.flush(block, out)
        return [(b"".join(i), " ".join(d)) for i, d in out]

    def flush(self, block: list[tuple[int, list[str]]], out: list[tuple[list[bytes], list[str]]]) -> None:
        self.model.forget()
        if self.held > MEMORY:
            self.ids, self.decoded, self.held = {}, {}, 0
        if not self.ids:
            self.ids.update(self.special)
            self.decoded.update({s: s for s in self.special})
        new = set().union(*(w for _, w in block)) - self.ids.keys()
        spelled = [(w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.letters), w) for w in new]
        packed, string = self.packed, self.model.string
        for word, tokens in self.model.encode_words(spelled):
            self.ids[word] = b"".join([packed[t] for t in tokens])
            self.held += len(word) + 4 * len(tokens) + OVERHEAD
            if self.decode:
                self.decoded[word] = " ".join([string[t] for t in tokens])
                self.held += len(self.decoded[word]) + OVERHEAD // 2
        for k, words in block:
            if words:
                out[k][0].append(b"".join(map(self.ids.__getitem__, words)))
                if self.decode:
                    out[k][1].append(" ".join(map(self.decoded.__getitem__, words)))


def encode_decode(
    df: DataFrame, model: Model, text: str = "text", ids: str = "token_ids", decoded: str | None = "decoded", packed: bool = False
) -> DataFrame:
    """``df`` with the ids and, unless ``decoded`` is None, the decoded text of every row.

    The ids are an array of integers or, where ``packed``, a binary of little-endian
    unsigned 32-bit integers. ``model`` is sent to the executors once; its size is
    that of the tokenizer file.
    """
    kept = without(df, ids, *([decoded] if decoded else []))
    shared = df.sparkSession.sparkContext.broadcast(model)
    source = kept.withColumn("__text", F.col(f"`{text}`").cast("string"))

    def results(done: list[tuple[bytes, str]]) -> list[pa.Array]:
        if packed:
            of_ids = pa.array([i for i, _ in done], pa.binary())
        else:
            ends = np.cumsum([0, *(len(i) // 4 for i, _ in done)], dtype="int32")
            of_ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(i for i, _ in done), "<i4")))
        return [of_ids, pa.array([d for _, d in done], pa.string())] if decoded else [of_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, bool(decoded))
        for batch in batches:
            at = batch.schema.get_field_index("__text")
            names = [*(n for n in batch.schema.names if n != "__text"), ids, *([decoded] if decoded else [])]
            sizes = [n or 0 for n in pc.binary_length(batch.column(at)).to_pylist()]
            start = 0
            while start < len(sizes):
                # Results are several times as long as texts: hand them on in parts.
                stop, held = start + 1, sizes[start]
                while stop < len(sizes) and held + sizes[stop] <= BLOCK:
                    held += sizes[stop]
                    stop += 1
                part = batch.slice(start, stop - start)
                done = encoder.encode([x or "" for x in part.column(at).to_pylist()])
                rest = [c for i, c in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, *results(done)], names=names)
                start = stop

    added = [StructField(ids, BinaryType() if packed else ArrayType(IntegerType())), *([StructField(decoded, StringType())] if decoded else [])]
    return source.mapInArrow(run, StructType([*kept.schema.fields, *added]))
