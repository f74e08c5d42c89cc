"""Scoring texts with an n-gram model of the corpus that lives in Elias-Fano tries.

``score(df, training)`` learns a word pair model from the rows where ``training``
holds and scores the whole text of every row: n_tokens, n_known, train_tokens,
base_score, score.

A text's tokens are its words (A-Z lower-cased) and one end, behind which the
next text begins. A pair's probability is the discounted one of the pair plus the
back-off mass of its first word times that of the second word alone,
(c + 1) / (N + V + 1) with c its count, N all tokens and V the distinct ones of
the training rows. base_score uses the latter only. Words are known by a
64-bit hash, the second one of a pair by 48 bits of it.

How it is spread out. Rows are dealt to chunks of about CHUNK bytes of text by a
hash of the row. A chunk sends, to every shard, the shard's distinct words and
pairs in it (a pair belongs to the shard of its first word) with their counts in
training rows: a word or pair that is very common costs one entry a chunk. A
shard sums the counts of all chunks, builds its trie, and answers each chunk in
the order it asked in: the count and back-off of every word, the probability of
every pair. The chunk, made again from the same rows, adds these up per text. What
is gathered is the statistics of the whole corpus; no task holds more than one
chunk, or one shard of the statistics; the number of either grows with the
input. A trie is one string of bytes whose levels numpy maps without copying them;
no file is kept on a machine.

Defined cases: a null text is an empty one, which has one token, the end. Without
training rows N and V are 0 and every token has probability 1, base and model
alike (the scores are 0). Rows that repeat count as often as they occur. Columns other than the id
and the results are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbmart.llm.common import by_value, stored
from plumbmart.llm.eftrie import PROBABILITY, Trie
from plumbmart.llm.words import bytes_of, word_hashes

by_value(__name__)

#: Bytes of text in a chunk, on average.
CHUNK = 12_000_000
#: Chunks for each shard of the statistics.
CHUNKS_A_SHARD = 2
#: Second words of a pair travel as so many bytes of their hash.
SHORT = 6
#: The hash that stands for the end of a text, and for what is before its first word.
END = np.uint64(0)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token, number of text) of every token of every text, ends included; before each is the one to its left."""
    data, offsets = bytes_of(texts)
    words, row = word_hashes(data, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1)
    tokens = np.full(len(words) + len(n), END)
    tokens[np.arange(len(words)) + row] = words
    return tokens, np.repeat(np.arange(len(n)), n + 1)


def shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    return (words % np.uint64(shards)).astype(np.int64)


def pair_order(token: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, number of the pair that ends at each token, words): words by shard and hash, distinct pairs by those of their words."""
    words, code = np.unique(np.concatenate([[END], token]), return_inverse=True)
    shard = shard_of(words, shards)
    # Ranks of words in the order of (shard, hash), so one number orders the pairs.
    order = np.lexsort((words, shard))
    rank = np.empty(len(words), np.uint64)
    rank[order] = np.arange(len(words), dtype=np.uint64)
    # The token before is the one to the left, and before the first it is an end.
    key = rank[code[:-1]] << np.uint64(32) | rank[code[1:]]
    pairs, number = np.unique(key, return_inverse=True)
    return pairs, number, words[order]


def shortened(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT]).tobytes()


def lengthened(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // SHORT, 8), np.uint8)
    out[:, :SHORT] = np.frombuffer(data, np.uint8).reshape(-1, SHORT)
    return out.view("<u8").ravel()


def small(counts: np.ndarray) -> bytes:
    """Counts as one byte each, those of 255 and more again behind."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<u4").tobytes()


def large(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u4", offset=n)
    return out


def requests(texts: pa.Array, training: np.ndarray, shards: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes, bytes]]:
    """For each shard: words, their training counts, pairs of each word, second words, training counts of pairs."""
    token, row = tokens_of(texts)
    pairs, number, words = pair_order(token, shards)
    taught = training[row]
    n_pairs = np.bincount(number[taught], minlength=len(pairs)).astype("<u4")
    first, second = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n_words = np.bincount(second, n_pairs, len(words)).astype("<u4")
    per_word = np.bincount(first, minlength=len(words)).astype("<u4")
    shard = shard_of(words, shards)
    edges = np.searchsorted(shard, np.arange(shards + 1))
    ends = np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])
    for s in range(shards):
        a, b = edges[s], edges[s + 1]
        if a < b:
            p, q = ends[a], ends[b]
            yield s, words[a:b].tobytes(), small(n_words[a:b]), small(per_word[a:b]), shortened(words[second[p:q]]), small(n_pairs[p:q])


def ask(docs: DataFrame, shards: int) -> DataFrame:
    """The requests of all chunks: (shard, chunk, words, n_words, per_word, seconds, n_pairs)."""
    names = ("shard", "chunk", "words", "n_words", "per_word", "seconds", "n_pairs")

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        rows = list(requests(table.column("text").combine_chunks(), table.column("training").to_numpy(), shards))
        columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int32())]
        return pa.Table.from_arrays([*columns, *(pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 6))], names=list(names))

    return docs.groupBy("chunk").applyInArrow(run, "shard int, chunk int, words binary, n_words binary, per_word binary, seconds binary, n_pairs binary")


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def answered(table: pa.Table) -> pa.Table:
    """The answers of one shard to all chunks, and in a row of their own (chunk -1) its totals."""
    read = lambda name: table.column(name).to_pylist()
    words = [np.frombuffer(x, "<u8") for x in read("words")]
    n_words, per_word = ([large(x, len(w)) for x, w in zip(read(name), words, strict=True)] for name in ("n_words", "per_word"))
    seconds = [lengthened(x) for x in read("seconds")]
    n_pairs = [large(x, len(s)) for x, s in zip(read("n_pairs"), seconds, strict=True)]
    known, count = summed(np.concatenate(words), np.concatenate(n_words))
    # Pairs as (number of the first word, second word), sorted.
    first = np.concatenate([np.repeat(np.searchsorted(known, w), p) for w, p in zip(words, per_word, strict=True)])
    second, n = np.concatenate(seconds), np.concatenate(n_pairs)
    taught = n > 0
    first, second, n = first[taught], second[taught], n[taught]
    order = np.lexsort((second, first))
    first, second, n = first[order], second[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])) if len(n) else np.zeros(0, np.int64)
    trie = Trie.map(Trie.build(known[first[new]], second[new], np.add.reduceat(n, new) if len(new) else n).to_bytes())
    search = trie.lookup()
    rows = [
        (count[np.searchsorted(known, w)].astype("<u4").tobytes(), trie.backoffs(w).tobytes(), search.codes(np.repeat(w, p), s).tobytes())
        for w, p, s in zip(words, per_word, seconds, strict=True)
    ]
    shard, chunks = table.column("shard")[0].as_py(), table.column("chunk").to_pylist()
    columns = [pa.array([shard] * (len(rows) + 1), pa.int32()), pa.array([*chunks, -1], pa.int32())]
    columns += [pa.array([*(r[k] for r in rows), None], pa.binary()) for k in range(3)]
    columns += [pa.array([None] * len(rows) + [x], pa.int64()) for x in (int(count.sum()), int((count > 0).sum()))]
    return pa.Table.from_arrays(columns, names=["shard", "chunk", "counts", "backoffs", "pairs", "tokens", "distinct"])


ANSWER = "shard int, chunk int, counts binary, backoffs binary, pairs binary, tokens long, distinct long"


def texts_scored(docs: pa.Table, answers: pa.Table, shards: int, total: int, distinct: int, key: str) -> pa.Table:
    """The results of one chunk."""
    texts = docs.column("text").combine_chunks()
    token, row = tokens_of(texts)
    pairs, number, words = pair_order(token, shards)
    at = {s: k for k, s in enumerate(answers.column("shard").to_pylist())}
    order = [at[s] for s in sorted(at)]
    joined = lambda name, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(answers.column(name)[k].as_py(), kind) for k in order)])
    count, backoff, pair = joined("counts", "<u4").astype(np.int64), PROBABILITY[joined("backoffs", "u1")], PROBABILITY[joined("pairs", "u1")]
    alone = (count + 1) / (total + distinct + 1)
    first, second = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    model = np.log10(np.minimum(pair + backoff[first] * alone[second], 1.0))
    base = np.log10(alone)
    rows = docs.num_rows
    sums = lambda values: np.bincount(row, values, rows)
    columns = {
        key: docs.column(key), "training": docs.column("training"), "n_tokens": pa.array(np.bincount(row, minlength=rows)), "n_known": pa.array(sums(count[second][number] > 0).astype(np.int64)),
        "train_tokens": pa.array(np.full(rows, total, np.int64)), "base_score": pa.array(sums(base[second][number])), "score": pa.array(sums(model[number])),
    }
    return pa.table(columns)


def chunked(df: DataFrame, training: Column, key: str, text: str, chunks: int) -> DataFrame:
    words = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    dealt = F.pmod(F.xxhash64(F.col(f"`{key}`"), words), F.lit(chunks)).cast("int")
    return df.select(F.col(f"`{key}`").alias(key), words.alias("text"), F.coalesce(training, F.lit(False)).alias("training"), dealt.alias("chunk"))


def score(df: DataFrame, training: Column, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(key, training, n_tokens, n_known, train_tokens, base_score, score) of every row of ``df``."""
    size = df.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    chunks = max(1, -(-size // chunk))
    shards = max(1, -(-chunks // CHUNKS_A_SHARD))
    docs = chunked(df, training, key, text, chunks)
    asked = ask(docs, shards)
    answers = stored(asked.groupBy("shard").applyInArrow(answered, ANSWER), "answers")
    totals = answers.where("chunk = -1").agg(F.sum("tokens"), F.sum("distinct")).first()
    total, distinct = totals[0] or 0, totals[1] or 0
    replies = answers.where("chunk >= 0").select("chunk", "shard", "counts", "backoffs", "pairs")

    def run(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return texts_scored(left, right, shards, total, distinct, key)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return docs.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, schema)
