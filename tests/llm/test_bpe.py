"""BPE against the tokenizers library, text by text."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from plumbmart.llm import bpe, queries

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def model():
    return bpe.Model(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def odd_texts():
    rng = random.Random(5)
    letters = "abeinorst'éßΣİſǅ가각가ิ้日本🙂 \n\t\x85\x1c -_<|>%0129½²"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    texts += ["".join(rng.choice("abcst") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    texts += ["a" * n for n in range(1, 70)] + ["!?" * n + "." * n for n in range(1, 40)]
    texts += ["<|endoftext|>", "x<|startoftext|><|endoftext|>Y's", "<|endoftext", "a <|ENDOFTEXT|> b", "it's WE'LL 'Tis o'd"]
    return texts + ["", "   ", "Ᲊa՘b", "É" * 500, "ẹ́ ö"]


def test_texts_as_the_library(model, library):
    texts = odd_texts()
    for text, got in zip(texts, bpe.Encoder(model).encode(texts), strict=True):
        assert got == expected(library, text), repr(text)


def test_every_code_point(model, library):
    points = [c for c in map(chr, range(1, 0x30000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["".join(f"a{c}b {c} " for c in points[k : k + 64]) for k in range(0, len(points), 64)]
    for text, got in zip(texts, bpe.Encoder(model).encode(texts), strict=True):
        assert got == expected(library, text), hex(ord(text[1]))


def test_memories_are_bounded_and_decoding_is_optional(library, monkeypatch):
    monkeypatch.setattr(bpe, "EDGES", 500)
    monkeypatch.setattr(bpe, "MEMORY", 20_000)
    monkeypatch.setattr(bpe, "BLOCK", 2_000)
    small = bpe.Model(PATH)
    encoder = bpe.Encoder(small, decode=False)
    texts = odd_texts()
    for text in texts:
        assert encoder.encode([text]) == [(expected(library, text)[0], "")], repr(text)
        assert encoder.held < 20_000 + 400 * len(text) + 1_000
        assert small.completed < 500 + 100 * (len(text) + 10)
    assert not encoder.decoded.keys() - small.special.keys()


def test_long_texts_are_cut_before_white_space(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 50)
    monkeypatch.setattr(bpe, "MEMORY", 20)
    monkeypatch.setattr(bpe, "LONG_WORD", 15)
    texts = [*odd_texts(), "the quick brown foxes jump over the lazy dogs' 123 tails " * 40, "x" * 400 + " y"]
    for text, got in zip(texts, bpe.Encoder(model).encode(texts), strict=True):
        assert got == expected(library, text), repr(text)


def test_frame_with_nulls_repeats_and_clashing_names(spark, model, library):
    rows = [(1, "The cat", "old"), (1, "The cat", "old"), (None, None, "n"), (3, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, DECODED string")
    out = bpe.encode_decode(df, model)
    assert out.columns == ["doc_id", "text", "token_ids", "decoded"]
    got = sorted(((r.text, list(r.token_ids), r.decoded) for r in out.collect()), key=str)
    want = library.encode("The cat", add_special_tokens=False).ids
    assert got == sorted([("The cat", want, "the</w> cat</w>")] * 2 + [(None, [], ""), ("", [], "")], key=str)
    assert bpe.encode_decode(df.limit(0), model).count() == 0


def test_query_as_the_library_over_all_documents(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op1_bpe_encoding(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, decoded = expected(library, d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
