"""BPE: the library's own encoding is the truth; decoding is an exact round trip."""
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from gridtel.llm import bpe
from gridtel.llm.queries import byte_bpe_path

ODD = ["", " ", "a", "a" * 3000, "ab" * 700, "  \n\n  x", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "日本語テキスト𠀀",
       "ՙ՘x", "\x00\x01", "don't we'll 'tis 'RE", " " * 50 + "x", "é" * 77, "💥👩‍👩‍👧", "1" * 333, "​  x", "=-" * 100,
       "\r\n\r\n\t x ", "꭬x ꟒", "Ġġ", "ﷺ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(byte_bpe_path())


@pytest.fixture(scope="module")
def encoder():
    return bpe.PrefixEncoder(bpe.vocabulary(byte_bpe_path()))


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(encoder, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text) == ids
    assert encoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False) == text


def test_random_texts(encoder, library):
    rnd = random.Random(3)
    alphabet = "aaabbethinro  \n'.,19éß日\U0001f600"
    for _ in range(300):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60)))
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_pairs_agree_with_the_library(encoder, library):
    rnd = random.Random(4)
    for _ in range(2000):
        a, b = rnd.randrange(50256), rnd.randrange(50256)
        whole = encoder.token_bytes[a] + encoder.token_bytes[b]
        expected = encoder.encode_piece(whole) == [a, b]
        if encoder._reachable(a) and encoder._reachable(b):
            assert encoder.compatible(a, b) == expected


def test_small_cache_changes_nothing(library):
    small = bpe.PrefixEncoder(bpe.vocabulary(byte_bpe_path()), cache_pieces=3)
    text = "the cat and the dog and the bird " * 5
    assert small.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_rows(spark, library):
    rows = [(1, "the cat", "x", 9), (1, "the cat", "x", 9), (2, None, None, None), (None, "é <|endoftext|>", "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    out = bpe.round_trip(docs, byte_bpe_path()).collect()
    assert sorted(map(str, out)) == sorted(map(str, bpe.decode(bpe.encode(docs, byte_bpe_path()), byte_bpe_path()).collect()))
    assert sorted(((r["doc_id"] or 0, r["text"]) for r in out)) == sorted(((i or 0, t or "") for i, t, _, _ in rows))
    for r in out:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
    assert bpe.encode(docs.limit(0), byte_bpe_path()).count() == 0


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in bpe.encode(docs, byte_bpe_path()).collect()}
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert bytes(got[r["doc_id"]]["ids"]) == np.array(ids, "<u4").tobytes()
