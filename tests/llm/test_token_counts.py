"""Edit-aware counts: equal to encoding the edited text from scratch."""
import random

import pytest
from tokenizers import Tokenizer

from gridtel.llm import bpe, token_counts
from gridtel.llm.queries import byte_bpe_path, stand_in_edits

PARTS = ["", " ", "  \n x", "'re", " 'll", "a", "1 2", "é", "\n\n\n   ", "'", "don't", "   ", "word ", "<|endoftext|>", "日本"]


@pytest.fixture(scope="module")
def counter():
    return token_counts.counter_for(bpe.vocabulary(byte_bpe_path()))


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(byte_bpe_path())
    t.encode_special_tokens = True
    return t


def edited(text, pos, n_del, ins):
    pos = min(max(pos, 0), len(text))
    return text[:pos] + ins + text[min(pos + max(n_del, 0), len(text)):]


def tree_of(counter, text):
    pieces = counter.split(text)
    return token_counts.TokenTree(text, list(map(len, pieces)), [counter[p] for p in pieces], counter)


@pytest.mark.parametrize("seed", range(6))
def test_random_edits(counter, library, seed):
    rnd = random.Random(seed)
    for size in (0, 1, 5, 60, 900):
        text = "".join(rnd.choice(PARTS) for _ in range(size))
        tree = tree_of(counter, text)
        for _ in range(25):
            pos, n_del, ins = rnd.randrange(len(text) + 1), rnd.choice([0, 0, 1, 2, 5, 40]), rnd.choice(PARTS)
            tree.edit(pos, n_del, ins)
            text = edited(text, pos, n_del, ins)
            assert tree.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        new_text, lens, counts = tree.state()
        assert new_text == text
        assert list(lens) == list(map(len, counter.split(text))) and list(counts) == [counter[p] for p in counter.split(text)]


def test_an_edit_touches_its_surroundings_only(counter):
    tree = tree_of(counter, "some words of plain prose, again and again. " * 500)
    assert tree.edit(9000, 2, "xy") <= 4


def test_rows(spark, library):
    edits = [{"pos": 3, "n_del": 1, "ins": "Q q"}, None, {"pos": 99, "n_del": None, "ins": None}, {"pos": None, "n_del": 4, "ins": "!"}]
    rows = [(1, "the cat", edits, "x"), (1, "the cat", edits, "x"), (2, None, [{"pos": -4, "n_del": 2, "ins": "new"}], "x"),
            (None, "kept as it is", None, None), (3, "", [], "y")]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, edits {token_counts.EDIT_TYPE}, lens string")
    out = token_counts.apply_edits(token_counts.token_trees(docs, byte_bpe_path()), byte_bpe_path()).collect()
    assert sorted(r["text"] for r in out) == sorted(["theQ qcat!", "theQ qcat!", "new", "kept as it is", ""])
    for r in out:
        assert r["n_tokens"] == len(library.encode(r["text"], add_special_tokens=False).ids)
    assert token_counts.token_trees(docs.limit(0), byte_bpe_path()).count() == 0


def test_log_joins_in_order(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "x")], "doc_id long, text string")
    log = spark.createDataFrame([(1, 2, 0, 1, "B"), (1, 1, 0, 1, "AA")], "doc_id long, seq long, pos long, n_del long, ins string")
    trees = token_counts.token_trees(token_counts.attach_edits(docs, log), byte_bpe_path())
    got = {r["doc_id"]: r["text"] for r in token_counts.apply_edits(trees, byte_bpe_path()).collect()}
    assert got == {1: "BAbc", 2: "x"}


def test_whole_table(spark, library):
    docs = stand_in_edits(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    out = token_counts.apply_edits(token_counts.token_trees(docs, byte_bpe_path()), byte_bpe_path())
    before = {r["doc_id"]: r for r in docs.collect()}
    for r in out.collect():
        text = before[r["doc_id"]]["text"]
        assert r["n_tokens_before"] == len(library.encode(text, add_special_tokens=False).ids)
        for e in before[r["doc_id"]]["edits"]:
            text = edited(text, e["pos"], e["n_del"], e["ins"])
        assert r["text"] == text and r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
