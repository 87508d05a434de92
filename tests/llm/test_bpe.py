import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.edges import documents, edge_texts
from urbanlake.llm import bpe
from urbanlake.llm.tokens import CachedEncoder, tokenizer_json

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return tokenizer_json(PATH)


TEXTS = edge_texts() + [
    "a" * 5000, "é" * 3000, "12345" * 900, "!?" * 1500, "don't we'll they've it's", "a  b\n\n c\t d   ", "x y　 z　  w",
    "one<|endoftext|>two <|endoftext|> three<|endo", "<|endoftext|>" * 400, "abc123def" * 500 + " tail", " " * 900, "\n" * 500 + "x",
    "ab" * 800 + "<|endoftext|>" + "ba" * 800, "日本語のテキスト" * 300, "é combining" * 40, "ſtrange ﬁ ligature",
]


@pytest.mark.parametrize("leaf", [64, bpe.LEAF])
def test_equals_the_tokenizer(spark, vocabulary, leaf):
    tokenizer = Tokenizer.from_file(PATH)
    encoded = bpe.encode(documents(spark, TEXTS), vocabulary, leaf=leaf, round_trip=True)
    got = bpe.decode(encoded.withColumnRenamed("decoded", "there"), vocabulary).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        ids = tokenizer.encode(TEXTS[r.doc_id - 1] or "", add_special_tokens=False).ids
        assert r.ids == ids, r.doc_id
        assert r.decoded == r.there == tokenizer.decode(ids, skip_special_tokens=False)


#: White space of two pre-tokens where a leaf may end.
BLANK_LINES = [
    "a\n\n" + "=" * 70_000, "Hello world!\n\n" + "=" * 70_000 + "\n\n" + "-" * 70_000, "\n\n" + "é" * 40_000, "。\r\n\r\n" + "=" * 70_000,
    ("日本語のテキストです。" * 7 + "\n\n") * 900, ("中文。\n \n\t\n" + "字" * 29) * 2500, ("!\u2003\u2003\n" * 9 + "?" * 40) * 900, "= \n" * 200 + "<|endoftext|>" + "!\n\n" * 30_000,
]


@pytest.mark.parametrize("leaf", [64, bpe.LEAF])
def test_blank_lines_at_the_end_of_a_leaf(vocabulary, leaf):
    tree, tokenizer = bpe.TreeEncoder(vocabulary, leaf), Tokenizer.from_file(PATH)
    for nth, text in enumerate(BLANK_LINES):
        leaves = list(tree.leaves(text))
        ids = tree.joined([g for g, _ in leaves], tree.encode_leaves(leaves))
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, nth


def test_digest_column_and_empty_table(spark, vocabulary):
    got = bpe.encode(documents(spark, ["to be"]), vocabulary).select(bpe.joined_ids(bpe.F.col("ids")).alias("j")).first()
    ids = Tokenizer.from_file(PATH).encode("to be", add_special_tokens=False).ids
    assert hashlib.sha256(got.j.encode()).digest() == hashlib.sha256(",".join(map(str, ids)).encode()).digest()
    assert bpe.encode(documents(spark, []), vocabulary).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abeinortsh", min_size=2, max_size=400), st.integers(1, 60))
def test_halves_of_one_word_join_exactly(text, size):
    tree = test_halves_of_one_word_join_exactly.tree
    halves = [tree.raw(text[i : i + size]) for i in range(0, len(text), size)]
    assert bpe.concatenate(halves, tree.text_of, tree.raw) == tree.raw(text)


test_halves_of_one_word_join_exactly.tree = bpe.TreeEncoder(tokenizer_json(PATH))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FFF, blacklist_categories=("Cs",)), max_size=60))
def test_cached_words_equal_the_tokenizer(text):
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        path = public_tokenizers.path(name)
        if name not in CACHE:
            CACHE[name] = CachedEncoder(tokenizer_json(path), spaced), Tokenizer.from_file(path)
        cached = CACHE[name]
        want = cached[1].encode(text, add_special_tokens=False).ids
        got = cached[0].encode([text])[0]
        assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == want


CACHE: dict = {}


def test_folded_words_outlive_the_bound():
    path = public_tokenizers.path("word_bpe_49k.json")
    cached, tokenizer, seen = CachedEncoder(tokenizer_json(path), spaced=False, limit=40), Tokenizer.from_file(path), []
    letters = cached._letters
    cached._letters = lambda parts: seen.extend(parts) or letters(parts)
    for i in range(60):
        rare = [f"{a}{b}Été" for a in "abc" for b in "xyzßÿ"]
        texts = [f"\tThe Straße|{rare[i % 15]}{'q' * i}.\n", "", " \r\n ", f"the--9 {'z' * i}!!", "l'été", "é" + "的"]
        want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in cached.encode(texts)] == want
        assert len(cached.known) + len(cached.older) < 80
    assert seen.count("the") == seen.count("straße") == 1
