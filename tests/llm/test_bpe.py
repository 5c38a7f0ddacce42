"""Encoding against the tokenizers library: whole, in halves of any size, and through the tables."""

import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from tokenizers import Tokenizer

from adledger.llm import bpe
from adledger.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
ALPHABETS = ["ab", "a", "aA '", "abcé ", "中文\U0001f600 ", "  \n\t.", "'srevdlmt ", "0123 ", "ethion ", "==-_#*"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokenizer_path(), "rb") as f:
        return bpe.Vocabulary(f.read())


def test_joined_halves_are_the_whole(library, vocabulary):
    rnd = random.Random(11)
    for _ in range(700):
        text = "".join(rnd.choice(rnd.choice(ALPHABETS)) if rnd.random() < 0.2 else rnd.choice(ALPHABETS[rnd.randrange(3)]) for _ in range(rnd.randrange(1, 300)))
        if rnd.random() < 0.4:
            text = text.replace("'", "<|endoftext|>") + "<|endoftext|>" * rnd.randrange(3) + text[:3]
        part = bpe.join_tree([bpe.Part.of(h, vocabulary) for h in bpe.halves(text, rnd.choice([1, 2, 5, 40]))], vocabulary)
        assert part.ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert np.array_equal(part.cuts, bpe.Part.of(text, vocabulary).cuts)


@pytest.mark.parametrize("letters", ["a", "ab", "etaoinshr", " ", "\n", "é", "!", "1", "中"])
def test_long_unsplit_texts(library, vocabulary, letters):
    rnd = random.Random(7)
    text = "".join(rnd.choice(letters) for _ in range(60_000))
    part = bpe.join_tree([bpe.Part.of(h, vocabulary) for h in bpe.halves(text, 4000)], vocabulary)
    assert part.ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_vocabularies_that_the_method_does_not_fit_are_refused():
    with open(tokenizer_path("word_bpe_49k.json"), "rb") as f, pytest.raises((ValueError, KeyError)):
        bpe.Vocabulary(f.read())


def test_a_vocabulary_is_refused_before_anything_is_encoded(docs_of):
    with pytest.raises((ValueError, KeyError)):
        bpe.encode(docs_of([(1, "a")]), tokenizer_path("word_bpe_49k.json"))


def test_the_driver_does_not_take_the_vocabulary_apart(docs_of):
    docs = docs_of([(1, "a")])
    tracemalloc.start()
    try:
        bpe.encode(docs, tokenizer_path())
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert most < 8 << 20, most  # its file has 1.5 MB


def check(rows, texts, library):
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(docs_of, library):
    texts = {1: "", 2: None, 3: "x<|endoftext|>y", 4: "q" * 20_000, 5: "word é " * 4000 + "<|endoftext|>" + "z " * 900, 6: " \n "}
    rows = bpe.decode(bpe.encode(docs_of([*texts.items(), (6, " \n "), (None, "a")]), tokenizer_path(), leaf_chars=1000), tokenizer_path()).collect()
    assert len(rows) == 8
    for r in rows:
        text = "a" if r.doc_id is None else texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert r.decoded == text
    assert bpe.encode(docs_of([(1, "a")]).filter("doc_id > 1"), tokenizer_path()).count() == 0


def test_op1_against_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op1_bpe_encoding"](spark, SF).collect()
    assert len(rows) == len(texts)
    check(rows, texts, library)
