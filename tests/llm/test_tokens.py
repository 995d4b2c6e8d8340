"""Ids against the tokenizers library and against round trips."""

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftmill.llm.tokens import default_vocabulary, token_counts, token_ids, tokenizer

pytestmark = pytest.mark.skipif(not os.path.exists(default_vocabulary()), reason="no vocabulary here")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(default_vocabulary())
    made.encode_special_tokens = True
    return made


TEXTS = [
    "", " ", "a", "Hello  world!\r\n\tx", "<|endoftext|> is text", "aaaaaaaaaaaaaaaaaaaaaaa", "über naïve café 😀👨‍🔬 漢字かな नमस्ते",
    "I'll we've it's 123,456.789", "\x1c\x85 ​﻿", "c1ccc(cc1)[C@@H](N)C(=O)O", "x" * 5000 + " " * 300 + "=" * 700,
]


@pytest.mark.parametrize("text", TEXTS)
def test_same_as_the_library(library, text):
    assert tokenizer(default_vocabulary()).encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_texts(library, texts):
    mine = [x.tolist() for x in tokenizer(default_vocabulary()).encode(texts)]
    assert mine == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=127), max_size=60))
def test_ascii_texts_split_alike(text):
    from siftmill.llm import tokens

    assert tokens._SPLIT_ASCII(text) == tokens._SPLIT(text)


def test_pieces_of_vocabulary(library):
    """Random strings over few letters, whose pairs overlap and compete."""
    random.seed(2)
    texts = ["".join(random.choice("aeinrst ") for _ in range(60)) for _ in range(500)]
    assert [x.tolist() for x in tokenizer(default_vocabulary()).encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_column(spark, library):
    rows = spark.createDataFrame([(n, t, "x") for n, t in enumerate([*TEXTS, None, "dup", "dup"])], "doc_id long, text string, ids string")
    got = {r.doc_id: (r.t, r.n) for r in rows.select("doc_id", token_ids("text").alias("t"), token_counts("text").alias("n")).collect()}
    assert got[0] == ([], 0) and got[len(TEXTS)] == ([], 0)
    for n, t in enumerate(TEXTS):
        assert got[n] == ((ids := library.encode(t, add_special_tokens=False).ids), len(ids))
    assert library.decode(got[6][0]) == TEXTS[6]
    assert rows.limit(0).select(token_ids("text")).count() == 0


def test_whole_table(spark, folder, library):
    from siftmill.llm.queries import p7_ids

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = p7_ids(spark, folder).collect()
    assert len(rows) == len(texts)
    assert all(r.ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids for r in rows)
