"""Token ids equal those of the public library and decode to the text."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm.tokens import TOKENIZERS, Vocabulary, decode_documents, default_path, encode_documents, vocabulary

pytestmark = pytest.mark.skipif(not os.path.exists(default_path()), reason="no tokenizers here")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


TEXTS = ["", " ", "\n\n  x", "Hello world, it's 3.14!", "日本語のテキスト", "<|endoftext|>", "naïve café 🙂‍↔️", "a" * 5000, "ab" * 3000 + "!" * 700, "​﻿\r\n\t", "don't DON'T we'll", "ہیلو दुनिया"]


def test_equal_to_library(library):
    v = vocabulary(default_path())
    for t in TEXTS:
        assert v.encode(t) == library.encode(t, add_special_tokens=False).ids
        assert v.decode_bytes(v.encode(t)).decode() == t


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text("abest <|>'.,1\n", max_size=120))
def test_random_texts(t):
    from tokenizers import Tokenizer

    v = vocabulary(default_path())
    lib = test_random_texts.__dict__.setdefault("lib", None) or Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    lib.encode_special_tokens = True
    test_random_texts.lib = lib
    assert v.encode(t) == lib.encode(t, add_special_tokens=False).ids
    assert v.decode_bytes(v.encode(t)).decode() == t


def test_other_vocabulary_of_the_same_kind():
    import base64

    import tiktoken

    path = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
    import public_tokenizers as P

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    v = Vocabulary(path)
    for t in TEXTS:
        assert v.encode(t) == lib.encode_ordinary(t)


def test_table_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " ", "x"), (4, "word " * 4000, None), (4, "again", "x"), (None, "no id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = encode_documents(df).collect()
    assert len(out) == 6
    by = {r.doc_id: list(r.ids) for r in out if r.doc_id != 4}
    assert by[1] == by[2] == [] and len(by[3]) == 1 and None in by
    counts = {r.doc_id: r.n_tokens for r in encode_documents(df.where("doc_id <> 4"), count_only=True, keep=["ids"]).collect()}
    assert counts == {1: 0, 2: 0, 3: 1}
    back = {r.doc_id: r.text for r in decode_documents(encode_documents(df.where("doc_id < 4"))).collect()}
    assert back == {1: "", 2: "", 3: " "}
    assert encode_documents(df.limit(0)).count() == 0


def test_all_documents(spark, data, library):
    from linkloom.sources.tables import table

    docs = table(spark, data, "documents")
    got = {r.doc_id: list(r.ids) for r in encode_documents(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        assert got[r.doc_id] == library.encode(r.text or "", add_special_tokens=False).ids
