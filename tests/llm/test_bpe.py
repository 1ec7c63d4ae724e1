"""Encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from candlewick.llm import bpe
from candlewick.llm.queries import op1_bpe, word_bpe_path

SCHEMA = "doc_id long, text string, ids string, decoded int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_bpe_path())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return (
        len(ids),
        hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


CASES = [
    None, "", " ", "a", "aaaaaaa", "it's we've I'll THEY'D", "x" * 5000, "ab " * 3000,
    "1234 5.6 ,,,!!! éè é ΣΣ İ", "<|endoftext|>a<|startoftext|><|endoftext|", "\x1c\x85 　 z",
    "你好 \U0001f600\U0001f600 नमस्ते", "<|ENDOFTEXT|>", "tab\tnew\nline",
]


def test_cases_in_spark(spark, library):
    rows = [(i, t, "clash", i) for i, t in enumerate(CASES)] + [(0, None, "", 0), (None, "null id", None, None)]
    got = {}
    for r in bpe.digests(spark.createDataFrame(rows, SCHEMA), word_bpe_path()).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    assert got[0] == [expected(library, None)] * 2 and got[None] == [expected(library, "null id")]
    for i, t in enumerate(CASES[1:], 1):
        assert got[i] == [expected(library, t)], t


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], SCHEMA), word_bpe_path()).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs", "Cn")), max_size=60))
def test_any_text(library, text):
    tok = bpe.tokenizer(word_bpe_path())
    ids = np.frombuffer(tok.encode([text])[0], dtype="<u4")
    want = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want
    assert tok.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_query_over_the_table(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in op1_bpe(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: expected(library, r.text) for r in rows}
