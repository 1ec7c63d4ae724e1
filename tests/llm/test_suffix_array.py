"""Suffix arrays and common prefixes against sorting."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm.suffix_array import permuted_common_prefixes, suffix_array


def check(text: bytes):
    t = np.append(np.frombuffer(text, np.uint8).astype(np.int64) + 1, 0)
    sa = suffix_array(t)
    rows = t.tolist()
    assert sa.tolist() == sorted(range(len(rows)), key=lambda i: rows[i:])
    before, shared = permuted_common_prefixes(t, sa)
    for a, b in zip(sa[:-1], sa[1:], strict=True):
        n = 0
        while rows[a + n] == rows[b + n]:
            n += 1
        assert (before[b], shared[b]) == (a, n)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=80), st.text("ab", max_size=120).map(str.encode), st.text("abc ", max_size=200).map(str.encode)))
def test_any_bytes(text):
    check(text)


@pytest.mark.parametrize("text", [b"", b"a", b"a" * 300, b"ab" * 200, b"mississippi" * 20, bytes(range(256)) * 2, b"the cat sat " * 3 + b"on" + b"the cat sat " * 5])
def test_repeats(text):
    check(text)
