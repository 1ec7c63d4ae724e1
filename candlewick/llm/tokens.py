"""Words of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from candlewick.llm.suffix_dedup import Hashes

# Bytes of words: ASCII letters and digits, and all of other characters.
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def word_hashes(texts: list[bytes], hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of each text); texts in small letters."""
    flat = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    hashes.load(flat)
    word = np.concatenate([[False], _WORD[flat], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    upto = np.searchsorted(start, ends)
    return hashes.parts(start, end), np.diff(upto, prepend=0)
