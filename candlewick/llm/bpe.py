"""BPE encoding and decoding by batched merge rounds in numpy.

A text is split into words as the tokenizer file says. The distinct words of a
block lie in one flat array of symbols. A round finds the merge of every
adjacent pair by binary search over the sorted pair keys, applies the
lowest-ranked merge of each word at all its places, and goes on with the words
that changed. Words met before come from a bounded table.

Null texts count as empty: no ids, empty decoded text. Rows pass one by one,
so repeated rows and ids get their result each, and an empty table gives an
empty one. Other columns pass through; columns of the names that an operator
adds are replaced. Code points that Unicode assigned only lately (after version
15.1) have the classes and small forms that the installed Python libraries
give them.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import blocks, with_lists

#: Words that a worker keeps with their ids; the table starts anew beyond it.
KNOWN_WORDS = 200_000
NO_RANK = np.iinfo(np.int64).max


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    at = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [at[b] for b in range(256)]


class WordBPE:
    """A tokenizer whose words end in a marked symbol, read from its file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        self.splits = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # white space as Unicode defines it; \s of this library has four controls more
        self.words = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}"))
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.final = np.array([vocab[c + end] for c in chars], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)  # by rank

    def pieces(self, text: str) -> list[str]:
        """The words of a text; special tokens stand as they are."""
        if "<|" not in text:
            return self._words(text)
        out: list[str] = []
        for part in self.splits.split(text):
            out += [part] if part in self.special else self._words(part)
        return out

    def _words(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        # letter by letter: a capital sigma has one small form, wherever it stands
        return self.words.findall(text.replace("Σ", "σ").lower())

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit numbers."""
        out: list[bytes] = [b""] * len(words)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        size = np.array([len(w) for w in words], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), size)
        sym = self.inner[flat]
        last = np.append(word[1:] != word[:-1], True) if len(word) else np.zeros(0, bool)
        sym[last] = self.final[flat[last]]
        rank = np.full(len(sym), NO_RANK)
        if len(sym) > 1:
            rank[:-1] = np.where(last[:-1], NO_RANK, self._ranks(sym[:-1], sym[1:]))
        while len(sym):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, starts)
            n = np.diff(np.append(starts, len(sym)))
            going = np.repeat(least != NO_RANK, n)
            done = ~going
            if done.any():
                ids = sym[done].astype("<u4").tobytes()
                ends = 4 * np.cumsum(n[least == NO_RANK])
                begin = 0
                for w, e in zip(word[starts[least == NO_RANK]].tolist(), ends.tolist(), strict=True):
                    out[w] = ids[begin:e]
                    begin = e
                least = np.repeat(least, n)[going]
                sym, word, rank = sym[going], word[going], rank[going]
            else:
                least = np.repeat(least, n)
            if not len(sym):
                break
            hit = np.flatnonzero(rank == least)
            # of places that follow each other, as in "aaa", every other one merges
            run = np.cumsum(np.append(True, (np.diff(hit) != 1) | (word[hit[1:]] != word[hit[:-1]]))) - 1
            first = hit[np.append(True, run[1:] != run[:-1])]
            hit = hit[(hit - first[run]) % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            at = hit - np.arange(len(hit))  # the places after the removal
            sym, word, rank = sym[stay], word[stay], rank[stay]
            near = np.unique(np.concatenate([at, at - 1]))
            near = near[near >= 0]
            rank[near] = NO_RANK
            near = near[near < len(sym) - 1]
            near = near[word[near] == word[near + 1]]
            rank[near] = self._ranks(sym[near], sym[near + 1])
        return out

    def encode(self, texts: list[str | None], known: dict[str, bytes] | None = None) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers. ``known`` keeps
        words with their ids for the next call, within its bound."""
        known = {} if known is None else known
        rows = [self.pieces(t) if t else [] for t in texts]
        new = sorted({w for r in rows for w in r if w not in known})
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
            new = sorted({w for r in rows for w in r})
        plain = [w for w in new if w not in self.special]
        known.update(zip(plain, self.merge([w.encode("utf-8") for w in plain]), strict=True))
        known.update((w, np.uint32(self.special[w]).tobytes()) for w in new if w in self.special)
        get = known.__getitem__
        return [b"".join(map(get, r)) for r in rows]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by spaces, as the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBPE:
    return WordBPE(path)


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the ids of the whole text, as binary (little-endian unsigned 32-bit)."""

    def made() -> Callable[[list], tuple]:
        bpe = tokenizer(path)
        known: dict[str, bytes] = {}  # of this task: a worker that is used again starts anew
        return lambda texts: ([x for a, b in blocks([t or "" for t in texts]) for x in bpe.encode(texts[a:b], known)],)

    return with_lists(df, [text_col], {ids_col: T.BinaryType()}, made)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the text of the ids that :func:`encode` gave (null ids: empty)."""

    def made() -> Callable[[list], tuple]:
        bpe = tokenizer(path)
        return lambda ids: ([bpe.decode(np.frombuffer(x or b"", dtype="<u4")) for x in ids],)

    return with_lists(df, [ids_col], {out_col: T.StringType()}, made)


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode, and give per row the id, the number of tokens and both digests."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = decode(encode(rows, path).drop("text"), path)
    return both.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
