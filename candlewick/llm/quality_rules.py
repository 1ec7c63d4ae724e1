"""Quality rules by the divergence of a document from its language.

For each language, all of its documents together give two reference
histograms: kinds of characters, and common words. A common word is a hash
bucket of words (of ``1 << WORD_BITS``) that holds ``common_share`` or more of
the language's words, so a language has a bounded number of them; all other
words make one further place. A document is compared with the references by the
Jensen-Shannon distance (square root of the divergence to base 2, from 0 to 1).
A distance is only taken of documents with enough words, as small samples
differ by chance; the bound falls to its final value as the sample grows.

Counts of words and lines are taken of the whole text. Null texts have no
words. Documents of a null language form a language. Repeated rows count as
often as they occur and get a result each; other columns play no part; an empty
table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import mixed, ready_workers, with_lists
from candlewick.llm.suffix_dedup import Hashes

SPACES = [0x20, *range(0x09, 0x0E)]
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
SPACE = np.isin(np.arange(256), SPACES)
FOLLOW = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0)
WINDOW = 5
WORD_BITS = 15

# Kinds of characters, by the first byte: space, line end, small letter, capital, digit,
# letter or sign outside ASCII, full stop and comma, other sign, control.
KINDS = 9
_KIND = np.full(256, 8)
_KIND[0x21:0x7F] = 7
_KIND[list(b".,;:'\"-()?")] = 6
_KIND[0x80:] = 5
_KIND[0x30:0x3A] = 4
_KIND[0x41:0x5B] = 3
_KIND[0x61:0x7B] = 2
_KIND[[0x0A, 0x0D]] = 1
_KIND[[0x20, 0x09]] = 0


class Counts:
    """Counts of one text after the other."""

    def __init__(self) -> None:
        self.hashes = Hashes(1 << 16)

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, and the bytes of the text."""
        flat = np.frombuffer(data, dtype=np.uint8)
        word = np.concatenate([[False], ~SPACE[flat], [False]])
        edge = np.flatnonzero(word[1:] != word[:-1])
        if not len(edge):
            return np.zeros(0, dtype=np.uint64), flat
        self.hashes.load(flat)
        return self.hashes.parts(edge[::2], edge[1::2]), flat

    @staticmethod
    def kinds(flat: np.ndarray) -> np.ndarray:
        return np.bincount(_KIND[flat[~FOLLOW[flat]]], minlength=KINDS)

    @staticmethod
    def places(words: np.ndarray) -> np.ndarray:
        return (mixed(words) >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def repeated_words(words: np.ndarray) -> int:
    """Words in windows of five that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    total = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    _, which, count = np.unique(total, return_inverse=True, return_counts=True)
    twice = count[which] > 1
    inside = np.zeros(len(words), dtype=bool)
    for i in range(WINDOW):
        inside[i : i + n] |= twice
    return int(inside.sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.split()]  # of bytes: ASCII white space only
    return len(lines) - len(set(lines))


def distance(x: np.ndarray, share: np.ndarray) -> float:
    """Jensen-Shannon distance of counts from shares."""
    p = x / x.sum()
    m = (p + share) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum()
        b = np.where(share > 0, share * np.log2(share / m), 0).sum()
    return math.sqrt(max(0.0, (a + b) / 2))


def references(docs: DataFrame, common_share: float) -> dict[str | None, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By language: shares of the kinds, the buckets of common words, their shares
    with that of all other words last."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counts()
        total: dict[str | None, np.ndarray] = {}

        def rows() -> Iterator[pd.DataFrame]:
            for lang, x in total.items():
                place = np.flatnonzero(x)
                yield pd.DataFrame({"lang": lang, "place": place, "n": x[place]})

        for part in parts:
            for lang, text in zip(part["lang"], part["text"], strict=True):
                x = total.setdefault(lang, np.zeros((1 << WORD_BITS) + KINDS, dtype=np.int64))
                words, flat = counts.words((text or "").encode("utf-8"))
                np.add.at(x, counts.places(words), 1)
                x[-KINDS:] += counts.kinds(flat)
            if len(total) > 64:  # many languages: what a worker holds stays bounded
                yield from rows()
                total.clear()
        yield from rows()

    ready_workers(docs.sparkSession)
    rows = docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInPandas(run, "lang string, place long, n long")
    sums = rows.groupBy("lang", "place").agg(F.sum("n").alias("n"))
    of_words = F.col("place") < (1 << WORD_BITS)
    total = sums.where(of_words).groupBy("lang").agg(F.sum("n").alias("total"))
    total = total.withColumnRenamed("lang", "of")
    kept = sums.join(total, F.col("lang").eqNullSafe(F.col("of"))).drop("of")
    kept = kept.where(~of_words | (F.col("n") >= common_share * F.col("total")))
    found: dict[str | None, tuple[list, list, np.ndarray, int]] = {}
    for r in kept.collect():  # per language at most 1 / common_share words and the kinds
        place, n, kinds, _ = found.setdefault(r.lang, ([], [], np.zeros(KINDS), r.total))
        if r.place < (1 << WORD_BITS):
            place.append(r.place)
            n.append(r.n)
        else:
            kinds[r.place - (1 << WORD_BITS)] = r.n
    out = {}
    for lang, (place, n, kinds, all_words) in found.items():
        order = np.argsort(place)
        shares = np.append(np.array(n, dtype=float)[order], all_words - sum(n)) / all_words
        out[lang] = kinds / kinds.sum(), np.array(place, dtype=np.int64)[order], shares
    return out


def judged(
    docs: DataFrame,
    common_share: float = 0.002,
    min_words: int = 10,
    max_repeated: int = 20,
    guard_words: int = 30,
    kind_bound: float = 0.2,
    word_bound: float = 0.26,
    slack: float = 4.5,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kind_distance and word_distance (null: not taken) and kept.

    A document fails if it has fewer than ``min_words`` words or more than
    ``max_repeated`` per cent of them in repeated windows, or, from
    ``guard_words`` words on, if a distance is over its bound. The bound for
    n words is ``bound * (1 + slack / sqrt(n))``.
    """
    known = references(docs, common_share)

    def made() -> Callable[[list, list], tuple]:
        counts = Counts()

        def one(lang: str | None, text: str | None) -> tuple:
            data = (text or "").encode("utf-8")
            words, flat = counts.words(data)
            n, repeated = len(words), repeated_words(words)
            letters = int((~SPACE[flat] & ~FOLLOW[flat]).sum())
            failed = n < min_words or 100 * repeated > max_repeated * n
            by_kind = by_word = None
            if n >= guard_words:
                kinds, place, shares = known[lang]
                by_kind = distance(counts.kinds(flat), kinds)
                own = counts.places(words)
                at = np.minimum(np.searchsorted(place, own), max(len(place) - 1, 0))
                at = np.where(place[at] == own, at, len(place)) if len(place) else np.zeros(n, dtype=np.int64)
                by_word = distance(np.bincount(at, minlength=len(shares)), shares)
            grown = 1 + slack / math.sqrt(max(n, 1))
            far = n >= guard_words and (by_kind > kind_bound * grown or by_word > word_bound * grown)
            return n, letters, int(SYMBOLS[flat].sum()), repeated_lines(data), repeated, failed, by_kind, by_word, not failed and not far

        def of(langs: list, texts: list) -> tuple:
            rows = [one(*x) for x in zip(langs, texts, strict=True)]
            return tuple(zip(*rows, strict=True)) if rows else ([],) * 9

        return of

    number, real, yes = T.LongType(), T.DoubleType(), T.BooleanType()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kind_distance", "word_distance", "kept"]
    added = dict(zip(names, [number] * 5 + [yes, real, real, yes], strict=True))
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    return with_lists(rows, ["lang", "text"], added, made).select("doc_id", *names)
