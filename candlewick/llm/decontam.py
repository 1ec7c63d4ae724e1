"""Benchmark passages in training texts, found by spaced seeds.

A seed reads a few of the words under a fixed mask and ignores the others, so
a changed word at an ignored place does not hide a passage. Any 13 words of
which at most two differ share a seed under one of the four masks. The seeds of
the test items are joined with those of every training text; each hit is
verified along its diagonal: words are compared one by one, and an overlap
counts where ``min_words`` in a row agree in a share of ``agree`` or more.

Words are runs of ASCII letters and digits and of characters outside ASCII, in
small letters; in scripts without spaces every character is one. Items of fewer
words than ``min_words`` count, however few they are (``least_words`` may ask for
more), where they occur whole and unchanged. Null and empty texts hold nothing;
long ones are searched whole; repeated rows get their results each; ids of items may
repeat and be null. With an empty table on either side no overlap is found.
Other columns play no part, whatever their names.

The items are taken in blocks of at most ``block_bytes`` of text, so what is
sent to the workers is bounded however many items there are; each block is a
pass over the training texts.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import blocks, mixed, ready_workers, where_lists
from candlewick.llm.suffix_dedup import Hashes
from candlewick.llm.tokens import word_hashes

MASKS = ("1111111", "1110011011", "1011010111", "101110111")
#: One bit of the sieve for each value of so many high bits of a seed.
SIEVE_BITS = 22


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the words under the mask, at each place where it fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, int(mask, 2) * 2 + 1, dtype=np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mixed(total)


#: Characters of scripts that put no space between words: each is a word.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def small(text: str | None) -> bytes:
    """A text in small letters, with spaces around characters that are words."""
    low = (text or "").lower()
    return (UNSPACED.sub(r" \g<0> ", low) if UNSPACED.search(low) else low).encode("utf-8")


class Items:
    """The test items of a block, with their seeds in order."""

    def __init__(self, ids: list, texts: list[str | None], min_words: int, agree: float, least_words: int):
        self.ids, self.min_words, self.agree = ids, min_words, agree
        words, counts = word_hashes([small(t) for t in texts], Hashes())
        self.words = np.split(words, np.cumsum(counts)[:-1]) if len(counts) else []
        self.masks = list(MASKS)
        if max(map(len, MASKS)) > min_words:
            raise ValueError("the masks are wider than the least overlap")
        found = []
        for i, w in enumerate(self.words):
            short = len(w) < min_words
            if short and len(w) < least_words:
                continue
            for mask in ["1" * len(w)] if short else MASKS:
                if mask not in self.masks:
                    self.masks.append(mask)
                x = seeds(w, mask)
                found.append((x, np.full(len(x), i), np.arange(len(x))))
        none = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        seed, item, place = (np.concatenate(x) for x in zip(*found or none, strict=True))
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.place = seed[order], item[order], place[order]
        self.sieve = np.zeros(1 << SIEVE_BITS, dtype=bool)
        self.sieve[(self.seed >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)] = True

    def diagonals(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(item, offset of its first word in the text) of every seed in common."""
        found: set[tuple[int, int]] = set()
        for mask in self.masks:
            x = seeds(words, mask)
            at = np.flatnonzero(self.sieve[(x >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)])
            left = np.searchsorted(self.seed, x[at], "left")
            n = np.searchsorted(self.seed, x[at], "right") - left
            which = np.repeat(left - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum()) if len(n) else n
            found.update(zip(self.item[which].tolist(), (np.repeat(at, n) - self.place[which]).tolist(), strict=True))
        return found

    def overlap(self, words: np.ndarray, item: int, offset: int) -> np.ndarray:
        """Which words of the item lie in an overlap that counts."""
        own = self.words[item]
        a, b = max(0, -offset), min(len(own), len(words) - offset)
        inside = np.zeros(len(own), dtype=bool)
        width = min(self.min_words, len(own))
        if b - a < width:
            return inside
        need = math.ceil(self.agree * width) if len(own) >= self.min_words else width
        equal = np.concatenate([[0], np.cumsum(own[a:b] == words[offset + a : offset + b])])
        good = np.flatnonzero(equal[width:] - equal[:-width] >= need)
        for i in range(width):
            inside[a + good + i] = True
        return inside

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, words of the item in overlaps, words in all)."""
        data, hashes = [small(t) for t in texts], Hashes()
        for a, b in blocks(data):
            words, counts = word_hashes(data[a:b], hashes)
            ends = np.cumsum(counts)
            by: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for item, offset in self.diagonals(words):
                # the text in which the item would begin, or the next ones that it may reach into
                first = int(np.searchsorted(ends, max(offset, 0), "right"))
                while first < len(ends) and ends[first] - counts[first] < offset + len(self.words[item]):
                    by[first].append((item, offset))
                    first += 1
            for text, hits in sorted(by.items()):
                start = int(ends[text] - counts[text])
                own = words[start : ends[text]]
                inside: dict[int, np.ndarray] = {}
                for item, offset in hits:
                    found = self.overlap(own, item, offset - start)
                    inside[item] = inside[item] | found if item in inside else found
                for item, found in sorted(inside.items()):
                    if found.any():
                        yield a + text, item, int(found.sum()), len(found)


def item_blocks(items: DataFrame, block_bytes: int, id_col: str, text_col: str) -> Iterator[tuple[list, list]]:
    """The items in blocks that hold at most so many bytes, or one item."""
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.coalesce(F.octet_length(text_col), F.lit(0)).alias("n"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(2 * total / block_bytes))
    for p in range(parts):
        own = rows.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == p).select("i", "t").collect() if parts > 1 else rows.select("i", "t").collect()
        yield [r.i for r in own], [r.t for r in own]


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    min_words: int = 13,
    agree: float = 0.8,
    least_words: int = 1,
    block_bytes: int = 8_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, overlap_words, item_words): a row for each training row
    and test item with an overlap."""
    ready_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def passed(ids: list, texts: list) -> DataFrame:
        block = Items(ids, texts, min_words, agree, least_words)

        def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                doc = part["doc_id"].tolist()
                found = [(doc[t], block.ids[i], n, m) for t, i, n, m in block.search(part["text"].tolist())]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "overlap_words", "item_words"]).astype({"doc_id": "Int64", "item_id": "Int64"})

        return rows.mapInPandas(run, "doc_id long, item_id long, overlap_words long, item_words long")

    return reduce(DataFrame.unionByName, (passed(*b) for b in item_blocks(items, block_bytes, "item_id", "text")))


def without_overlaps(
    docs: DataFrame, items: DataFrame, min_words: int = 13, agree: float = 0.8, least_words: int = 1, block_bytes: int = 8_000_000, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that overlap with no test item."""
    for ids, texts in item_blocks(items, block_bytes, "item_id", "text"):
        block = Items(ids, texts, min_words, agree, least_words)

        def made(block: Items = block) -> Callable[[list], list[bool]]:
            def of(texts: list) -> list[bool]:
                hit = {t for t, *_ in block.search(texts)}
                return [i not in hit for i in range(len(texts))]

            return of

        docs = where_lists(docs, [text_col], made)
    return docs
