"""Removal of long byte strings that occur more than once, by suffix arrays.

A string of ``length`` bytes that occurs twice has the same least-hashed gram
at the same place in it, its anchor. So every start belongs to an anchor, the
starts of one anchor that follow each other make a segment (their strings
together), and equal strings lie in segments of equal anchors.

1. Every text gives its segments as hashes: (anchor, content, first start,
   number of starts). Segments of equal content are found by counting; all
   their strings are repeated.
2. Anchors with segments of different content are contested. One copy of each
   such segment goes to the shard of its anchor. A shard of about a megabyte
   gets its suffix array by induced sorting; the common prefixes of
   neighbours tell which starts have a string of that length in common.
3. An anchor with more segments than a shard may take (a passage in very many
   contexts) is dealt by string instead: hashes of its strings are counted.

Texts are whole, as UTF-8 bytes; null and empty ones have nothing to remove. A
row's result depends on its text and on the other rows only: repeated rows
count as occurrences of each other. An empty table gives an empty one. Other
columns pass through, whatever their names. A text of any length is read in slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import BLOCK_BYTES, blocks, fresh_names, mixed, stored, utf8, with_lists
from candlewick.llm.suffix_array import permuted_common_prefixes, suffix_array

GRAM = 32
#: Starts of a text handled at a time: some megabytes as arrays, of which a worker holds a dozen.
SLICE = 1 << 17
SHARD_BYTES = 1_000_000
#: Segments of one anchor that go to one shard.
SHARD_SEGMENTS = 3000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of any part of some bytes, by their prefix sums."""

    def __init__(self, limit: int = SLICE * 3):
        self.up, self.down = _powers(_BASE, limit), _powers(_BACK, limit)

    def load(self, data: np.ndarray) -> None:
        if len(data) >= len(self.up):
            self.__init__(2 * len(data))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=self.sums[1:])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:-size]) * self.down[:n])

    def parts(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start]) ^ (end - start).astype(np.uint64)


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """The least value of every window."""
    n, have = len(x) - width + 1, 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n])


def segments(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, hashes: Hashes) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, content hash, first start, starts) of the texts that
    lie one after the other in ``flat``, each at least ``length`` long."""
    hashes.load(flat)
    gram = hashes.grams(GRAM)
    width = length - GRAM + 1
    place = np.arange(len(gram), dtype=np.uint64)
    low = np.uint64((1 << 23) - 1)  # the leftmost of equal hashes: places below the hash's high bits
    least = window_minima(gram & ~low | place, width) & low
    n = sizes - length + 1
    text = np.repeat(np.arange(len(sizes)), n)
    at = np.arange(n.sum()) + np.repeat(starts - np.append(0, np.cumsum(n)[:-1]), n)
    anchor = least[at].astype(np.int64)
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    count = np.diff(np.append(first, len(at)))
    begin = at[first]
    content = hashes.parts(begin, begin + count + length - 1)
    return text[first], gram[anchor[first]].view(np.int64), content.view(np.int64), begin - starts[text[first]], count


def slices(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, part) of the texts that are long enough, in blocks."""
    block, size = [], 0
    for row, text in enumerate(texts):
        for a in range(0, len(text) - length + 1, SLICE):
            part = text[a : a + SLICE + length - 1]
            if block and size + len(part) > SLICE:
                yield block
                block, size = [], 0
            block.append((row, a, part))
            size += len(part)
    if block:
        yield block


def all_segments(rows: DataFrame, length: int) -> DataFrame:
    """(k1, k2, h, seg, lo, n) of every row of (k1, k2, text)."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for part in parts:
            k1, k2 = part["k1"].to_numpy(), part["k2"].to_numpy()
            for block in slices(utf8(part["text"]), length):
                row, offset, texts = (np.array(x, dtype=object if i == 2 else np.int64) for i, x in enumerate(zip(*block, strict=True)))
                size = np.array([len(t) for t in texts], dtype=np.int64)
                flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
                which, h, seg, lo, n = segments(flat, np.append(0, np.cumsum(size)[:-1]), size, length, hashes)
                at = row[which]
                yield pd.DataFrame({"k1": k1[at], "k2": k2[at], "h": h, "seg": seg, "lo": lo + offset[which], "n": n})

    return rows.mapInPandas(run, "k1 long, k2 long, h long, seg long, lo long, n long")


def joined_runs(first: np.ndarray, after: np.ndarray) -> list[tuple[int, int]]:
    """Half-open runs [first, after) merged where they overlap or touch."""
    order = np.argsort(first, kind="stable")
    first, top = first[order], np.maximum.accumulate(after[order])
    cut = np.flatnonzero(np.append(True, first[1:] > top[:-1]))
    return list(zip(first[cut].tolist(), top[np.append(cut[1:], len(top)) - 1].tolist(), strict=True))


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text of a shard: the starts whose string of ``length`` bytes has
    an equal one at another start of the shard."""
    sizes = np.array([len(t) for t in texts])
    t = np.frombuffer(b"\0".join(texts) + b"\0\0", dtype=np.uint8).astype(np.uint16) + 2
    ends = np.cumsum(sizes + 1) - 1
    t[ends] = 1
    t[-1] = 0
    before, shared = permuted_common_prefixes(t, suffix_array(t))
    long = shared >= length  # zero marks never lie within: an equal string would be in an equal text
    inside = np.arange(len(t)) + length <= np.append(np.repeat(ends, sizes + 1), 0)
    hit = long & inside & inside[before]
    hit[before[hit]] = True
    return [np.flatnonzero(hit[e - n : e]) for e, n in zip(ends, sizes, strict=True)]


RUNS = "array<struct<a:long,b:long>>"


CUTS = ["h", "seg", "kinds", "lo", "size"]


def cut_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, seg, kinds, part) of texts with lists of cuts, many texts to a batch of about a megabyte."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        h, seg, kinds, lo, size = (batch.column(c).flatten() for c in CUTS)
        row = np.repeat(np.arange(len(texts)), batch.column("h").value_lengths().to_numpy())
        end = np.cumsum(size.to_numpy())
        edges = [0, *(np.flatnonzero(np.diff(end // BLOCK_BYTES)) + 1).tolist(), len(row)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            cuts = zip(row[a:b].tolist(), lo[a:b].to_pylist(), size[a:b].to_pylist(), strict=True)
            part = pa.array([texts[i][x : x + n] for i, x, n in cuts], type=pa.binary())
            yield pa.RecordBatch.from_arrays([h[a:b], seg[a:b], kinds[a:b], part], names=["h", "seg", "kinds", "part"])


def contested(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, seg, kinds, part): the bytes of segments given by (k1, k2, h, seg, kinds, lo, size)."""
    lists = wanted.groupBy("k1", "k2").agg(*(F.collect_list(c).alias(c) for c in CUTS))
    # a segment is wanted of one text only, so copies of that row go before they are cut
    both = docs.join(lists, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("text", *CUTS)
    return both.mapInArrow(cut_parts, "h long, seg long, kinds long, part binary")


def shard_runs(parts: DataFrame, shards: int, length: int) -> DataFrame:
    """(h, seg, runs): repeated starts of the segments, found shard by shard."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["h", "seg"], ignore_index=True)
        found = repeated_starts(list(group["part"]), length)
        rows = [(h, seg, joined_runs(s, s + 1)) for h, seg, s in zip(group["h"], group["seg"], found, strict=True) if len(s)]
        return pd.DataFrame(rows, columns=["h", "seg", "runs"]).astype({"h": "int64", "seg": "int64"})

    sharded = parts.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
    return sharded.groupBy("shard").applyInPandas(run, f"h long, seg long, runs {RUNS}")


def part_strings(frames: Iterable[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """(h, seg, at, x, y) of every string of the parts, many parts to a frame."""
    hashes = Hashes()
    for frame in frames:
        for a, b in blocks(frame["part"].to_list(), SLICE):
            some = frame.iloc[a:b]
            sizes = some["part"].map(len).to_numpy()
            hashes.load(np.frombuffer(b"".join(some["part"]), dtype=np.uint8))
            n = sizes - length + 1
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            begin = at + np.repeat(np.cumsum(sizes) - sizes, n)
            h, seg = (np.repeat(some[c].to_numpy(), n) for c in ("h", "seg"))
            # the string's hash and that of its first half
            x, y = (hashes.parts(begin, begin + k).view(np.int64) for k in (length, length // 2))
            yield pd.DataFrame({"h": h, "seg": seg, "at": at, "x": x, "y": y})


def string_runs(parts: DataFrame, length: int) -> DataFrame:
    """(h, seg, runs) of segments of anchors with very many of them: every string by itself."""
    rows = parts.mapInPandas(lambda frames: part_strings(frames, length), "h long, seg long, at long, x long, y long")
    often = rows.groupBy("h", "x", "y").agg(F.count("*").alias("c")).where("c > 1")
    runs = F.transform(F.array_sort(F.collect_list("at")), lambda a: F.struct(a.alias("a"), (a + 1).alias("b")))
    return rows.join(often, ["h", "x", "y"]).groupBy("h", "seg").agg(runs.alias("runs"))


def repeated_spans(docs: DataFrame, length: int = 400, shard_bytes: int = SHARD_BYTES, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(k1, k2, spans): the byte ranges to remove of the rows of (k1, k2, text)
    that have any; ranges may overlap."""
    if length < 2 * GRAM:
        raise ValueError(f"strings of at least {2 * GRAM} bytes are needed")
    found = stored(all_segments(docs, length), "segments")
    kinds = found.groupBy("h", "seg").agg(
        F.count("*").alias("c"), *(F.first(c).alias(c) for c in ("k1", "k2", "lo", "n"))
    )
    anchors = kinds.groupBy("h").agg(F.count("*").alias("kinds"), F.sum("c").alias("total")).where("total > 1")
    kinds = stored(kinds.join(anchors.select("h", "kinds"), "h"), "kinds")
    whole = kinds.where("c > 1").select("h", "seg", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n").alias("b"))).alias("runs"))
    wanted = kinds.where("kinds > 1").select("k1", "k2", "h", "seg", "kinds", "lo", (F.col("n") + length - 1).alias("size"))
    parts = stored(contested(docs, wanted), "parts")
    total = parts.agg(F.coalesce(F.sum(F.octet_length("part")), F.lit(0))).first()[0]
    shards = max(1, round(total / shard_bytes))
    some = shard_runs(parts.where(F.col("kinds") <= shard_segments).select("h", "seg", "part"), shards, length)
    many = string_runs(parts.where(F.col("kinds") > shard_segments).select("h", "seg", "part"), length)
    runs = whole.unionByName(some).unionByName(many)
    spans = found.join(runs, ["h", "seg"]).select(
        "k1", "k2", F.explode(F.transform("runs", lambda r: F.struct((F.col("lo") + r.a).alias("a"), (F.col("lo") + r.b + length - 1).alias("b")))).alias("s")
    )
    return spans.groupBy("k1", "k2").agg(F.collect_set("s").alias("spans"))


def kept_bytes(data: bytes, spans: list | None) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the runs that went."""
    if spans is None or not len(spans):
        return data, []
    runs = joined_runs(*(np.array([s[k] for s in spans], dtype=np.int64) for k in ("a", "b")))
    edges = [0, *(x for r in runs for x in r), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), runs


def with_spans(docs: DataFrame, length: int, text_col: str = "text", **limits: int) -> tuple[DataFrame, str]:
    """All rows and columns, with one of a new name: the byte ranges to remove (null: none)."""
    k1, k2, ranges = fresh_names(docs, "_k1", "_k2", "_spans")
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.xxhash64(F.coalesce(text_col, F.lit("")))]
    rows = docs.select("*", key[0].alias(k1), key[1].alias(k2))
    long = rows.where(F.octet_length(text_col) >= length)
    texts = long.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(text_col).alias("text"))
    spans = repeated_spans(texts, length, **limits).toDF(k1, k2, ranges)
    return rows.join(spans, [k1, k2], "left").drop(k1, k2), ranges


def remove_repeats(docs: DataFrame, length: int = 400, text_col: str = "text", **limits: int) -> DataFrame:
    """All rows and columns, the repeated bytes gone from the text. A character of
    which a part was removed goes as a whole."""

    def left(text: str | None, spans: list | None) -> str | None:
        return text if text is None or not spans else kept_bytes(text.encode("utf-8"), spans)[0].decode("utf-8", "ignore")

    def made() -> Callable[[list, list], tuple]:
        return lambda texts, spans: ([left(t, s) for t, s in zip(texts, spans, strict=True)],)

    rows, ranges = with_spans(docs, length, text_col, **limits)
    return with_lists(rows, [text_col, ranges], {text_col: T.StringType()}, made).select(*docs.columns)


def removal_digests(docs: DataFrame, length: int = 400, **limits: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""

    def made() -> Callable[[list, list], tuple]:
        def of(texts: list, spans: list) -> tuple:
            data = utf8(texts)
            kept = [kept_bytes(d, s) for d, s in zip(data, spans, strict=True)]
            return (
                [len(d) for d in data],
                [len(d) - len(k) for d, (k, _) in zip(data, kept, strict=True)],
                [len(r) for _, r in kept],
                [hashlib.sha256(k).hexdigest() for k, _ in kept],
            )

        return of

    added = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept_sha256": T.StringType()}
    rows, ranges = with_spans(docs.select("doc_id", "text"), length, **limits)
    return with_lists(rows, ["text", ranges], added, made).select("doc_id", *added)
