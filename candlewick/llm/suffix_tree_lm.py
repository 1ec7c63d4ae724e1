"""Language-model scores from a probabilistic suffix tree.

The symbols are the bytes of a text's words, joined by one space, between marks
of its start and end. A state of the tree is a context of up to ``depth``
symbols. Candidates are the contexts that occur ``min_count`` times or more in
the training texts, however large the corpus is; a candidate is retained if the next
symbols after it diverge from those after its longest proper suffix by
``divergence`` nats or more over all its occurrences, or if a longer retained
context ends in it. Distributions are smoothed towards that of the suffix by the
number of distinct next symbols, and at last towards equal shares of all bytes.
A symbol's probability is taken from the longest suffix of what comes before it
that is a state; so the probabilities of all texts of words sum to one.

The tree grows with the corpus, so it is spread over buckets. One pass cuts the texts
into chunks of about ``chunk_bytes`` and gives the distinct codes of each (context and
next symbol) with their counts in training texts, newest symbols of the context first,
as compressed lists of differences, one row for each chunk and bucket. Contexts with
the same last ``NEAR`` + 1 symbols are of one bucket; its task thus sees all their longer
suffixes, makes their probabilities and gives each chunk those of its codes, in
the same order. Only the contexts of up to ``NEAR`` symbols, at most 256^3 with their next ones
whatever the corpus, are handled in the driver. A chunk is scored from the values of
all its buckets.

Beside the score every text gets a unigram base score: each of its words has
the count of training words, which go the same way as hashes.

Null and empty texts have the end only; a very long text is a chunk by itself. Repeated rows count and are scored
each; other columns play no part; without training texts every byte has a share
of 1/256 and no word is known. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import blocks, mixed, stored, utf8
from candlewick.llm.quality_rules import Counts

DEPTH = 6
#: Contexts that occur less often in training texts are no candidates.
MIN_COUNT = 2
#: Keys that a worker holds before it sums those that are equal.
HELD_KEYS = 3_000_000
SYMBOLS = 256
#: Contexts of up to so many symbols are handled in the driver.
NEAR = 2
#: Keys of chunks that meet in a bucket, about.
BUCKET_ROWS = 600_000
#: Bytes of text for a distinct key of a chunk, about.
KEY_BYTES = 8
#: Bytes of text of which a worker holds the codes at a time.
CODE_BYTES = 1_000_000
#: Buckets of the counts of near contexts, and of a chunk's texts.
LOW, TEXT = -1, -2


def normal(text: bytes) -> bytes:
    """Words in small letters (A-Z only), joined by a space."""
    return b" ".join(text.lower().split())


def mask(n: int) -> np.uint64:
    return np.uint64((1 << 8 * n) - 1)


def codes(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of normal texts and their ends: ``depth`` symbols and itself
    as a number, the symbol lowest; and the number of symbols of each text."""
    pad = b"\n" * depth
    flat = np.frombuffer(b"".join(pad + t + b"\n" for t in texts), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    start = np.cumsum(sizes + depth) - sizes
    at = np.arange(sizes.sum()) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
    wide = flat.astype(np.uint64)
    code = wide.copy()
    for j in range(1, depth + 1):
        code[j:] |= wide[:-j] << np.uint64(8 * j)
    return code[at], sizes


def turned(code: np.ndarray, depth: int) -> np.ndarray:
    """Codes with the symbols of the context the other way round."""
    one = np.uint64(8)
    return (code >> one).byteswap() >> np.uint64(64 - 8 * depth) << one | code & np.uint64(255)


def firsts(x: np.ndarray) -> np.ndarray:
    """Places of sorted numbers that differ from the one before."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


def tallied(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and the sums of their numbers."""
    order = np.argsort(keys)
    keys = keys[order]
    at = firsts(keys)
    return keys[at], np.add.reduceat(n[order], at) if len(at) else n


class Tally:
    """Counts of keys: those of training texts count, the others are there."""

    def __init__(self) -> None:
        self.keys, self.held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0

    def add(self, keys: np.ndarray, counts: bool) -> None:
        keys = np.sort(keys)  # np.unique hashes, which takes twenty times as long
        at = firsts(keys)
        n = np.diff(np.append(at, len(keys)))
        self.keys.append((keys[at], n if counts else np.zeros_like(n)))
        self.held += len(at)
        if self.held > HELD_KEYS:
            self.held = len(self.total()[0]) // 2  # sums again after as many keys more

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        self.keys = [tallied(*(np.concatenate(x) for x in zip(*self.keys, strict=True)))]
        return self.keys[0]


@dataclass
class Level:
    """Contexts of one length, with the symbols after them."""

    depth: int
    key: np.ndarray
    chance: np.ndarray
    which: np.ndarray  # the context of each key
    context: np.ndarray
    kept: np.ndarray  # contexts that are retained


def levels(code: np.ndarray, n: np.ndarray, depths: range, before: np.ndarray, chance: np.ndarray, least: float, divergence: float) -> list[Level]:
    """The levels of the given depths of counted codes, which hold all of a context's
    or none. ``before`` and ``chance`` are the keys and chances of the level before."""
    out = []
    for d in depths:
        key, at = np.unique(code & mask(d + 1), return_inverse=True)
        own_n = np.bincount(at, n, minlength=len(key))
        parent = chance[np.searchsorted(before, key & mask(max(d, 1)))]
        context = key >> np.uint64(8)
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(key) else np.zeros(0, np.int64)
        which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
        total, kinds = np.bincount(which, own_n, minlength=len(first)), np.bincount(which, own_n > 0, minlength=len(first))
        counted = (total > 0) & ((total >= least) | (d == 0))
        own = np.where(counted[which], (own_n + kinds[which] * parent) / np.maximum(total + kinds, 1)[which], parent)
        apart = np.bincount(which, own_n * np.log(own / parent), minlength=len(first))
        out.append(Level(d, key, own, which, context[first], counted & ((apart >= divergence) | (d == 0))))
        before, chance = key, own
    for longer, shorter in zip(out[:0:-1], out[-2::-1], strict=True):
        keep_suffixes(shorter, longer.context[longer.kept])
    return out


def keep_suffixes(level: Level, longer: np.ndarray) -> None:
    """Retain the contexts that retained ones of one symbol more end in."""
    level.kept[np.searchsorted(level.context, longer & mask(level.depth))] = True


def final(found: list[Level], before: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """The chance of each key of the last level, from its longest retained suffix;
    ``before`` and ``chance`` are the keys and such chances of the level before."""
    for x in found:
        chance = np.where(x.kept[x.which], x.chance, chance[np.searchsorted(before, x.key & mask(max(x.depth, 1)))])
        before = x.key
    return chance


@dataclass
class Near:
    """Log10 probabilities of symbols after contexts of ``NEAR`` symbols, or fewer."""

    key: np.ndarray
    value: np.ndarray
    depth: int

    def __call__(self, code: np.ndarray) -> np.ndarray:
        return self.value[np.searchsorted(self.key, code & mask(self.depth + 1))]


def planes(x: np.ndarray) -> bytes:
    """Whole numbers compressed, their first bytes together, then their second."""
    return pressed(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def of_planes(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(unpressed(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pressed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpressed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def packed_keys(x: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return planes(np.diff(x, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(of_planes(data, np.uint64), dtype=np.uint64)


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of keys whose bits are mixed, growing with the key."""
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def code_buckets(code: np.ndarray, depth: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted turned codes by bucket, and where each bucket begins and the last ends."""
    newest = code >> np.uint64(8 * (depth - min(NEAR, depth - 1)))
    bucket = bucket_of(mixed(newest), buckets)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


LISTS = ("words", "word_counts", "codes", "code_counts")


def with_keys(rows: DataFrame, depth: int, buckets: int, chunk_bytes: int) -> DataFrame:
    """(chunk, bucket, LISTS) of rows (doc_id, text, held): the distinct keys of each chunk
    and their counts in the rows that are not ``held``. The rows of the bucket TEXT have
    the chunk's normal texts instead, with their ids and which of these are null."""

    def lists(chunk: int, words: Tally, grams: Tally) -> Iterator[pa.RecordBatch]:
        (word, word_n), (code, code_n) = words.total(), grams.total()
        low, low_n = tallied(turned(code, depth) & mask(min(NEAR, depth) + 1), code_n)
        order, edges = code_buckets(code, depth, buckets)
        word_edges = np.searchsorted(bucket_of(word, buckets), np.arange(buckets + 1))
        code, code_n = code[order], code_n[order]
        yield of_lists(chunk, [LOW], [(packed_keys(low[:0]), planes(low_n[:0].astype(np.uint32)), packed_keys(low), planes(low_n.astype(np.uint32)))])
        used = np.flatnonzero(np.diff(edges) + np.diff(word_edges))
        for few in np.array_split(used, max(1, len(used) // 64)):
            parts = [(slice(word_edges[i], word_edges[i + 1]), slice(edges[i], edges[i + 1])) for i in few]
            yield of_lists(chunk, few, [(
                packed_keys(word[w]), planes(word_n[w].astype(np.uint32)), packed_keys(code[c]), planes(code_n[c].astype(np.uint32)),
            ) for w, c in parts])

    def of_lists(chunk: int, bucket: Iterable[int], found: list[tuple[bytes, ...]]) -> pa.RecordBatch:
        n = len(found)
        columns = [pa.array([x[i] for x in found], pa.binary()) for i in range(len(LISTS))]
        return pa.RecordBatch.from_arrays([pa.array([chunk] * n, pa.int64()), pa.array([int(x) for x in bucket], pa.int64()), *columns], names=["chunk", "bucket", *LISTS])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, chunk, size = Counts(), TaskContext.get().partitionId() << 32, 0
        words, grams = Tally(), Tally()
        for batch in batches:
            texts, held = utf8(batch.column("text").to_pylist()), np.array(batch.column("held").to_pylist(), dtype=bool)
            start = 0
            while start < len(texts):
                end = start
                while end < len(texts) and size <= chunk_bytes:
                    size += len(texts[end]) + 16
                    end += 1
                data = [normal(t) for t in texts[start:end]]
                ids = batch.column("doc_id").slice(start, end - start)
                yield of_lists(chunk, [TEXT], [(planes(ids.fill_null(0).to_numpy(zero_copy_only=False)), planes(ids.is_null().to_numpy(zero_copy_only=False)), pressed(b"\n".join(data)), b"")])
                for out in (False, True):
                    some = [t for t, h in zip(data, held[start:end], strict=True) if h == out]
                    for a, b in blocks(some, CODE_BYTES):
                        words.add(counts.words(b" ".join(some[a:b]))[0], not out)
                        grams.add(turned(codes(some[a:b], depth)[0], depth), not out)
                start = end
                if size > chunk_bytes:
                    yield from lists(chunk, words, grams)
                    chunk, size, words, grams = chunk + 1, 0, Tally(), Tally()
        if size:
            yield from lists(chunk, words, grams)

    return rows.mapInArrow(run, f"chunk long, bucket long, {', '.join(f'{c} binary' for c in LISTS)}")


def near_counts(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The codes of near contexts, in order, and their counts."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for code, n in zip(part["codes"], part["code_counts"], strict=True):
                yield pd.DataFrame({"key": unpacked_keys(code).view(np.int64), "n": of_planes(n, np.uint32).astype(np.int64)})

    low = keys.where(F.col("bucket") == LOW).select("codes", "code_counts").mapInPandas(run, "key long, n long")
    low = low.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    return low["key"].to_numpy().astype(np.uint64), low["n"].to_numpy().astype(float)


VALUES = "bucket long, chunk long, words binary, codes binary, total long, kinds long, last binary"


def bucket_values(keys: DataFrame, depth: int, found: list[Level], min_count: int, divergence: float) -> DataFrame:
    """For each chunk and bucket the counts of its words and the log10 probabilities of its
    codes (NaN: that of a near context), in the order of its lists; and a row without a
    chunk for each bucket: its training words, the distinct ones, and the near contexts that
    retained longer ones end in. ``found`` are the levels of the near contexts."""
    last, before, near = found[-1].key, found[-1].chance, found[-1].depth

    def run(part: pd.DataFrame) -> pd.DataFrame:
        words, own = ([unpacked_keys(x) for x in part[c]] for c in ("words", "codes"))
        word_n, own_n = ([of_planes(x, np.uint32) for x in part[c]] for c in ("word_counts", "code_counts"))
        word, word_n = tallied(np.concatenate(words), np.concatenate(word_n).astype(np.int64))
        key, n = tallied(np.concatenate(own), np.concatenate(own_n).astype(float))
        code, value = turned(key, depth), np.full(len(key), np.nan)
        if depth > near:
            tree = levels(code, n, range(near + 1, depth + 1), last, before, min_count, divergence)
            chance = final(tree, last, np.full(len(last), np.nan))
            value = np.log10(chance[np.searchsorted(tree[-1].key, code)])
        shorter = np.sort(code[~np.isnan(value)] >> np.uint64(8) & mask(near))
        bucket = int(part["bucket"].iloc[0])
        rows = [(bucket, None, None, None, int(word_n.sum()), int((word_n > 0).sum()), packed_keys(shorter[firsts(shorter)]))]
        for chunk, w, c in zip(part["chunk"], words, own, strict=True):
            rows.append((bucket, chunk, planes(word_n[np.searchsorted(word, w)]), planes(value[np.searchsorted(key, c)]), 0, 0, None))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in VALUES.split(", ")]).astype({"chunk": "Int64"})

    return keys.where("bucket >= 0").select("bucket", "chunk", *LISTS).groupBy("bucket").applyInPandas(run, VALUES)


RESULT = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(
    docs: DataFrame,
    out: Column,
    depth: int = DEPTH,
    min_count: int = MIN_COUNT,
    divergence: float = 6.0,
    chunk_bytes: int = 24_000_000,
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row.
    ``out`` marks, by id, the rows that are not learned from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", "text", out.alias("held"))
    ends, size = rows.agg(F.count_if(~F.col("held")), F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1), F.lit(0))).first()
    buckets = max(1, -(-size // (KEY_BYTES * BUCKET_ROWS)))
    keys = stored(with_keys(rows, depth, buckets, chunk_bytes), "chunks")
    texts = keys.where(F.col("bucket") == TEXT).select("chunk", *LISTS[:3])

    start, equal = np.arange(SYMBOLS, dtype=np.uint64), np.full(SYMBOLS, 1 / SYMBOLS)
    found = levels(*near_counts(keys), range(min(NEAR, depth) + 1), start, equal, min_count, divergence)
    values = stored(bucket_values(keys, depth, found, min_count, divergence), "values")
    sums = values.where("chunk is null").select("total", "kinds", "last").toArrow()  # a row for each bucket
    for shorter in sums["last"].to_pylist():
        keep_suffixes(found[-1], unpacked_keys(shorter))
    for longer, shorter in zip(found[:0:-1], found[-2::-1], strict=True):
        keep_suffixes(shorter, longer.context[longer.kept])
    near = Near(found[-1].key, np.log10(final(found, start, equal)), found[-1].depth)
    total = sum(sums["total"].to_pylist()) + ends
    least = np.log10(total + sum(sums["kinds"].to_pylist()) + (ends > 0) + 1)

    def run(own: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        counts = Counts()
        ids, null = (np.concatenate([of_planes(x, kind) for x in own[c]]) for c, kind in zip(LISTS, (np.int64, np.bool_), strict=False))
        data = [t for x in own["codes"] for t in unpressed(x).split(b"\n")]
        word = distinct(counts.words(b" ".join(data[a:b]))[0] for a, b in blocks(data, CODE_BYTES))
        code = distinct(turned(codes(data[a:b], depth)[0], depth) for a, b in blocks(data, CODE_BYTES))
        parts = parts.sort_values("bucket")
        n = np.concatenate([np.zeros(0, np.int64), *(of_planes(x, np.int64) for x in parts["words"])])
        value = np.empty(len(code))
        value[code_buckets(code, depth, buckets)[0]] = np.concatenate([np.zeros(0), *(of_planes(x, np.float64) for x in parts["codes"])])
        rows = []
        for a, b in blocks(data, CODE_BYTES):
            hashes = [counts.words(t)[0] for t in data[a:b]]
            size = np.array([len(h) for h in hashes], dtype=np.int64)
            c = looked_up(word, n, np.concatenate([*hashes, np.zeros(0, np.uint64)]))
            text = np.repeat(np.arange(b - a), size)
            base = np.bincount(text, np.log10(c + 1) - least, minlength=b - a) + np.log10(ends + 1) - least
            seen = np.bincount(text, c > 0, minlength=b - a).astype(np.int64) + (ends > 0)
            symbols, sizes = codes(data[a:b], depth)
            p = looked_up(code, value, turned(symbols, depth))
            rest = np.isnan(p)
            p[rest] = near(symbols[rest])
            score = np.add.reduceat(p, np.cumsum(sizes) - sizes)
            rows.append(pd.DataFrame({"n_tokens": size + 1, "n_known": seen, "train_tokens": total, "base_score": base, "score": score}))
        return pd.concat(rows, ignore_index=True).assign(doc_id=pd.arrays.IntegerArray(ids, null))[[c.split()[0] for c in RESULT.split(", ")]]

    lists = values.where("chunk is not null").select("chunk", "bucket", "words", "codes")
    return texts.groupBy("chunk").cogroup(lists.groupBy("chunk")).applyInPandas(run, RESULT)


def distinct(parts: Iterable[np.ndarray]) -> np.ndarray:
    """The distinct numbers of all parts, in order."""
    held, size = [np.zeros(0, np.uint64)], 0
    for part in parts:
        part = np.sort(part)
        held.append(part[firsts(part)])
        size += len(held[-1])
        if size > HELD_KEYS:
            held = [merged(held)]
            size = len(held[0]) // 2
    return merged(held)


def merged(parts: list[np.ndarray]) -> np.ndarray:
    every = np.sort(np.concatenate(parts))
    return every[firsts(every)]


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the wanted keys, which are all there, by sorted keys."""
    order = np.argsort(wanted)  # searching in order stays in the cache
    out = np.empty(len(wanted), values.dtype)
    out[order] = values[np.searchsorted(keys, wanted[order])]
    return out
