"""SimHash near-duplicates with pigeonring filtering.

The fingerprint bits are cut into segments on a ring. If two fingerprints
differ in at most t bits over m segments, some segment starts a chain in which
the first l segments together differ in at most l*t/m bits, for every l. With
m > t the first segment of that chain is equal, so fingerprints meet in buckets
of an equal segment; the longer chains prune pairs before the full check.

Work is done on distinct fingerprints, so copies cost nothing. Within a bucket
only the links of a spanning forest leave the task. A bucket of more than
``bucket_limit`` fingerprints is linked without pairs: each fingerprint meets
the others under every choice of t of its bits set to zero, which is exact and
grows in proportion to the bucket.

Null and empty texts have fingerprint zero and link like any other. Repeated
rows get one result each; a component whose ids are all null has a null id.
An empty table gives an empty one. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import fresh_names, ready_workers, stored, utf8, whole_runs
from candlewick.llm.components import components

BITS = 64
SEED = 42
#: Pairs of a bucket compared at a time.
PAIR_ROWS = 200_000


def fingerprint(text: bytes, shingle: int) -> int:
    """Bitwise majority of the shingle hashes of a text (an even split: 0)."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    shingle = min(shingle, len(words))
    hash_of = xxhash.xxh64_intdigest
    hashes = [hash_of(line[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 65_536):
        part = np.array(hashes[i : i + 65_536], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, content, fp): a hash of the text and its fingerprint, for each row."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            fps = np.array([fingerprint(t, shingle) for t in utf8(part["text"])], dtype=np.uint64)
            yield part[["doc_id", "content"]].assign(fp=fps.view(np.int64))

    ready_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), content_of(text_col).alias("content"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, content long, fp long")


def content_of(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(text_col, F.lit("")))


def segments(m: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each segment."""
    cuts = [i * BITS // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _mask(start: int, n: int) -> int:
    return ((1 << n) - 1) << start


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def ring_links(seg: np.ndarray, fps: np.ndarray, bucket: np.ndarray, max_bits: int, m: int) -> np.ndarray:
    """For rows sorted by bucket: the first linked row of each row's component."""
    masks = np.array([_mask(*s) for s in segments(m)], dtype=np.uint64)
    root = np.arange(len(fps))
    active, lag = np.arange(len(fps)), 1
    while True:
        active = active[active + lag < len(fps)]
        active = active[bucket[active] == bucket[active + lag]]
        if not len(active):
            return root
        for i in range(0, len(active), PAIR_ROWS):
            a = active[i : i + PAIR_ROWS]
            a = a[root[a] != root[a + lag]]  # linked already
            diff, start = fps[a] ^ fps[a + lag], seg[a]
            total = np.zeros(len(a), dtype=np.int64)
            for step in range(1, m):  # the chain's first segment is the bucket's
                total += np.bitwise_count(diff & masks[(start + step) % m])
                near = total <= (step + 1) * max_bits // m
                a, diff, start, total = a[near], diff[near], start[near], total[near]
            a = a[np.bitwise_count(diff) <= max_bits]
            while len(a):  # hook the larger root to the smaller one, until all agree
                x, y = root[a], root[a + lag]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while not np.array_equal(up := root[root], root):
                    root = up
                a = a[root[a] != root[a + lag]]
        lag += 1


def links(fps: DataFrame, max_bits: int, m: int, bucket_limit: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints that span the same components
    as all pairs at ``max_bits`` or fewer differing bits."""
    if m <= max_bits:
        raise ValueError("more segments than differing bits are needed")
    at = [
        F.struct(F.lit(i).alias("seg"), F.shiftrightunsigned(F.col("fp").bitwiseAND(F.lit(signed(_mask(*s)))), s[0]).alias("part"))
        for i, s in enumerate(segments(m))
    ]
    rows = fps.select("fp", F.explode(F.array(*at)).alias("s")).select("fp", "s.seg", "s.part")
    sizes = rows.groupBy("seg", "part").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(rows.join(sizes, ["seg", "part"]), "buckets")

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_runs(parts, ["seg", "part"]):
            seg, fp = part["seg"].to_numpy(), part["fp"].to_numpy()
            changed = (np.diff(seg) != 0) | (np.diff(part["part"].to_numpy()) != 0)
            bucket = np.cumsum(np.append(True, changed))
            root = ring_links(seg, fp.view(np.uint64), bucket, max_bits, m)
            linked = np.flatnonzero(root != np.arange(len(root)))
            yield pd.DataFrame({"a": fp[linked], "b": fp[root[linked]]})

    small = shared.where(F.col("n") <= bucket_limit).repartition("seg", "part").sortWithinPartitions("seg", "part")
    pairs = small.select("seg", "part", "fp").mapInPandas(run, "a long, b long")

    whole = (1 << BITS) - 1
    zeroed = [
        (i, signed(whole ^ sum(1 << b for b in bits)))
        for i, s in enumerate(segments(m))
        for bits in combinations([b for b in range(BITS) if not s[0] <= b < s[0] + s[1]], max_bits)
    ]
    masks = fps.sparkSession.createDataFrame(zeroed, "seg int, mask long")  # a fixed number of rows
    large = shared.where(F.col("n") > bucket_limit).join(F.broadcast(masks), "seg")
    large = large.select("mask", "seg", F.col("fp").bitwiseAND(F.col("mask")).alias("rest"), "fp")
    first = large.groupBy("mask", "seg", "rest").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
    met = large.join(first.where("lo < hi"), ["mask", "seg", "rest"]).where("fp > lo")
    return pairs.unionByName(met.select(F.col("fp").alias("a"), F.col("lo").alias("b")))


def labelled(docs: DataFrame, shingle: int, max_bits: int, ring: int, bucket_limit: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, content, fp, label, component_id) of each row; label: the
    component's least fingerprint."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    label = components(links(distinct.select("fp"), max_bits, ring, bucket_limit))
    known = distinct.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = known.groupBy("label").agg(F.min("least").alias("component_id"))
    return prints.join(known.select("fp", "label").join(named, "label"), "fp")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    ring: int = 3,
    bucket_limit: int = 8192,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex) and component_id, the
    smallest id that links of ``max_bits`` or fewer differing bits reach."""
    found = labelled(docs, shingle, max_bits, ring, bucket_limit, id_col, text_col)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    ring: int = 3,
    bucket_limit: int = 8192,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each component, all columns: that of the smallest id (a null id
    only if there is no other; of rows with the same id and text, any one)."""
    found = labelled(docs, shingle, max_bits, ring, bucket_limit, id_col, text_col)
    least = found.groupBy("label").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "content")).alias("m"))
    *key, nth = fresh_names(docs, "_id", "_content", "_none", "_n")
    kept = least.select(F.coalesce("m.doc_id", F.lit(0)), "m.content", "m.none").toDF(*key)
    own = (F.coalesce(F.col(id_col).cast("long"), F.lit(0)), content_of(text_col), F.isnull(id_col))
    rows = docs.select("*", *(c.alias(k) for c, k in zip(own, key, strict=True)))
    same = Window.partitionBy(*key).orderBy(F.lit(0))
    return rows.join(kept, key, "left_semi").withColumn(nth, F.row_number().over(same)).where(F.col(nth) == 1).drop(*key, nth)
