"""Divergence of sources by a frequent-pattern tree of term rows.

Terms are runs of ASCII letters and other non-ASCII code points, A-Z in small. Each
language keeps the terms that ``least_docs`` of its documents hold or more. A group,
the documents of a language and source, gives a kept term that occurs ``count`` times in
it the price p = 1 + floor(``unit`` * (count + 1) / (N + V)), N being the group's
occurrences of kept terms and V their number; the language as a whole does likewise. Two
prices differ by f(p, q) = floor((p - q)^2 / q).

The audit ranks, for each group, the other sources of its language by the sum of f over
all kept terms, and its ``top`` terms that are dearer than in the language by f.

Most terms are missing from most sources, so the sums start from the prices of missing
terms, V times, and add corrections: one for the terms a group has, by price, and one for
each pair of sources that both have a term. For the latter a term is a row of its
(source, price) where it occurs, sources in the order of their size; equal rows are
counted once, with their multiplicity, and sorted rows are put into a tree whose nodes
count the rows through them. A row shares the nodes of its beginning with others,
and each node adds its correction with each of its ancestors once, times its count.
A task builds the trees of its range of sorted rows batch by batch and passes on sums
per pair of sources.

All arithmetic is of whole numbers. A null text, lang or source is taken as ''; empty
and very long texts count as any other; repeated rows count each; a group without kept
terms has N = 0, and a language without any has the sum 0 for all pairs. Equal values
rank by the item's UTF-8. An empty table gives an empty one. Other columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import ready_workers, stored

LEAST_DOCS = 3
TOP = 200
UNIT = 1_000_000_000
#: Distinct terms of sources that a worker counts before it passes them on.
HELD_TERMS = 400_000
#: What a document with a term adds to its held number, above the occurrences.
DOC = 1 << 40
#: Pairs of a node and an ancestor that a worker corrects at a time.
HELD_PAIRS = 1_000_000

#: ASCII letters in small and all bytes of other code points; the rest as a space.
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents with the term."""
    ready_workers(docs.sparkSession)

    def rows(held: dict[tuple[str, str], dict[bytes, int]]) -> Iterator[pd.DataFrame]:
        for (lang, source), found in held.items():
            if found:
                terms = [t.decode() for t in found]
                n, df = [x % DOC for x in found.values()], [x // DOC for x in found.values()]
                yield pd.DataFrame({"lang": lang, "source": source, "term": terms, "n": n, "docs": df})

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], dict[bytes, int]] = {}
        size = 0
        for part in parts:
            for lang, source, text in zip(part["lang"], part["source"], part["text"], strict=True):
                own = held.setdefault((lang, source), {})
                before, known = len(own), own.get
                for term, n in Counter(terms_of(text)).items():
                    own[term] = known(term, 0) + n + DOC
                size += len(own) - before
                if size > HELD_TERMS:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    found = docs.select("lang", "source", "text").mapInPandas(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(count: Column, total: Column, terms: Column, unit: int = UNIT) -> Column:
    """1 + floor(unit * (count + 1) / (total + terms)), exact: in longs where the product
    is one, else in decimals."""
    share = F.lit(unit).cast("decimal(11,0)") * (count + 1).cast("decimal(20,0)")
    large = F.call_function("div", share, (total + terms).cast("decimal(20,0)"))
    small = F.call_function("div", F.lit(unit).cast("long") * (count + 1), total + terms)
    return F.when(count < F.lit((1 << 62) // unit), small).otherwise(large) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); prices are at most the unit and 1, so it fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def tree_nodes(offset: np.ndarray, item: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nodes of the tree of sorted rows: where each first stands among the items,
    its depth, and the count of rows through it.

    ``offset`` bounds the rows among the items (one number per item, equal where the
    items are); ``times`` is the multiplicity of each row.
    """
    size = np.diff(offset)
    row = np.repeat(np.arange(len(size)), size)
    depth = np.arange(len(item)) - np.repeat(offset[:-1], size)
    above = offset[np.maximum(row - 1, 0)] + depth  # the item at this depth in the row before
    same = (row > 0) & (depth < size[np.maximum(row - 1, 0)])
    same[same] = item[same] == item[above[same]]
    shared = np.where(same, len(item), depth)
    shared = np.minimum.reduceat(shared, offset[:-1]) if len(size) else size
    shared = np.minimum(shared, size)  # symbols of the beginning that a row has from the one before
    before = np.append(0, np.cumsum(times))
    at, deep, count, path = [], [], [], []
    for i, (s, n, start) in enumerate(zip(shared.tolist(), size.tolist(), offset[:-1].tolist(), strict=True)):
        for node in path[s:]:
            count[node] = before[i] - count[node]
        del path[s:]
        for j in range(s, n):
            path.append(len(at))
            at.append(start + j)
            deep.append(j)
            count.append(before[i])
    for node in path:
        count[node] = before[-1] - count[node]
    return np.array(at, dtype=np.int64), np.array(deep, dtype=np.int64), np.array(count, dtype=np.int64)


def corrections(at: np.ndarray, deep: np.ndarray, count: np.ndarray, pos: np.ndarray, p: np.ndarray, p0: np.ndarray) -> Iterator[tuple]:
    """(source, other, value) sums of what each node adds with each of its ancestors,
    in both directions."""
    ends = np.cumsum(deep)
    start = 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + HELD_PAIRS, "right")))
        n = deep[start:stop]
        x = np.repeat(at[start:stop], n)
        y = x - np.repeat(n, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        m = np.repeat(count[start:stop], n)
        start = stop
        for a, b in ((x, y), (y, x)):
            value = m * (gap(p[a], p[b]) - gap(p[a], p0[b]) - gap(p0[a], p[b]) + gap(p0[a], p0[b]))
            key = pos[a].astype(np.int64) << 32 | pos[b]
            order = np.argsort(key, kind="stable")
            if len(order):
                first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
                found = key[order][first]
                yield found >> 32, found & 0xFFFFFFFF, np.add.reduceat(value[order], first)


def pair_corrections(rows: DataFrame) -> DataFrame:
    """(lang, pos, other, value): what terms that both sources have add to their sums,
    from rows (lang, row, times), sorted within partitions."""
    out = pa.schema([("lang", pa.string()), ("pos", pa.int64()), ("other", pa.int64()), ("value", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_numpy(zero_copy_only=False)
            border = np.flatnonzero(np.append(True, langs[1:] != langs[:-1])) if len(langs) else np.zeros(0, np.int64)
            for a, b in zip(border, np.append(border[1:], len(langs)), strict=True):
                part = batch.slice(int(a), int(b - a))
                row = part.column("row")
                flat = row.flatten()
                offset = row.offsets.to_numpy().astype(np.int64)
                pos, p, p0 = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pos", "p", "p0"))
                item = pos << 31 | p  # prices are below 2^31
                nodes = tree_nodes(offset - offset[0], item, part.column("times").to_numpy(zero_copy_only=False))
                for g, h, value in corrections(*nodes, pos, p, p0):
                    yield pa.RecordBatch.from_arrays([pa.array([langs[a]] * len(g), pa.string()), pa.array(g), pa.array(h), pa.array(value)], schema=out)

    found = rows.mapInArrow(run, "lang string, pos long, other long, value long")
    return found.groupBy("lang", "pos", "other").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))


def source_pairs(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """lang, source, item, value: the sum of f over all kept terms for every two sources
    of a language. ``kept`` has the prices of the terms that groups hold, ``sizes`` the groups."""
    items = kept.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("pos", "p", "p0"))).alias("row"))  # one per source
    rows = items.groupBy("lang", "row").agg(F.count("*").alias("times"))
    both = pair_corrections(rows.repartitionByRange("lang", "row").sortWithinPartitions("lang", "row"))

    many = F.lit(0).cast("decimal(38,0)")
    other = sizes.select("lang", F.col("source").alias("item"), F.col("pos").alias("other"), F.col("p0").alias("q0"), "terms")
    one = kept.groupBy("lang", "pos", "p", "p0").agg(F.count("*").cast("decimal(20,0)").alias("times")).join(other.drop("terms"), "lang")
    one = one.where("pos <> other")
    base = {True: apart(F.col("p0"), F.col("q0")), False: apart(F.col("q0"), F.col("p0"))}
    there = one.groupBy("lang", "pos", "other").agg(
        F.sum(F.col("times") * (apart(F.col("p"), F.col("q0")) - base[True]).cast("decimal(18,0)")).alias("value"),
        F.sum(F.col("times") * (apart(F.col("q0"), F.col("p")) - base[False]).cast("decimal(18,0)")).alias("back"),
    )
    parts = both.unionByName(there.select("lang", "pos", "other", F.col("value").cast("decimal(38,0)").alias("value")))
    parts = parts.unionByName(there.select("lang", F.col("other").alias("pos"), F.col("pos").alias("other"), F.col("back").cast("decimal(38,0)").alias("value")))
    sums = parts.groupBy("lang", "pos", "other").agg(F.sum("value").alias("value"))
    pairs = sizes.select("lang", "source", "pos", "p0").join(other, "lang").where("pos <> other").join(sums, ["lang", "pos", "other"], "left")
    whole = F.col("terms").cast("decimal(19,0)") * base[True].cast("decimal(18,0)") + F.coalesce("value", many)
    return pairs.select("lang", "source", "item", F.when(F.col("terms") > 0, whole).otherwise(many).cast("long").alias("value"))


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, unit: int = UNIT, text_col: str = "text") -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank."""
    empty = F.lit("")
    docs = docs.select(*(F.coalesce(F.col(c), empty).alias(c) for c in ("lang", "source")), F.col(text_col).alias("text"))
    counts = stored(term_counts(docs), "terms")
    vocabulary = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least_docs)
    vocabulary = stored(vocabulary.drop("docs"), "vocabulary")
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    priced = vocabulary.join(langs, "lang").select("lang", "term", price(F.col("lang_n"), F.col("lang_total"), F.col("terms"), unit).alias("q"))
    held = stored(counts.drop("docs").join(priced, ["lang", "term"]), "held")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    sizes = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    sizes = sizes.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "terms")))
    by_size = Window.partitionBy("lang").orderBy(F.col("total").desc(), "source")
    p0 = F.when(F.col("terms") > 0, price(zero, F.col("total"), F.greatest("terms", F.lit(1)), unit)).otherwise(1)
    sizes = stored(sizes.select("*", p0.alias("p0"), F.row_number().over(by_size).alias("pos")), "sizes")
    own = price(F.col("n"), F.col("total"), F.col("terms"), unit)
    kept = held.join(sizes, ["lang", "source"]).select("lang", "source", "term", "pos", "p0", own.alias("p"), "q")
    kept = stored(kept, "kept")
    dearer = kept.where("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    best = ranked(dearer, "term").where(F.col("rank") <= top)
    return ranked(source_pairs(kept, sizes), "pair").unionByName(best)
