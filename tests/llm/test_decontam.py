"""Decontamination against comparing every item with every place."""

from __future__ import annotations

import itertools
import math
import re

import numpy as np

from candlewick.llm import decontam
from candlewick.llm.queries import op3_decontam

DOCS = "doc_id long, text string, item_id string, overlap_words int"
ITEMS = "item_id long, text string, doc_id int"


def words_of(text):
    spaced = re.sub("([ぁ-ヿ一-鿿])", r" \1 ", (text or "").lower())
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", spaced)


def plain(docs, items, min_words=13, agree=0.8, least=1):
    out = []
    for d, text in docs:
        own = words_of(text)
        for i, other in items:
            it = words_of(other)
            width = min(min_words, len(it))
            if len(it) < min_words and len(it) < least:
                continue
            need = math.ceil(agree * width) if len(it) >= min_words else width
            inside = set()
            for off in range(-len(it), len(own)):
                eq = [0 <= off + k < len(own) and own[off + k] == w for k, w in enumerate(it)]
                for k in range(len(it) - width + 1):
                    if 0 <= off + k and off + k + width <= len(own) and sum(eq[k : k + width]) >= need:
                        inside |= set(range(k, k + width))
            if inside:
                out.append((d, i, len(inside), len(it)))
    return sorted(out, key=str)


def test_masks_meet_two_changes_in_thirteen():
    for gone in itertools.combinations(range(13), 2):
        assert any(
            not any(c == "1" and o + i in gone for i, c in enumerate(m)) for m in decontam.MASKS for o in range(14 - len(m))
        )


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    short = [(d, t) for d, t in docs if len(t) < 1500]
    got = sorted((tuple(r) for r in op3_decontam(spark, sf).collect()), key=str)
    ids = {d for d, _ in short}
    assert [g for g in got if g[0] in ids] == plain(short, items)


def written():
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgé"), 4))
    items = [[word() for _ in range(n)] for n in (5, 9, 12, 13, 20, 40, 40)]
    docs = []
    for it in items * 3:
        cut = it[int(rng.integers(0, max(1, len(it) - 13))) :]
        for _ in range(int(rng.integers(0, 4))):
            cut[rng.integers(len(cut))] = word()
        docs.append(" ".join([word() for _ in range(rng.integers(0, 9))] + cut + [word() for _ in range(rng.integers(0, 9))]))
    docs += [" ".join(items[5] + items[6]).upper().replace(" ", ", "), " ".join(items[3][:7]), "", None, "a"]
    return docs, [" ".join(i) for i in items] + ["", None]


def test_written_texts(spark):
    docs, items = written()
    doc_rows = [(i if i % 9 else None, t, "x", 1) for i, t in enumerate(docs)]
    item_rows = [(i if i else None, t, 7) for i, t in enumerate(items)] + [(3, items[3], 1)]
    df, it = spark.createDataFrame(doc_rows, DOCS), spark.createDataFrame(item_rows, ITEMS)
    want = plain([r[:2] for r in doc_rows], [r[:2] for r in item_rows])
    assert len(want) > 10
    for size in (8_000_000, 300):
        got = sorted((tuple(r) for r in decontam.overlaps(df, it, block_bytes=size).collect()), key=str)
        assert got == want
    bad = {d for d, *_ in plain(list(enumerate(docs)), list(enumerate(items)))}
    kept = decontam.without_overlaps(df, it, block_bytes=300)
    assert kept.columns == df.columns
    assert sorted((r.text for r in kept.collect()), key=str) == sorted((t for i, t in enumerate(docs) if i not in bad), key=str)


def test_empty_tables(spark):
    docs, items = written()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], DOCS)
    it = spark.createDataFrame([(i, t, 7) for i, t in enumerate(items)], ITEMS)
    assert decontam.overlaps(df.limit(0), it).count() == decontam.overlaps(df, it.limit(0)).count() == 0
    assert decontam.without_overlaps(df, it.limit(0)).count() == len(docs)


def test_short_items_of_any_script_occur_whole(spark):
    items = [(1, "two words"), (2, "One"), (3, "東京は日本の首都です"), (4, ""), (5, None)]
    docs = [(1, "here are two, words"), (2, "two other words, onerous"), (3, "多分、東京は日本の首都ですね。"), (4, "東京は日本"), (5, "one")]
    got = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = sorted(tuple(r) for r in got.collect())
    assert found == plain(docs, items) == [(1, 1, 2, 2), (3, 3, 10, 10), (5, 2, 1, 1)]


def test_frames_that_were_read_elsewhere(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert decontam.overlaps(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).count() > 0
