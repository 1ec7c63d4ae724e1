"""Removal of repeated strings against a plain search."""

from __future__ import annotations

import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from candlewick.llm import suffix_dedup
from candlewick.llm.queries import op9_suffix_dedup

SCHEMA = "doc_id long, text string, n_bytes string, _note int"


def plain(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def made(spark, rows, **limits):
    df = spark.createDataFrame(rows, SCHEMA)
    return [tuple(r) for r in suffix_dedup.removal_digests(df, **limits).collect()]


def check(spark, rows, length, **limits):
    got = made(spark, rows, length=length, **limits)
    want = [(r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows], length), strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: p for r, p in zip(rows, plain([r[1] for r in rows], 400), strict=True)}
    assert {r[0]: tuple(r)[1:] for r in op9_suffix_dedup(spark, sf).collect()} == want


def written(seed, n=60):
    """Texts that share passages in other surroundings, some periodic, some copied."""
    rng = np.random.default_rng(seed)
    letter = lambda k: "".join(rng.choice(list("abcdeé "), k))
    passages = [letter(int(k)) for k in rng.integers(60, 300, 6)]
    out = [letter(int(rng.integers(0, 80))) + passages[rng.integers(6)] * int(rng.integers(0, 3)) + letter(int(rng.integers(0, 200))) for _ in range(n)]
    return out + out[:5] + ["ab" * 300, "x" * 500, "x" * 100, "", None, "short"]


@pytest.mark.parametrize("limits", [{}, {"shard_segments": 2}, {"shard_bytes": 3000}])
def test_written_texts(spark, limits):
    texts = written(len(limits) + 3)
    rows = [(i if i % 7 else None, t, "clash", i) for i, t in enumerate(texts)]
    check(spark, [*rows, rows[3]], 100, **limits)


def test_long_text_and_slices(spark, monkeypatch):
    rng = np.random.default_rng(8)
    long = "".join(rng.choice(list("abc"), 30_000))
    monkeypatch.setattr(suffix_dedup, "SLICE", 1000)
    texts = [long + long[:700], long[500:900] + "zz" + long[20_000:21_000]]
    got = [r for block in suffix_dedup.slices([t.encode() for t in texts], 400) for r in block]
    assert all(len(p) <= 1399 for _, _, p in got)
    check(spark, [(i, t, "", 1) for i, t in enumerate(texts)], 400)


def test_texts_after_removal(spark):
    shared = "".join(np.random.default_rng(2).choice(list("abcdé"), 500))
    rows = [(1, "before " + shared, "n", 1), (2, shared + " after", None, 2), (3, "clean", "", 3), (4, None, "", 4)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "n_bytes", "_note"]
    assert {r.doc_id: r.text for r in got.collect()} == {1: "before ", 2: " after", 3: "clean", 4: None}


def test_empty_table(spark):
    assert made(spark, []) == []


def test_a_worker_holds_few_arrays_at_a_time():
    texts = ["".join(np.random.default_rng(i).choice(list("abcdefg "), 5000)).encode() for i in range(300)]
    tracemalloc.start()
    try:
        hashes = suffix_dedup.Hashes()
        for block in suffix_dedup.slices(texts, 200):
            sizes = np.array([len(t) for _, _, t in block])
            flat = np.frombuffer(b"".join(t for _, _, t in block), dtype=np.uint8)
            suffix_dedup.segments(flat, np.append(0, np.cumsum(sizes)[:-1]), sizes, 200, hashes)
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


def test_parts_of_many_texts_leave_in_few_batches(monkeypatch):
    texts = [f"é{i:05d}".encode() * 100 for i in range(600)]
    cuts = [[(i, k, i % 3, 5 * k, 450) for k in range(i % 4 + 1)] for i in range(600)]
    lists = {c: pa.array([[x[j] for x in row] for row in cuts], type=pa.list_(pa.int64())) for j, c in enumerate(suffix_dedup.CUTS)}
    batch = pa.RecordBatch.from_pydict({"text": pa.array([t.decode() for t in texts]), **lists})
    want = [(h, seg, kinds, texts[i][lo : lo + n]) for i, row in enumerate(cuts) for h, seg, kinds, lo, n in row]
    for limit, least, most in ((1_000_000, 1, 1), (100_000, 6, 8)):
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", limit)
        got = list(suffix_dedup.cut_parts([batch, batch.slice(0, 0)]))
        assert least <= sum(b.num_rows > 0 for b in got) <= most  # one of each text would be 600
        assert all(sum(map(len, b.column("part").to_pylist())) < limit + 450 for b in got)
        assert [tuple(r.values()) for b in got for r in b.to_pylist()] == want


def test_strings_of_many_parts_leave_in_few_frames():
    rng = np.random.default_rng(5)
    long = bytes(rng.integers(97, 100, 900).astype(np.uint8))
    parts = [long[a : a + 400 + a % 50] for a in range(400)]
    frame = pd.DataFrame({"h": 7, "seg": range(400), "part": parts}).astype({"h": "int64", "seg": "int64"})
    got = list(suffix_dedup.part_strings([frame, frame[:0]], 400))
    assert len(got) <= 3  # one of each part would be 400
    rows = pd.concat(got)
    assert list(zip(rows["seg"], rows["at"], strict=True)) == [(i, k) for i, p in enumerate(parts) for k in range(len(p) - 399)]
    by_hash = {}
    for seg, at, *x in rows[["seg", "at", "x", "y"]].itertuples(index=False):
        by_hash.setdefault(tuple(x), set()).add(parts[seg][at : at + 400])
    assert all(len(v) == 1 for v in by_hash.values())
    assert len(by_hash) == len({p[k : k + 400] for p in parts for k in range(len(p) - 399)})


def test_copies_of_a_row_are_cut_once(spark):
    docs = spark.createDataFrame([(1, 2, "a" * 500)] * 3 + [(4, 5, "b" * 500)], "k1 long, k2 long, text string")
    wanted = spark.createDataFrame([(1, 2, 8, 9, 2, 10, 450), (4, 5, 8, 10, 2, 0, 401)], "k1 long, k2 long, h long, seg long, kinds long, lo long, size long")
    got = sorted((r.h, r.seg, r.kinds, bytes(r.part)) for r in suffix_dedup.contested(docs, wanted).collect())
    assert got == [(8, 9, 2, b"a" * 450), (8, 10, 2, b"b" * 401)]
