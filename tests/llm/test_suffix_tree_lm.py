"""Suffix-tree scores against a plain tree, and the unigram base."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from candlewick.llm import suffix_tree_lm as lm
from candlewick.llm.common import held_out
from candlewick.llm.queries import op10_suffix_tree_lm

SCHEMA = "doc_id long, text string, score string, chunk int"


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def out_of_training(i, mod, rest):
    return i is not None and zlib.crc32(str(i).encode()) % mod == rest


def plain_base(docs, mod, rest):
    c = Counter()
    for i, t in docs:
        if not out_of_training(i, mod, rest):
            c.update([*words_of(t), "\n"])
    n, v = sum(c.values()), len(c)
    rows = []
    for i, t in docs:
        own = [*words_of(t), "\n"]
        rows.append((i, len(own), sum(c[w] > 0 for w in own), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)))
    return rows


def plain_tree(docs, mod, rest, depth, min_count, divergence):
    counts = [defaultdict(Counter) for _ in range(depth + 1)]
    for i, t in docs:
        if not out_of_training(i, mod, rest):
            b = b"\n" * depth + " ".join(words_of(t)).encode() + b"\n"
            for p in range(depth, len(b)):
                for d in range(depth + 1):
                    counts[d][b[p - d : p]][b[p]] += 1
    for level in counts:
        for u in [u for u, c in level.items() if sum(c.values()) < min_count and u]:
            del level[u]

    def chance(u, s):
        c = counts[len(u)].get(u, {})
        n, k = sum(c.values()), len(c)
        lower = chance(u[1:], s) if u else 1 / 256
        return (c.get(s, 0) + k * lower) / (n + k) if n else lower

    kept = {b""}
    for level in counts[1:]:
        for u, c in level.items():
            if sum(n * math.log(chance(u, s) / chance(u[1:], s)) for s, n in c.items()) >= divergence:
                kept |= {u[k:] for k in range(len(u))}

    def score(t):
        b = b"\n" * depth + " ".join(words_of(t)).encode() + b"\n"
        out = 0.0
        for p in range(depth, len(b)):
            u = next(b[p - d : p] for d in range(depth, -1, -1) if b[p - d : p] in kept)
            out += math.log10(chance(u, b[p]))
        return out

    return [score(t) for _, t in docs], chance


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in op10_suffix_tree_lm(spark, sf).collect()}
    assert len(got) == len(docs)
    for i, n, known, total, base in plain_base(docs, 7, 2):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out_of_training(i, 7, 2), n, known, total)
        assert r.base_score == pytest.approx(base)


def test_beats_the_base_on_held_out_rows(spark):
    got = op10_suffix_tree_lm(spark, "/root/testdata/sf0.1").where("held_out").selectExpr("sum(score) s", "sum(base_score) b", "avg(int(score > base_score)) n").first()
    assert got.s > got.b and got.n > 0.8


@pytest.mark.parametrize("limits", [{"depth": 3, "min_count": 4, "divergence": 2.0}, {"depth": lm.DEPTH, "min_count": lm.MIN_COUNT, "divergence": 6.0}])
@pytest.mark.parametrize("chunk_bytes", [16_000_000, 200])
def test_scores_of_a_plain_tree(spark, monkeypatch, chunk_bytes, limits):
    monkeypatch.setattr(lm, "BUCKET_ROWS", chunk_bytes // 10)
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(["the", "a", "on", "é", "ing", "X"], rng.integers(1, 4)))
    docs = [(i, " ".join(word() for _ in range(rng.integers(0, 40)))) for i in range(40)]
    docs += [(50, None), (51, ""), (51, ""), (None, "The  null\tid"), (52, "unseen zq \x00\U0001f600"), (53, "on " * 20_000)]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], SCHEMA)
    got = sorted((tuple(r) for r in lm.scored(df, held_out(7, 2), chunk_bytes=chunk_bytes, **limits).collect()), key=str)
    scores, chance = plain_tree(docs, 7, 2, **limits)
    want = sorted(((*r, s) for r, s in zip(plain_base(docs, 7, 2), scores, strict=True)), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[4:] == pytest.approx(w[4:])
    assert sum(chance(b"on", s) for s in range(256)) == pytest.approx(1)


def test_no_training_and_no_rows(spark):
    held = next(i for i in range(99) if out_of_training(i, 7, 2))
    df = spark.createDataFrame([(held, "two words", "", 1)], SCHEMA)
    r = lm.scored(df, held_out(7, 2)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.score == pytest.approx(-10 * math.log10(256))
    assert r.base_score == 0
    assert lm.scored(df.limit(0), held_out(7, 2)).count() == 0


def test_rare_contexts_stay_in_a_large_corpus(spark):
    ids = (i for i in itertools.count(1) if not out_of_training(i, 7, 2))
    rare = "zqxjkvwbpf"
    for copies in (1, 300):
        docs = [(next(ids), rare, "", 1) for _ in range(5)] + [(next(ids), "on the way to " * 1_000, "", 1) for _ in range(copies)]
        got = lm.scored(spark.createDataFrame(docs, SCHEMA), held_out(7, 2)).collect()
        assert all(r.score > -8 for r in got if r.n_tokens == 2)


def test_six_symbols_back_are_seen(spark):
    ids = [i for i in range(1, 99) if not out_of_training(i, 7, 2)]
    texts = ["pabcdeq", "rabcdes"] * 20 + ["pabcdes"]
    got = lm.scored(spark.createDataFrame([(i, t, "", 1) for i, t in zip(ids, texts, strict=False)], SCHEMA), held_out(7, 2))
    score = {r.doc_id: r.score for r in got.collect()}
    assert score[ids[0]] > score[ids[40]] + 0.5


def test_keys_of_a_chunk_are_small_and_counted(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 7))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words, 400)) for _ in range(200)]
    rows = spark.createDataFrame([(i, t, i % 4 == 0) for i, t in enumerate(texts)], "doc_id long, text string, held boolean").coalesce(1)
    lists = [r for r in lm.with_keys(rows, 6, 3, 10**9).collect() if r.bucket >= 0]
    got, size = {}, 0
    for r in lists:
        size += len(r.codes)
        got |= dict(zip(lm.turned(lm.unpacked_keys(r.codes), 6).tolist(), lm.of_planes(r.code_counts, np.uint32).tolist(), strict=True))
    want = Counter(dict.fromkeys(lm.codes([t.encode() for t in texts], 6)[0].tolist(), 0))
    want.update(lm.codes([t.encode() for i, t in enumerate(texts) if i % 4], 6)[0].tolist())
    assert got == dict(want) and {r.chunk for r in lists} == {0}
    assert size < 4 * len(got)


def test_large_ids_beside_null_ids(spark):
    ids = [None, 2**60 + 1, 2**60 + 3, -(2**62) - 1]
    got = lm.scored(spark.createDataFrame([(i, "some words", "", 1) for i in ids], SCHEMA).coalesce(1), held_out(7, 2)).collect()
    assert {r.doc_id for r in got} == set(ids)
