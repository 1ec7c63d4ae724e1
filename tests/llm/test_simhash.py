"""SimHash near-duplicates against all pairs."""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np
import pytest
import xxhash

from candlewick.llm import simhash
from candlewick.llm.components import components
from candlewick.llm.queries import op7_simhash

SCHEMA = "doc_id long, text string, fp string, label int"


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    rows = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, bits=2):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = np.array(sorted(set(fps)), dtype=np.uint64)
    for i, f in enumerate(keys):
        for g in keys[i + 1 :][np.bitwise_count(keys[i + 1 :] ^ f) <= bits]:
            parent[find(int(g))] = find(int(f))
    least = {}
    for d, f in zip(ids, fps, strict=True):
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [least.get(find(f)) for f in fps]


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_print(r.text) for r in rows]
    want = plain_components([r.doc_id for r in rows], fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op7_simhash(spark, sf).collect()}
    assert got == {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, want, strict=True)}


def planted(seed, n):
    """Numbers of which many are a few bits apart, in chains too."""
    rng = np.random.default_rng(seed)
    out = [int(x) for x in rng.integers(0, 2**63, n, dtype=np.uint64)]
    for _ in range(3 * n):
        x = out[rng.integers(len(out))]
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            x ^= 1 << int(b)
        out.append(x)
    return out


@pytest.mark.parametrize("limit", [8192, 2])
@pytest.mark.parametrize(("bits", "ring"), [(2, 3), (2, 4), (1, 2)])
def test_links_span_the_components_of_all_pairs(spark, limit, bits, ring):
    fps = sorted(set(planted(bits * 10 + ring, 40)))
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    label = {r.node: r.label for r in components(simhash.links(df, bits, ring, limit)).collect()}
    got = [label.get(simhash.signed(f), simhash.signed(f)) for f in fps]
    want = plain_components([simhash.signed(f) for f in fps], fps, bits)
    assert got == want


def test_cases(spark):
    long = "word " * 50_000
    rows = [
        (5, None, "x", 1), (3, "", "x", 1), (9, " \t\n", "x", 1), (4, "One Two", None, None), (7, "one  two", "", 1),
        (8, long, "", 1), (8, long, "", 1), (None, "only null ids here", "", 1), (None, "One two", "", 1),
    ]
    got = [tuple(r) for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    zero = "0" * 16
    want = [(5, zero, 3), (3, zero, 3), (9, zero, 3)]
    two = f"{plain_print('one two'):016x}"
    want += [(4, two, 4), (7, two, 4), (None, two, 4)]
    want += [(8, f"{plain_print(long):016x}", 8)] * 2
    want += [(None, f"{plain_print('only null ids here'):016x}", None)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    kept = simhash.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "fp", "label"]
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == [(3, ""), (4, "One Two"), (8, long)]
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["only null ids here"]


def test_components_of_a_long_chain(spark):
    chain = list(pairwise(np.random.default_rng(1).permutation(200).tolist())) + [(500, 501), (501, 500), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "x long, y long")).collect()}
    assert got == {i: 0 for i in range(200)} | {500: 500, 501: 500}
