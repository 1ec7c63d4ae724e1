"""Karmarkar-Karp sharding: whole groups, near-equal bytes, gapless slots."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from candlewick.llm import sharding
from candlewick.llm.queries import op8_sharding

SCHEMA = "doc_id long, text string, shard string, slot int"


def check(rows, docs, shards=16, tolerance=0.01):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    of = defaultdict(set)
    total, slots = Counter({s: 0 for s in range(shards)}), defaultdict(list)
    for r in rows:
        of[(r.size, r.text_crc32)].add(r.shard)
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(x) == 1 for x in of.values()) and set(total) == set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    copies = Counter((t or "") for _, t in docs)
    largest = max(n * (len(t.encode()) + 1) for t, n in copies.items())
    mean = sum(total.values()) / shards
    assert max(total.values()) <= max(largest, mean) * (1 + tolerance)


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = op8_sharding(spark, sf).collect()
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    check(rows, docs)


@pytest.mark.parametrize("limits", [{}, {"task_groups": 10, "fan": 3, "loose": 4, "slot_rows": 2}])
def test_written_rows(spark, limits):
    rng = np.random.default_rng(5)
    docs = [(i, "x" * int(n)) for i, n in enumerate(rng.integers(1, 3000, 150))] + [(900 + i, "copy" * 500) for i in range(40)]
    docs += [(2000, None), (2001, ""), (2001, ""), (None, "null id"), (2002, "long " * 20_000)]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], SCHEMA)
    check(sharding.sharded(df, shards=4, **limits).collect(), docs, shards=4, tolerance=0.03)


def test_differencing_of_a_known_case():
    found = sharding.differenced([[(n, [n]), (0, None)] for n in (8, 7, 6, 5, 4)])
    assert sorted(n for n, _ in found) == [14, 16]
    assert sorted(x[0] for _, t in found for x in sharding.members(t)) == [4, 5, 6, 7, 8]


def test_empty_table(spark):
    assert sharding.sharded(spark.createDataFrame([], SCHEMA)).count() == 0
