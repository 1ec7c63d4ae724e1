"""Shards of near-equal bytes by Karmarkar-Karp differencing.

Rows of equal texts are a group that stays together. Each group starts as a
partial partition: its bytes in one shard, nothing in the others. The two
partial partitions with the largest spread between shards are combined in
opposite order, the fullest shard of one with the emptiest of the other, until
one is left. What one task can take is combined by one task. More groups are
dealt to tasks by hash: each combines its own into ``finer`` times as many
bundles as there are shards and leaves its ``loose`` smallest groups as they
are; the bundles are dealt again, ``fan`` tasks' to one, until one task is left
and combines them into the shards. So a group larger than a shard's share stays
alone, and the small groups even out what the bundles leave.

Null texts have no bytes; every row counts one byte more than its text. Null
and empty texts are equal. Repeated rows are members of their group like any
other. An empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import stored

#: Rows numbered by one task.
SLOT_ROWS = 200_000


def differenced(parts: list[list[tuple[int, object]]]) -> list[tuple[int, object]]:
    """One partition of partial ones: (bytes, members) for each shard, members a
    tree of pairs. Ties go by the order of the list."""
    heap: list[tuple[int, int, list[tuple[int, object]]]] = []
    for i, part in enumerate(parts):
        part = sorted(part, key=lambda x: -x[0])
        heap.append((part[-1][0] - part[0][0], i, part))
    heapq.heapify(heap)
    made = len(parts)
    while len(heap) > 1:
        (_, _, a), (_, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = [(x + y, (m, n) if m and n else m or n) for (x, m), (y, n) in zip(a, reversed(b), strict=True)]
        both.sort(key=lambda x: -x[0])
        heapq.heappush(heap, (both[-1][0] - both[0][0], made, both))
        made += 1
    return heap[0][2]


def members(tree: object) -> Iterator[object]:
    """Leaves of a tree of pairs; a leaf is a list."""
    todo = [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo += x
        elif x:
            yield x


def _bundled(ways: int, loose: int, given: list[str], part: str, to: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For the rows of one task, of columns ``given`` and bytes: the bundle, of so
    many ``ways``, that each goes to. The smallest rows, ``loose`` of them, make a
    bundle each, for the fine balance of later rounds."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bytes", *given], ignore_index=True)
        leaves = list(zip(zip(*(rows[c] for c in given), strict=True), rows["bytes"].tolist(), strict=True))
        name = int(rows[part].iloc[0])
        found = [(*leaf, name, ways + i, n) for i, (leaf, n) in enumerate(leaves[:loose])]
        if rest := [[(n, [leaf])] + [(0, None)] * (ways - 1) for leaf, n in leaves[loose:]]:
            found += [(*x[0], name, i, n) for i, (n, tree) in enumerate(differenced(rest)) for x in members(tree)]
        return pd.DataFrame(found, columns=[*given, part, to, "bytes"])

    return run


def assigned(groups: DataFrame, shards: int, task_groups: int, fan: int, finer: int, loose: int) -> DataFrame:
    """(key, shard) of groups given by (key, bytes)."""
    tasks, ways = max(1, math.ceil(groups.count() / task_groups)), finer * shards

    def dealt(rows: DataFrame, given: list[str], kinds: str, to: str) -> DataFrame:
        run = _bundled(shards, 0, given, "part", to) if tasks == 1 else _bundled(ways, loose, given, "part", to)
        return rows.groupBy("part").applyInPandas(run, f"{kinds}, part long, {to} int, bytes long")

    where = stored(dealt(groups.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(tasks))), ["key"], "key binary", "slot"), "bundles")
    while tasks > 1:
        tasks = math.ceil(tasks / fan)
        bundles = where.select(F.col("part").alias("from"), "slot", "bytes").distinct().withColumn("part", F.pmod("from", F.lit(tasks)))
        moved = dealt(bundles, ["from", "slot"], "from long, slot int", "to")
        where = where.select("key", F.col("part").alias("from"), "slot").join(moved, ["from", "slot"])
        where = stored(where.select("key", "part", F.col("to").alias("slot"), "bytes"), "bundles")
    return where.select("key", F.col("slot").alias("shard"))


def sharded(
    docs: DataFrame,
    shards: int = 16,
    task_groups: int = 20_000,
    fan: int = 50,
    finer: int = 8,
    loose: int = 500,
    slot_rows: int = SLOT_ROWS,
    text_col: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (from 0 without gaps in a shard) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.unhex(F.md5(text)).alias("key"),
    )
    rows = stored(rows, "sizes")
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    placed = rows.join(assigned(groups, shards, task_groups, fan, finer, loose), "key")
    blocks = max(1, math.ceil(rows.count() / (shards * slot_rows)))
    placed = stored(placed.withColumn("block", F.pmod(F.xxhash64("doc_id", "key"), F.lit(blocks))), "placed")
    sizes = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("shard", "block").orderBy("doc_id", "key")
    numbered = placed.withColumn("place", F.row_number().over(own) - 1).join(starts, ["shard", "block"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).cast("long").alias("slot"))
