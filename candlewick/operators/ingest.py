"""Idempotent loads of raw records (first write wins).

Semantics of the original loader, kept exactly:

* inside one batch the first occurrence of a key is inserted and later ones
  are skipped;
* a key already in the table is never overwritten;
* a row with a NULL key component never conflicts (NULL is not equal to
  NULL), so it is always inserted;
* a NULL ``symbol`` is rejected (the column is NOT NULL).

Scale: the raw tables are partitioned by a column derived from the key
(``open_date`` for candles and tickers, ``id_block`` for trades).  A batch is
staged once on the shared folder; the partition values of its keyed rows are
read from that copy and become a literal filter on the table (a list of up to
``MAX_TOUCHED`` values, beyond that their range), so the scan lists and reads
only the partitions that the batch can collide with.  The anti-join then runs
on the key plus that column, and only for keyed rows: rows with a NULL key
part are added as they are.  The batch's own duplicates are removed with a
per-key top-1 that is applied map-side before the shuffle.

Concurrency: a single writer per table is assumed; two simultaneous appends
of the same key could both insert it (no transactional table format here).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.schemas import RAW_KEYS, RAW_SCHEMAS
from candlewick.session import pin_conf, scratch_path, scratch_scope

TRADE_ID_BLOCK = 1_000_000  # trade ids per partition of the raw trade table
PARTITION_COLUMN = {"klines": "open_date", "trades": "id_block", "tickers": "open_date"}


def partition_value(dataset: str) -> Column:
    """Key-derived partition column of a raw table."""
    if dataset == "trades":
        return F.floor(F.col("trade_id") / F.lit(TRADE_ID_BLOCK)).cast("long")
    return F.to_date(F.timestamp_millis(F.col("open_time")))


def _any_null(keys: Sequence[str]) -> Column:
    return functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def first_wins(batch: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key in ``order``; rows with a NULL key part are
    all kept and bypass the shuffle."""
    null_key = _any_null(keys)
    ordering = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    keyed = batch.where(~null_key).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return keyed.unionByName(batch.where(null_key))


def require_symbol(batch: DataFrame) -> DataFrame:
    """Fail the job on a NULL symbol (checked inside the write, no extra pass)."""
    return batch.withColumn(
        "symbol",
        F.when(F.col("symbol").isNull(), F.raise_error(F.lit("NOT NULL violated: symbol"))).otherwise(
            F.col("symbol")
        ),
    )


MAX_TOUCHED = 1000  # partition values listed in the filter on the table


def touched(batch: DataFrame, partition_col: str) -> Column | None:
    """Filter for the partitions that hold the batch's values (None: there are none)."""
    values = batch.select(partition_col).where(F.col(partition_col).isNotNull()).distinct()
    some = [r[0] for r in values.limit(MAX_TOUCHED + 1).collect()]
    if not some:
        return None
    if len(some) <= MAX_TOUCHED:
        return F.col(partition_col).isin(some)
    low, high = values.agg(F.min(partition_col), F.max(partition_col)).first()
    return F.col(partition_col).between(low, high)


def new_rows(
    batch: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    partition_col: str,
) -> DataFrame:
    """Rows of ``batch`` an idempotent append inserts into ``table``.

    ``partition_col`` is a column of both sides derived from the key.  The
    batch is read more than once, and its partition values at once: pass a
    written copy.
    """
    null_key = _any_null(keys)
    keyed = batch.where(~null_key)
    fresh = first_wins(keyed, keys, order)
    if (prune := touched(keyed, partition_col)) is not None:
        on = [*keys, partition_col]
        fresh = fresh.join(table.where(prune).select(*on), on, "left_anti")
    return fresh.unionByName(batch.where(null_key))


def raw_table_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/raw_{dataset}"


def create_raw_table(spark: SparkSession, root: str, dataset: str) -> str:
    """Create the (empty, typed, partitioned) raw table if it is absent."""
    path = raw_table_path(root, dataset)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        empty = spark.createDataFrame([], RAW_SCHEMAS[dataset]).withColumn(
            PARTITION_COLUMN[dataset], partition_value(dataset)
        )
        empty.write.mode("ignore").partitionBy(PARTITION_COLUMN[dataset]).parquet(path)
    return path


def read_raw_table(spark: SparkSession, root: str, dataset: str, with_partition: bool = False) -> DataFrame:
    pin_conf(spark)
    part = PARTITION_COLUMN[dataset]
    schema = T.StructType(list(RAW_SCHEMAS[dataset].fields)).add(part, "date" if part == "open_date" else "long")
    df = spark.read.schema(schema).parquet(raw_table_path(root, dataset))
    return df if with_partition else df.drop(part)


def append_idempotent(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    dataset: str,
    order: Sequence[Column | str] | None = None,
) -> None:
    """Append the new rows of ``batch`` to the raw ``dataset`` table.

    ``order`` defines "first" inside the batch (default: the landing arrival
    order ``_mtime, _file, _block, _pos`` when present, else ``extracted_at`` and
    every other column).  Empty batches write nothing.
    """
    create_raw_table(spark, root, dataset)
    schema = RAW_SCHEMAS[dataset]
    keys = RAW_KEYS[dataset]
    if order is None:
        arrival = [c for c in ("_mtime", "_file", "_block", "_pos") if c in batch.columns]
        order = arrival or ["extracted_at", *[f.name for f in schema.fields if f.name not in keys]]
    part = PARTITION_COLUMN[dataset]
    keep = [f.name for f in schema.fields] + [c for c in order if isinstance(c, str) and c not in schema.names]
    with scratch_scope(spark):
        staged = scratch_path(spark, f"batch_{dataset}")
        require_symbol(batch.select(*keep)).withColumn(part, partition_value(dataset)).write.parquet(staged)
        table = read_raw_table(spark, root, dataset, with_partition=True)
        inserts = new_rows(spark.read.parquet(staged), table, keys, order, part)
        inserts.select(*schema.names, part).write.mode("append").partitionBy(part).parquet(
            raw_table_path(root, dataset)
        )
