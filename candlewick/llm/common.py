"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from candlewick.session import scratch_path

#: Bytes of text that a worker holds as numpy arrays at a time.
BLOCK_BYTES = 1_000_000


#: Rows and bytes of a batch that Spark hands to a worker: texts are long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def ready_workers(spark: SparkSession) -> None:
    """Bound the batches of the session's Python workers, where it does not itself,
    and let those of a local session import this package from where it lies."""
    for key, value in BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of the given folder."""
    ready_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(divisor: int, remainder: int, id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves the remainder (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % divisor == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, out: Column, max_rows: int) -> DataFrame:
    """(text, y): labelled rows outside ``out``, at most ``max_rows`` of them, those
    of smallest hash of the id, and of rows of one id that of the smallest content
    hash. The bound makes the broadcast of the ids small."""
    ids = labels.where(~out & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "y", F.struct(F.xxhash64("text").alias("hash"), "text").alias("row"))
    return rows.groupBy("doc_id", "y").agg(F.min("row").alias("row")).select("row.text", "y")


def fresh_names(df: DataFrame, *stems: str) -> list[str]:
    """A column name that the frame lacks, in any case, for each stem."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        taken.add(stem.lower())
        out.append(stem)
    return out


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once under the shared checkpoint folder and reread.

    Cuts the lineage: a lost executor costs the tasks that read from it, not
    the steps before.
    """
    spark = df.sparkSession
    ready_workers(spark)
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)  # the shared folder also holds copies of texts
    return spark.read.schema(df.schema).parquet(path)


def blocks(texts: Sequence[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold at most ``limit`` bytes together, or one text."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def utf8(values: Sequence[str | None]) -> list[bytes]:
    """UTF-8 of each text, nothing for a null."""
    return [b"" if v is None else v.encode("utf-8") for v in values]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def whole_runs(parts: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of sorted rows, dealt anew so that rows of equal keys stay together."""
    held: list[pd.DataFrame] = []
    for part in parts:
        if not len(part):
            continue
        tail = (part[keys] == part[keys].iloc[-1]).all(axis=1).to_numpy()
        start = len(part) - int(np.argmin(tail[::-1])) if not tail.all() else 0
        if start == 0 and held and (held[-1][keys].iloc[-1] == part[keys].iloc[0]).all():
            held.append(part)
            continue
        if start:
            yield pd.concat([*held, part.iloc[:start]], ignore_index=True)
        elif held:
            yield pd.concat(held, ignore_index=True)
        held = [part.iloc[start:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def with_lists(df: DataFrame, reads: list[str], added: dict[str, T.DataType], made: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """All rows with further columns, made in the workers from lists of others.

    ``made`` gives, once per task, the function of the lists of the columns
    ``reads`` that returns a list for each added column. Other columns pass
    through untouched; columns of the added names are replaced.
    """
    ready_workers(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in added]
    types = {name: to_arrow_type(kind) for name, kind in added.items()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = made()
        for batch in batches:
            new = of(*(batch.column(c).to_pylist() for c in reads))
            arrays = [pa.array(x, type=t) for x, t in zip(new, types.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *arrays], names=[*(f.name for f in kept), *types])

    return df.mapInArrow(run, T.StructType([*kept, *(T.StructField(n, k) for n, k in added.items())]))


def where_lists(df: DataFrame, reads: list[str], made: Callable[[], Callable[..., list[bool]]]) -> DataFrame:
    """The rows, all columns, for which the function that ``made`` gives is true."""
    ready_workers(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = made()
        for batch in batches:
            yield batch.filter(pa.array(of(*(batch.column(c).to_pylist() for c in reads)), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)
