"""Token counts kept as totals that signed changes update.

A change is a row (source, lang, tokenizer, docs, tokens, bytes) with signs: an
inserted document adds, a deleted one takes away what it had added, a document
counted anew under another tokenizer version does both. A batch of changes is
summed by source, language and tokenizer version before it is written, so a hot
source is a row per batch, and totals are sums over batches in any order.

A batch is committed under its id: its sums are written aside and moved into
place by one rename that fails if the place is taken. Committing an id again,
by a retry or a second driver, changes nothing. Null sources and languages are
keys like any other, null texts have no tokens, repeated rows count each, an
empty batch is a commit without rows. Other columns play no part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["docs", "tokens", "bytes"]
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long, bytes long"

#: Tokens of a tokenizer version, as patterns of equal meaning in Spark and other engines.
VERSIONS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "signs-2": r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[^0-9A-Za-z\x{80}-\x{10FFFF}\x20\x09-\x0D]",
}


def tokens(version: str, text_col: str = "text") -> Column:
    """Number of tokens of the whole text."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def changes(counts: DataFrame, version: str, sign: int) -> DataFrame:
    """Signed rows of documents given by (source, lang, tokens, bytes)."""
    return counts.select(
        "source", "lang", F.lit(version).alias("tokenizer"), F.lit(sign).cast("long").alias("docs"),
        (F.col("tokens") * sign).alias("tokens"), (F.col("bytes") * sign).alias("bytes"),
    )


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*(F.sum(c).cast("long").alias(c) for c in SUMS))


class Rollup:
    """Batches of summed changes in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self, path: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return jvm, where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Write the batch; False, and nothing done, if its id is committed already."""
        jvm, place, fs = self._hadoop(f"{self.path}/commits/batch={batch}")
        if fs.exists(place):
            return False
        aside = f"{self.path}/aside/{uuid.uuid4().hex}"
        summed(rows).write.parquet(aside)
        fs.mkdirs(place.getParent())
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(jvm.org.apache.hadoop.fs.Path(aside), place, plain)
        except Exception:
            if not fs.exists(place):
                raise
            fs.delete(jvm.org.apache.hadoop.fs.Path(aside), True)  # another writer was first
            return False
        return True

    def batches(self) -> list[str]:
        _, place, fs = self._hadoop(f"{self.path}/commits")
        if not fs.exists(place):
            return []
        return sorted(s.getPath().getName().removeprefix("batch=") for s in fs.listStatus(place))

    def totals(self) -> DataFrame:
        """Sums over all batches; keys that are back to nothing have no row."""
        if not self.batches():
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/commits/batch=*")
        return summed(rows).where(" or ".join(f"{c} <> 0" for c in SUMS))


def counted(docs: DataFrame, versions: list[str], text_col: str = "text") -> DataFrame:
    """doc_id, source, lang, content (of the text), bytes and tokens_<i> of each version."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.md5(F.coalesce(text_col, F.lit(""))).alias("content"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"),
        *(tokens(v, text_col).alias(f"tokens_{i}") for i, v in enumerate(versions)),
    )
