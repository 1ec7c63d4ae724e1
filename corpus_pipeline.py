"""A corpus in five stages: each takes what its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and reread as the next one's documents. All but the last return the columns of
``documents``. The operators that the stages call say what null ids and texts,
empty and long texts and repeated rows give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bpe, decontam, simhash, suffix_dedup, toxicity
from candlewick.llm.common import documents, fresh_names, held_out, stored
from candlewick.llm.queries import LABEL_SCORE, word_bpe_path

#: Unit of the repeats: a passage of fifty words, of three letters and a space on average
#: or longer ones, holds a string of so many bytes at all of its places.
REPEAT_BYTES = 200


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores below the label's threshold."""
    labels = documents(spark, sf_dir, "labels")
    score = fresh_names(docs, "_toxicity")[0]
    scored = toxicity.score_texts(docs, labels, held_out(3, 1), score_col=score)
    return scored.where(F.col(score) < LABEL_SCORE).drop(score)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, strings of ``REPEAT_BYTES`` bytes that occur more than once gone
    from their texts; ``n_chars`` counts what is left."""
    left = suffix_dedup.remove_repeats(docs, length=REPEAT_BYTES)
    return left.withColumn("n_chars", F.length("text").cast("long"))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.without_overlaps(docs, documents(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text with their number, and digests of ids and decoded text."""
    path = word_bpe_path()
    both = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    return both.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", not_toxic),
    ("simhash", without_near_copies),
    ("suffix_array", without_repeats),
    ("decontamination", without_benchmarks),
    ("bpe", encoded),
]

#: SQL expresses none of the stages; tests/llm/test_pipeline.py checks the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
