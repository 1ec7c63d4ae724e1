"""Incremental ingest of landed JSON with Structured Streaming.

New landing files are picked up by a file stream; every micro-batch is
appended with ``ingest.append_idempotent`` (first write wins).  Because that
append skips keys already present, replaying a micro-batch after a failure
inserts nothing twice, so ``foreachBatch`` gives exactly-once table contents
without a transactional sink.  The stream's checkpoint lives under the
shared ``spark.checkpoint.dir``.

Bad records (see ``sources.landing``) fail the batch, or with
``on_bad="quarantine"`` go to a table beside the raw one: the batch is parsed
once and staged, its good rows are appended, and its bad ones written to a folder of
the batch, which a replayed batch writes anew.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.ingest import append_idempotent, raw_table_path
from candlewick.operators.scaled import written_table
from candlewick.session import checkpoint_dir, pin_conf, scratch_scope
from candlewick.sources.checked import known_on_bad
from candlewick.sources.landing import bad_records, checked_landing, good_records, landing_reader

QUARANTINE = "reason string, record string, file string, landed_at timestamp, batch string"


def checked_stream(spark: SparkSession, landing_dir: str, dataset: str, multiline: bool = True) -> DataFrame:
    """All records of a landing folder, as a stream, typed and with their reason if bad:
    files of one JSON array each, indented or not, or of JSON lines with ``multiline=False``."""
    pin_conf(spark)
    return checked_landing(landing_reader(spark.readStream, dataset, multiline).json(landing_dir), dataset)


def landing_stream(spark: SparkSession, landing_dir: str, dataset: str, multiline: bool = True, on_bad: str = "fail") -> DataFrame:
    """Typed raw records from a landing folder, as a stream."""
    return good_records(checked_stream(spark, landing_dir, dataset, multiline), on_bad)


def quarantine_path(root: str, dataset: str) -> str:
    return f"{raw_table_path(root, dataset)}_quarantine"


def read_quarantine(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """reason, record, file, landed_at and batch of the bad records that ingests set aside."""
    path = spark._jvm.org.apache.hadoop.fs.Path(quarantine_path(root, dataset))
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], QUARANTINE)
    return spark.read.schema(QUARANTINE).parquet(quarantine_path(root, dataset))


def start_landing_ingest(
    spark: SparkSession,
    landing_dir: str,
    dataset: str,
    root: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    multiline: bool = True,
    on_bad: str = "fail",
) -> StreamingQuery:
    """Start (or resume) the ingest of ``landing_dir`` into the raw table."""
    known_on_bad(on_bad)
    location = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/ingest_{dataset}"

    def load(batch: DataFrame, epoch_id: int) -> None:
        with scratch_scope(spark):
            if on_bad == "quarantine":
                batch = written_table(batch, f"landed_{dataset}")
                bad = bad_records(batch)
                if not bad.isEmpty():
                    place = f"{quarantine_path(root, dataset)}/batch={zlib.crc32(location.encode()):08x}-{epoch_id}"
                    bad.write.mode("overwrite").parquet(place)
            ordered = good_records(batch, on_bad).withColumn("_pos", F.monotonically_increasing_id())
            append_idempotent(spark, ordered, root, dataset)

    writer = checked_stream(spark, landing_dir, dataset, multiline).writeStream.foreachBatch(load).option(
        "checkpointLocation", location
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
