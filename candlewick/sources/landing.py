"""JSON landing zone: write extracted records, read them back typed.

Landed records keep API values as text (prices) and numbers (times,
counts), plus an ISO ``extracted_at``.  Reading takes every value as text in
one parse and then casts it, so nothing is lost on the way: a line or file that
is not JSON, a record without its symbol or a key, or a value that its column
cannot hold exactly (not a number, too many digits before or after the point)
is a bad record.  ``on_bad="fail"`` (the default) fails the run on the first
one; ``on_bad="quarantine"`` gives the good records only, and
``quarantined_landing`` the others with reason and text.  Other values may be
missing and are NULL then; keys that no column has are ignored.  A file of one array
must hold nothing after it: Spark's parser reads the first JSON value of such a file.

Each record also gets its arrival order (``_mtime``, ``_file``, ``_block``,
``_pos``: file time, file, split start, and a counter that grows along each split) so that a
first-write-wins load can tell which duplicate came first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.schemas import RAW_SCHEMAS
from candlewick.session import pin_conf
from candlewick.sources.checked import good_or_fail, known_on_bad, reasons

ARRIVAL = ("_mtime", "_file", "_block")


def landing_schema(dataset: str) -> T.StructType:
    """Every column of the raw schema as text, and the text of what cannot be parsed."""
    names = [*RAW_SCHEMAS[dataset].names, "_corrupt"]
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


# Ends the only line of a file of one array; no JSON holds NUL.
END_OF_ARRAY = "\0end of array\0"


def landing_reader(reader, dataset: str, multiline: bool):
    """The options of a batch or stream reader for landed JSON: lines, or with
    ``multiline`` one array a file, indented or not.

    Such a file is read as one line: with Spark's ``multiLine`` the parser works on the
    open file and takes the text of each number by a read of its own, which opens the
    file again and costs some hundred times the file's bytes.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    if multiline:
        options["lineSep"] = END_OF_ARRAY
    return reader.schema(landing_schema(dataset)).options(**options)


def checked_landing(raw: DataFrame, dataset: str) -> DataFrame:
    """Typed records of what the reader gives, with ``_reason`` (null: good), ``_record``
    (the text of a bad one) and when and where they came in."""
    schema = RAW_SCHEMAS[dataset]
    value = {name: F.col(name) for name in schema.names}
    reason = F.coalesce(F.when(F.col("_corrupt").isNotNull(), F.lit("record: not JSON")), *reasons(value, dataset))
    text = F.coalesce("_corrupt", F.to_json(F.struct(*schema.names)))
    rows = raw.select("*", reason.alias("_reason"), *arrival_columns())
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return rows.select(*typed, "_reason", F.when(F.col("_reason").isNotNull(), text).alias("_record"), *ARRIVAL)


def good_records(checked: DataFrame, on_bad: str) -> DataFrame:
    """The good ones of checked records; a bad one fails the run if ``on_bad`` says so."""
    good = F.col("_reason").isNull() if known_on_bad(on_bad) == "quarantine" else good_or_fail("_reason", "_record")
    return checked.where(good).drop("_reason", "_record")


def bad_records(checked: DataFrame) -> DataFrame:
    """reason, record (its text), file and its time, of the bad ones."""
    bad = checked.where(F.col("_reason").isNotNull())
    return bad.select(F.col("_reason").alias("reason"), F.col("_record").alias("record"), F.col("_file").alias("file"), F.col("_mtime").alias("landed_at"))


def write_landing(records: DataFrame, path: str) -> None:
    """Overwrite the landing folder with ``records`` as JSON lines (decimals
    as text, one file per partition, written in parallel)."""
    out = records.select(
        [
            F.col(c).cast("string").alias(c) if isinstance(t, (T.DecimalType, T.TimestampNTZType)) else F.col(c)
            for c, t in ((f.name, f.dataType) for f in records.schema.fields)
        ]
    )
    out.write.mode("overwrite").json(path)


def _checked(spark: SparkSession, path: str, dataset: str, multiline: bool) -> DataFrame:
    pin_conf(spark)
    return checked_landing(landing_reader(spark.read, dataset, multiline).json(path), dataset)


def read_landing(spark: SparkSession, path: str, dataset: str, multiline: bool = False, on_bad: str = "fail") -> DataFrame:
    """Typed raw records from landed JSON (JSON lines, or arrays with
    ``multiline=True``), with its arrival order."""
    rows = good_records(_checked(spark, path, dataset, multiline), on_bad)
    return rows.select("*", F.monotonically_increasing_id().alias("_pos"))


def quarantined_landing(spark: SparkSession, path: str, dataset: str, multiline: bool = False) -> DataFrame:
    """The records that ``read_landing`` does not give, as ``bad_records``."""
    return bad_records(_checked(spark, path, dataset, multiline))


def arrival_columns() -> list:
    """When and where a landed record came in: file time first, so that file names
    need not sort."""
    return [
        F.col("_metadata.file_modification_time").alias("_mtime"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    ]
