"""Named source relations: the driver's parquet tables and raw-table paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.session import pin_conf


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """``{base_dir}/{name}.parquet``; column pruning and filters reach the scan."""
    pin_conf(spark)
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
