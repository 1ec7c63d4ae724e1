"""Tables written aside and moved into place together.

A build writes its tables under a folder ``_new-<id>`` beside the old ones.  When all
of them are complete a marker is set, and each takes the place of the old table by two
renames.  A run that ends before the marker, by an error or because its driver was
lost, leaves every old table as it was; one that ends after it leaves a whole set,
which ``recover`` moves in, each step being safe to repeat.  So a folder holds the old
tables or the new ones, and a table is missing only between the two renames of a
driver that was lost there, until the next run.

One writer per folder is assumed.  A rename is one step on HDFS and on local file
systems; object stores copy instead.  Whoever reads an old table during the swap must
open it again, as after any overwrite.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

NEW, OLD, DONE = "_new-", "_old", "_DONE"


def _at(spark: SparkSession, path: str):
    """File system and Hadoop path of ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, place = _at(spark, source)
    if not fs.rename(place, _at(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def _swap(spark: SparkSession, out: str, name: str, folder: str) -> None:
    """The new table ``name`` for the old one; a step already done is not repeated."""
    old, new, kept = f"{out}/{name}", f"{folder}/{name}", f"{folder}/{OLD}/{name}"
    fs, place = _at(spark, old)
    if fs.exists(place):
        _rename(spark, old, kept)
    try:
        _rename(spark, new, old)
    except Exception:
        if fs.exists(_at(spark, kept)[1]):
            _rename(spark, kept, old)
        raise


def _swap_all(spark: SparkSession, out: str, folder: str) -> None:
    fs, place = _at(spark, f"{folder}/{OLD}")
    fs.mkdirs(place)
    for name in _names(spark, folder):
        if name not in (OLD, DONE):  # the tables that are not yet in place
            _swap(spark, out, name, folder)
    _delete(spark, folder)


def recover(spark: SparkSession, out_dir: str) -> None:
    """Finish what an earlier run left under ``out_dir``: a whole set of new tables is
    moved in, an incomplete one is deleted."""
    out = out_dir.rstrip("/")
    for name in _names(spark, out):
        if name.startswith(NEW):
            folder = f"{out}/{name}"
            if DONE in _names(spark, folder):
                _swap_all(spark, out, folder)
            else:
                _delete(spark, folder)


@contextlib.contextmanager
def published(spark: SparkSession, out_dir: str) -> Iterator[str]:
    """A folder to write new tables into.  They replace those of the same names under
    ``out_dir`` when the block ends well; after an error all old tables stay."""
    out = out_dir.rstrip("/")
    recover(spark, out)
    folder = f"{out}/{NEW}{uuid.uuid4().hex}"
    try:
        yield folder
    except BaseException:
        _delete(spark, folder)
        raise
    if _names(spark, folder):
        fs, place = _at(spark, f"{folder}/{DONE}")
        fs.create(place).close()
        _swap_all(spark, out, folder)
