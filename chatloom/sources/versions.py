"""Tables that are replaced in one step: whole versions side by side, and small pointers that name the current one.

A version is written in full before its pointer appears, and a pointer appears by one rename to a name that is not taken. So a
reader finds the old version or the new one, whatever fails in between, and what a reader has open stays until it is pruned.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatloom.sources.jsonl import write_jsonl

POINTER = re.compile(r"pointer-(\d{12})")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, folder))) if fs.exists(_path(spark, folder)) else []


def _pointers(spark: SparkSession, root: str) -> list[str]:
    return [n for n in _names(spark, root) if POINTER.fullmatch(n)]


def _named_by(spark: SparkSession, root: str, pointer: str) -> str:
    return f"{root.rstrip('/')}/data/{spark.read.text(f'{root}/{pointer}').first().value}"


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the current version; null before the first."""
    found = _pointers(spark, root)
    return _named_by(spark, root, found[-1]) if found else None


def publish(df: DataFrame, root: str, write: Callable[[DataFrame, str], None] = write_jsonl) -> str:
    """Write ``df``, which may read the current version, as the new one; its folder. Of two writers that began with the same
    version, the second fails, and its rows are left to ``prune``."""
    spark = df.sparkSession
    found = _pointers(spark, root)
    number = int(POINTER.fullmatch(found[-1])[1]) + 1 if found else 1
    name = f"{number:012d}-{uuid.uuid4().hex}"
    write(df, f"{root}/data/{name}")
    _point(spark, root, name, number)
    return f"{root.rstrip('/')}/data/{name}"


def _point(spark: SparkSession, root: str, name: str, number: int) -> None:
    fs, new = _fs(spark, root), _path(spark, f"{root}/pointer-{number:012d}")
    beside = _path(spark, f"{root}/.{name}")
    out = fs.create(beside, False)
    out.write(bytearray(name.encode()))
    out.hsync()
    out.close()
    if fs.exists(new) or not fs.rename(beside, new):
        fs.delete(beside, False)
        raise FileExistsError(f"another writer made version {number} of {root}")


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` versions, and what failed writers left of versions up to the current one; the names of
    the folders removed. Pointers go before what they name."""
    if keep < 1:
        raise ValueError("the current version stays")
    fs, found = _fs(spark, root), _pointers(spark, root)
    if not found:
        return []
    kept = {_named_by(spark, root, p).rpartition("/")[2] for p in found[-keep:]}
    for p in found[:-keep]:
        fs.delete(_path(spark, f"{root}/{p}"), False)
    newest = int(POINTER.fullmatch(found[-1])[1])
    gone = [n for n in _names(spark, f"{root}/data") if n not in kept and int(n.partition("-")[0]) <= newest]
    for n in gone:
        fs.delete(_path(spark, f"{root}/data/{n}"), True)
    return gone
