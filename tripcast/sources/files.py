"""Folders of the file system a path belongs to (HDFS, object stores, local)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return bool(fs.exists(p))


def drop_folder(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    (a, fs), (b, _) = _at(spark, old), _at(spark, new)
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {old} to {new}")


def hidden_sibling(path: str, what: str) -> str:
    """A new name beside ``path`` that Spark's readers skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/" * bool(parent or path.startswith("/")) + f".{name}.{what}-{uuid.uuid4().hex}"


def write_whole(spark: SparkSession, path: str, write: Callable[[str], None], overwrite: bool = False) -> None:
    """Let ``write`` fill a hidden folder and give it the name ``path`` when it has
    succeeded, so ``path`` never holds part of a result.  An existing folder is
    an error, or with ``overwrite`` stays until the new one is complete."""
    path = path.rstrip("/")
    if folder_exists(spark, path) and not overwrite:
        raise FileExistsError(f"{path} already exists")
    fresh = hidden_sibling(path, "new")
    try:
        write(fresh)
        if not folder_exists(spark, path):
            rename(spark, fresh, path)
            return
        if not overwrite:
            raise FileExistsError(f"{path} was created meanwhile")
        old = hidden_sibling(path, "old")
        rename(spark, path, old)
        try:
            rename(spark, fresh, path)
        except Exception:
            rename(spark, old, path)
            raise
        drop_folder(spark, old)
    except Exception:
        drop_folder(spark, fresh)
        raise
