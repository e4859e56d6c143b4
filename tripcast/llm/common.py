"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.session import ensure_checkpoint_dir
from tripcast.sources.files import drop_folder

SLICE_BYTES = 4 << 20  # text handled by one vectorised call inside a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_mod(column: str, n: int) -> Column:
    """crc32 of an id as text, modulo n (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(n)


def n_shuffle(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name below the application's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    and a lost executor cannot take the rows with it."""
    return _stored_at(df, shared_folder(df.sparkSession, what))


def _stored_at(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that only a result's making needs: stored as by :func:`stored`, deleted by :meth:`drop`."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def stored(self, df: DataFrame, what: str) -> DataFrame:
        self.paths.append(shared_folder(self.spark, what))
        return _stored_at(df, self.paths[-1])

    def drop(self) -> None:
        for path in self.paths:
            drop_folder(self.spark, path)
        self.paths = []


_HELD: list[tuple[Any, Any]] = []


def held(key: Any, build: Callable[[], Any]) -> Any:
    """``build()``, kept by this process until another key is asked for: a worker
    that serves several operators holds the tables of one at a time."""
    if not _HELD or _HELD[0][0] != key:
        _HELD.clear()
        _HELD.append((key, build()))
    return _HELD[0][1]


def hold_memory() -> None:
    """Keep freed memory in the process until :func:`give_back`: work on arrays of some
    MB otherwise spends a third of its time on getting the same pages again."""
    try:
        mallopt = ctypes.CDLL(None).mallopt
        mallopt(-1, 512 << 20)  # M_TRIM_THRESHOLD
        mallopt(-3, 256 << 20)  # M_MMAP_THRESHOLD
    except (AttributeError, OSError):  # a C library without it
        pass


def give_back() -> None:
    """Return freed memory to the system: at the end of a task, as the worker may
    stay idle beside other tasks for long."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def utf8_parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0, int64) of a string or binary array; null: empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type):
        kind = np.int64
    else:
        kind = np.int32
    if array.null_count:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, kind)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with about ``most`` bytes of the string column each."""
    if batch.num_rows == 0:
        return
    _, off = utf8_parts(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(off, off[at] + most, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Fixed 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
