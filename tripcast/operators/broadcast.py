"""Broadcast a join side only after its size has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a side may hold to be shipped to the driver and every executor.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
# A side whose input files exceed this is refused without running any job
# (refusing is always safe: the join falls back to a shuffle).
REJECT_INPUT_BYTES = 1 << 30
_EXACT_FILE_LIMIT = 1000


def _files(df: DataFrame) -> list[tuple[str, int, int]] | None:
    """(path, bytes, modification time) of each file ``df`` reads; None if it
    reads none or more than can be looked up one by one."""
    files = df.inputFiles()
    if not files or len(files) > _EXACT_FILE_LIMIT:
        return None
    sc = df.sparkSession.sparkContext
    conf, make = sc._jsc.hadoopConfiguration(), sc._jvm.org.apache.hadoop.fs.Path
    out = []
    for f in sorted(files):
        status = make(f).getFileSystem(conf).getFileStatus(make(f))
        out.append((f, int(status.getLen()), int(status.getModificationTime())))
    return out


def _row_bytes(df: DataFrame):
    """Bytes of one row: text and binary by length, nested values by their JSON,
    the rest eight bytes, and eight more per column for its slot."""
    total = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(c)))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0)) + 8
    return total.cast("long")


_MEASURED: dict[tuple, tuple[int, int]] = {}


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``: counts and sums per task, whose few numbers
    alone are shuffled.  Remembered for a plan over the same files of the same
    sizes and times; a side without files is measured anew."""
    files = _files(df)
    key = None
    if files is not None:
        key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), tuple(files))
        if key in _MEASURED:
            return _MEASURED[key]
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
    got = (int(r["n"]), int(r["b"]))
    if key is not None:
        _MEASURED[key] = got
    return got


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                   reject_bytes: int = REJECT_INPUT_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.
    A side whose input files exceed ``reject_bytes``, or that reads more files
    than a lookup has, is refused without a job."""
    if len(df.inputFiles()) > _EXACT_FILE_LIMIT:
        return False
    files = _files(df)
    if files is not None and sum(n for _, n, _ in files) > reject_bytes:
        return False
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if it is proven small, else ``df`` unchanged so the
    planner falls back to a shuffled (sort-merge) join."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
