"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A Python worker serves many tasks of many operators, and all workers count towards an executor's memory. Arrow's own pool
# keeps what it has freed; the system's allocator gives it back when asked.
pa.set_memory_pool(pa.system_memory_pool())
try:
    _give_back = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library than glibc
    _give_back = None

_KEPT: list = []  # tables kept from task to task
_USED: set = set()  # those of them that the current task has used


def kept(build: Callable) -> Callable:
    """A table built once and kept for the next task in this worker, until a task comes that does not use it."""
    cache = lru_cache(maxsize=2)(build)
    _KEPT.append(cache)

    @wraps(build)
    def get(*args):
        _USED.add(cache)
        return cache(*args)

    return get


def ending(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``, and at their end the memory that the task no longer needs is given back."""
    try:
        yield from batches
    finally:
        for cache in _KEPT:
            if cache not in _USED:
                cache.cache_clear()
        _USED.clear()
        gc.collect()
        if _give_back:
            _give_back(0)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared folder, spark.checkpoint.dir.

    Only a session on one machine may lack the setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="boxlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that no later job computes it again."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` rows; else left to a shuffled join.

    ``df`` should be narrow and already stored: its rows are counted here.
    """
    return F.broadcast(df) if df.count() <= most_rows else df


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row of ``df`` in memory: 8 for each number, the length of texts and binaries, and of lists all they hold."""

    def width(kind: T.DataType, value: Column) -> Column:
        if isinstance(kind, T.StructType):
            return sum((width(f.dataType, value[f.name]) for f in kind), F.lit(8))
        if isinstance(kind, T.ArrayType):
            inner = kind.elementType
            if isinstance(inner, (T.StringType, T.BinaryType, T.ArrayType)):
                return F.coalesce(F.aggregate(value, F.lit(16).cast("long"), lambda n, x: n + width(inner, x)), F.lit(8))
            return F.greatest(F.size(value), F.lit(0)) * (8 * len(inner) + 8 if isinstance(inner, T.StructType) else 8) + 16
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16 if isinstance(kind, (T.StringType, T.BinaryType)) else F.lit(8)

    return width(df.schema, F.struct("*")).cast("long")


def broadcast_within(df: DataFrame, most_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its rows take at most ``most_bytes``; else left to a shuffled join. It should be stored."""
    return F.broadcast(df) if (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= most_bytes else df


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, a slice of a batch at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            yield from zip(*(column.to_pylist() for column in batch.slice(start, 512).columns), strict=True)


def packed(rows: Iterable[tuple], schema: pa.Schema, most_rows: int = 2000, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows, closed at so many rows or about so many bytes of text, lists and binaries; see ``ending``."""
    return ending(_packed(rows, schema, most_rows, most_bytes))


def _packed(rows: Iterable[tuple], schema: pa.Schema, most_rows: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) * (1 if isinstance(v, (str, bytes)) else 8) for v in row if hasattr(v, "__len__"))
        if len(held) >= most_rows or size >= most_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def grouped(rows: Iterable[tuple], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows that agree in their first ``width`` values, from rows sorted by them."""
    key, held = None, []
    for row in rows:
        if held and row[:width] != key:
            yield key, held
            held = []
        key = row[:width]
        held.append(row)
    if held:
        yield key, held
