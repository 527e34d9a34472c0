"""Vectors as bytes inside rows, so that tasks see arrays and Spark moves no lists of numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from boxlake.llm.common import packed

_ARROW = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("vec", pa.binary())])


def vector_rows(vectors: DataFrame, zeros: bool = True) -> DataFrame:
    """vec_id, dim and vec (little-endian doubles) of the rows of ``vectors`` (vec_id, embedding) that take part.

    Rows whose vec_id or embedding is null or whose embedding is empty or holds a null or non-finite component are left
    out; with ``zeros`` off, those without a component other than zero are too. Other columns are ignored. Negative zeros
    become zeros.
    """
    kind = vectors.schema["embedding"].dataType
    plain = F.col("embedding") if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else F.col("embedding").cast("array<double>")
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), plain.alias("embedding"))
    given = given.filter("vec_id is not null and embedding is not null and size(embedding) > 0")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            lists = batch["embedding"]
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # nulls read as NaN
            at = lists.offsets.to_numpy()
            for vec_id, a, b in zip(batch["vec_id"].to_pylist(), at[:-1], at[1:], strict=True):
                x = flat[a:b]
                if np.isfinite(x).all() and (zeros or x.any()):
                    yield vec_id, b - a, x.astype("<f8").tobytes()

    return given.mapInArrow(lambda b: packed(read(b), _ARROW), "vec_id long, dim int, vec binary")


def matrix(held: list[bytes]) -> np.ndarray:
    """Rows of doubles; all must be of one length."""
    return np.frombuffer(b"".join(held), "<f8").reshape(len(held), -1)


def sampled(vectors: DataFrame, most: int, salt: str) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of vec_id; a fit may use them, a result never does."""
    return vectors.orderBy(F.xxhash64("vec_id", F.lit(salt)), "vec_id").limit(most)
