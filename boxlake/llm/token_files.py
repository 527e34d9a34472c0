"""Token ids as Parquet list columns, in ascending document order, with starts for every document.

Documents are dealt by ranges of (doc_id, hash of the text), sorted within each range and encoded; every range is
one run of files, numbered by its ``shard``. The ids are a dictionary-encoded list column, the numbers beside them
are delta-encoded (Parquet pages of version 2), and row groups and pages have set sizes, so that a reader takes
only the columns, row groups and pages it asks for. Starts are added from the written lengths alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxlake.llm import word_bpe

#: Sizes in bytes. Row groups bound what a writer holds; pages are what a selective read skips.
FORMAT = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
SCHEMA = "shard int, doc_id long, tie long, n_tokens long, ids array<int>"
_ARROW = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _encode(content: str, end_id: int | None):
    end = np.array([] if end_id is None else [end_id], np.int32)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe.encoder(content)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                ids = [np.concatenate([i, end]) for i in encoder.encode(batch["text"].to_pylist())]
                lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), np.concatenate(ids))
                yield pa.RecordBatch.from_arrays([batch["shard"], batch["doc_id"], batch["tie"], pa.array(lengths), lists], schema=_ARROW)

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int | None = 1, shards: int | None = None) -> None:
    """Write the ids of every row of ``docs`` (doc_id, text; other columns are ignored) to ``path``.

    A null text is empty and holds the end id alone. Null doc_ids come first. Rows of one doc_id are ordered by a hash
    of the text; equal rows are interchangeable. No rows give an empty table.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), F.col("text").cast("string"))
    ranged = given.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ranged = ranged.select(F.spark_partition_id().alias("shard"), "doc_id", "tie", "text")
    encoded = ranged.mapInArrow(_encode(word_bpe.spec(tokenizer_path), end_id), SCHEMA)
    encoded.write.options(**FORMAT).mode("errorifexists").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows. Select columns and filter on doc_id as usual: both reach the files."""
    return spark.read.schema(SCHEMA).parquet(path)


def with_starts(tokens: DataFrame) -> DataFrame:
    """``tokens`` metadata with ``start``: the number of ids of all documents before it in (doc_id, tie) order.

    Sums of shards are chained first (one row for each shard), then lengths within each shard. ``order`` columns
    beyond doc_id and tie are not needed: rows that agree in both hold the same ids.
    """
    sums = tokens.groupBy("shard").agg(F.sum("n_tokens").alias("shard_tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("shard", F.coalesce(F.sum("shard_tokens").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = tokens.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(offsets, "shard").withColumn("start", F.col("shard_start") + F.col("before")).drop("before", "shard_start")


def with_checksums(tokens: DataFrame) -> DataFrame:
    """shard, doc_id, tie, n_tokens and ids_crc32, the unsigned crc32 of the ids as little-endian 32-bit integers."""

    def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            flat, at = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            kept = [batch[c] for c in ("shard", "doc_id", "tie", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], names=["shard", "doc_id", "tie", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(checksums, "shard int, doc_id long, tie long, n_tokens long, ids_crc32 long")
