"""The state of pulls as a running state, kept up with a log that arrives in any order and any batches.

Each field of a league and dataset keeps its own newest (ts, seq), so a row that comes late changes only the fields for
which it is the newest, and a row that comes twice changes nothing. The state has a row for each dataset; every batch writes it
whole to a folder of its own, which a manifest then names, so a reader sees the state after some batch, never a part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.plans.status import PULL_FIELDS, fold_pulls
from boxlake.sources.manifest import read_manifest, write_manifest


def follow_pulls(log: DataFrame, root: str, by: tuple[str, ...] = ("league", "dataset")) -> None:
    """Take in all rows that the stream ``log`` has, and end; the next call goes on from there.

    The fold is a streaming aggregation: its buffers are the stored state, and a batch touches only the rows' own keys.
    """

    def put(state: DataFrame, number: int) -> None:
        spark, folder = state.sparkSession, f"state/batch-{number}-{uuid.uuid4().hex}"
        state.write.parquet(f"{root}/{folder}")
        version = (read_manifest(spark, root) or {"version": -1})["version"] + 1
        write_manifest(spark, root, {"version": version, "folder": folder, "batch": number})

    (
        fold_pulls(log, by).writeStream.foreachBatch(put)
        .outputMode("complete")
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def pull_state(spark: SparkSession, root: str, by: tuple[str, ...] = ("league", "dataset")) -> DataFrame:
    """The state after the last batch; empty before the first."""
    newest = read_manifest(spark, root)
    if newest is None:
        kinds = [f"{c} {'long' if c.startswith('files') else 'string'}" for c in PULL_FIELDS]
        return spark.createDataFrame([], ", ".join([*(f"{c} string" for c in by), *kinds]))
    return spark.read.parquet(f"{root}/{newest['folder']}").select(*by, *[F.col(c) for c in PULL_FIELDS])
