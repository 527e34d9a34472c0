"""Session settings, and the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Pages are large rows: small Arrow batches keep a Python worker's memory flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    # A repeated key in a JSON object takes its last value instead of spoiling the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "boxlake", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a session in one process may fall back to a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    made = tempfile.mkdtemp(prefix="boxlake-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
