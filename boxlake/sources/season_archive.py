"""Season files of player availability: one Parquet file per season, shapes differing over time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.fixed_values import ARCHIVE_COLUMNS, SEASON_FILE_PREFIX
from boxlake.sources.named_files import live_folders, write_named_tables

_SEASON_FILE = rf"^{SEASON_FILE_PREFIX}([0-9]+)\.parquet$"


def _season_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and season of the season files of a folder; a listing, no file is opened."""
    folders = live_folders(spark, folder)
    if not folders:
        return spark.createDataFrame([], "path string, season int")
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{SEASON_FILE_PREFIX}*.parquet").load(folders)
    named = files.select("path", F.regexp_extract(F.element_at(F.split("path", "/"), -1), _SEASON_FILE, 1).alias("season"))
    return named.where("season <> ''").select("path", F.col("season").cast("int").alias("season"))


def read_season_files(
    spark: SparkSession, folder: str, start: int | None = None, end: int | None = None
) -> DataFrame:
    """All season files with ``source_file`` kept. The optional season range is inclusive and is
    applied to file names, so files outside it are not opened. No file at all is an error."""
    files = _season_files(spark, folder)
    if start is not None:
        files = files.where(F.col("season") >= start)
    if end is not None:
        files = files.where(F.col("season") <= end)
    # one row per season: a listing, not data
    paths = [row.path for row in files.orderBy("season").toLocalIterator()]
    if not paths:
        raise FileNotFoundError(f"no season files in {folder} for [{start}, {end}]")
    return _merged([spark.read.parquet(path).withColumn("source_file", F.col("_metadata.file_name")) for path in paths])


def _merged(frames: list[DataFrame]) -> DataFrame:
    """Union by name. A column whose type drifts takes its archive type, or text if the archive does not name it."""
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            kinds.setdefault(name, set()).add(kind)
    drifting = {name: dict(ARCHIVE_COLUMNS).get(name, "string") for name, found in kinds.items() if len(found) > 1}
    cast = [f.withColumns({n: F.col(n).cast(k) for n, k in drifting.items() if n in f.columns}) for f in frames]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), cast)


def season_list(spark: SparkSession, folder: str) -> DataFrame:
    return _season_files(spark, folder).select("season").orderBy("season")


def write_season_files(rows: DataFrame, folder: str, season: str = "season") -> None:
    """The rows of every season as one file named after it, beside the files that are there."""
    name = F.concat(F.lit(SEASON_FILE_PREFIX), F.col(season).cast("string"), F.lit(".parquet"))
    write_named_tables(rows.withColumn("file_name", name), folder)


def write_archive(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").partitionBy("season").parquet(path)


def reindex(frame: DataFrame, wanted=ARCHIVE_COLUMNS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the wanted (name, type) columns: absent ones become null, others are dropped."""
    return frame.select(
        *[
            (F.col(name) if name in frame.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in wanted
        ],
        *keep,
    )
