"""Cached page files: one file per page, named after its link."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxlake.functions.links import BOX_SCORE, PLAY_BY_PLAY, SCHEDULE, file_glob, file_pattern, file_year
from boxlake.leagues import League
from boxlake.schemas import RAW_PAGE, columns
from boxlake.sources.manifest import read_manifest, write_manifest
from boxlake.sources.named_files import as_binary_files, list_files, live_folders

OTHER_KIND = "other"


def _name_of(path) -> F.Column:
    return F.element_at(F.split(path, "/"), -1)


def read_raw_pages(
    spark: SparkSession, folder: str, league: League, kind: str = BOX_SCORE, years: list[int] | None = None
) -> DataFrame:
    """Pages of one league and kind at the top level of a folder, or in the folders that its manifest names; none if it
    is missing.

    The listing is pruned, by calendar years too if given, before any content is read; the
    league's whole-name pattern then decides, so another league's page or a play-by-play page is
    never taken for a box score. Content is read only if used. With a manifest tasks do the listing.
    """
    if read_manifest(spark, folder) is not None:
        files = as_raw_pages(as_binary_files(list_files(spark, folder), folder), league, kind)
        return files.where(file_year(league, F.col("file_name"), kind).isin(years)) if years else files
    reader = spark.read.format("binaryFile").option("pathGlobFilter", file_glob(league, kind, years))
    try:
        files = reader.load(folder)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return spark.createDataFrame([], RAW_PAGE)
    return as_raw_pages(files, league, kind)


def as_raw_pages(files: DataFrame, league: League, kind: str = BOX_SCORE) -> DataFrame:
    """``binaryFile`` rows, batch or streaming, in the raw-page shape."""
    return (
        files.withColumn("file_name", _name_of(F.col("path")))
        .where(F.col("file_name").rlike(file_pattern(league, kind)))
        .withColumnRenamed("modificationTime", "modification_time")
        .withColumn("league", F.lit(league.key))
        .select(*columns(RAW_PAGE))
    )


def read_play_by_play(
    spark: SparkSession, folder: str, league: League, years: list[int] | None = None
) -> DataFrame:
    return read_raw_pages(spark, folder, league, PLAY_BY_PLAY, years)


def compact_raw_pages(
    pages: DataFrame, path: str, league: League, kind: str = BOX_SCORE, bytes_per_file: int = 128 * 1024 * 1024
) -> None:
    """Write many small page files as few Parquet files by league, kind and year.

    A first look at the listing alone gives each year's size and so its number of files; pages are
    then dealt out by name, so the year that holds most pages is written by as many tasks as it
    needs, one file each, and content is read once. Leagues, kinds and years that are not in
    ``pages`` stay as they are.
    """
    dated = pages.withColumns({"kind": F.lit(kind), "year": file_year(league, F.col("file_name"), kind)})
    sizes = dated.groupBy("league", "year").agg(F.greatest(F.ceil(F.sum("length") / bytes_per_file), F.lit(1)).alias("_files"))
    # a row per four-digit year
    before = Window.orderBy("league", "year").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_first", F.coalesce(F.sum("_files").over(before), F.lit(0)))
    total = sizes.agg(F.sum("_files")).first()[0] or 1
    placed = dated.join(F.broadcast(sizes), ["league", "year"]).withColumn(
        "_slot", (F.col("_first") + F.pmod(F.xxhash64("file_name"), F.col("_files"))).cast("int")
    )
    (
        placed.repartitionById(total, "_slot").drop("_files", "_first", "_slot")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("league", "kind", "year").parquet(path)
    )


def newest_file(pages: DataFrame) -> DataFrame:
    """Newest modification time per league; reads the file listing only."""
    return pages.groupBy("league").agg(F.max("modification_time").alias("newest_raw_file"))


def page_kind(league: League, file_name: Column) -> Column:
    """What a file of a league's folder is by its name; ``other`` if the name is none of the league's."""
    kind = F.lit(OTHER_KIND)
    for known in (SCHEDULE, PLAY_BY_PLAY, BOX_SCORE):
        kind = F.when(file_name.rlike(file_pattern(league, known)), known).otherwise(kind)
    return kind


def folder_freshness(spark: SparkSession, folder: str, league: League, mark: str | None = None) -> DataFrame:
    """(league, kind, files, newest) of all files of a league's folder, whatever they are; no file is opened.

    With ``mark``, a folder for the last finding, only folders that the manifest has named since are listed: the rest is
    known. Without a manifest all names are listed.
    """
    known = (read_manifest(spark, mark) if mark else None) or {"version": -1, "folders": [], "kinds": []}
    live = live_folders(spark, folder)
    plain = live == [folder]
    gone = not set(known["folders"]) <= set(live)  # overwritten since: what was known of them holds no more
    fresh = live if plain or gone else [f for f in live if f not in set(known["folders"])]
    rows = [] if plain or gone else [tuple(r) for r in known["kinds"]]
    if fresh:
        try:
            files = spark.read.format("binaryFile").load(folder).withColumn("file_name", _name_of(F.col("path"))) if plain else list_files(spark, folder, fresh)
            listed = files.select(page_kind(league, F.col("file_name")).alias("kind"), F.unix_micros("modificationTime").alias("newest"))
            rows += [tuple(r) for r in listed.groupBy("kind").agg(F.count("*"), F.max("newest")).collect()]  # a row a kind
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
    found = spark.createDataFrame(rows, "kind string, files long, newest long").groupBy("kind").agg(F.sum("files").alias("files"), F.max("newest").alias("newest"))
    if mark and (fresh or gone):
        kinds = [list(r) for r in found.collect()]
        write_manifest(spark, mark, {"version": known["version"] + 1, "folders": live, "kinds": kinds})
    return found.select(F.lit(league.key).alias("league"), "kind", "files", F.timestamp_micros("newest").alias("newest"))


def newest_in_folder(freshness: DataFrame) -> DataFrame:
    """Newest modification time per league over every kind of file."""
    return freshness.groupBy("league").agg(F.max("newest").alias("newest_raw_file"))
