"""Drains newly cached pages into the fact and its maps, then stops; run it again for the next ones.

Every micro-batch writes a folder of its own, partitioned by league and season, and counts once a manifest names it. A
batch that is repeated after a failure replaces its folder, or is passed over if it was compacted meanwhile. Maps are appended
once per drain, from all its batches, so ids do not depend on how a drain is split; a version is named after the last batch
it knows. Compaction writes the rows of all folders anew and then names the new folder instead of them: a reader sees the
old files or the new ones, never both. One drain or compaction at a time may work on a root.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxlake.functions.links import file_glob
from boxlake.leagues import League
from boxlake.operators.pages import extract_box_scores
from boxlake.plans.dimensions import PAGE_ORDER, official_map, player_map
from boxlake.schemas import BOX_SCORE, FILE, columns, struct
from boxlake.sources.dimensions import read_version, write_version
from boxlake.sources.facts import season_of_file
from boxlake.sources.manifest import read_manifest, write_manifest
from boxlake.sources.named_files import as_binary_files, drop_folders_but, files_left, stream_files
from boxlake.sources.raw_pages import as_raw_pages

_MAPS = {"official_map": official_map, "player_map": player_map}
_INGESTED = BOX_SCORE + ", error string, batch long, season int"


def page_stream(spark: SparkSession, folder: str, league: League, files_per_batch: int = 10_000) -> DataFrame:
    """Raw pages of a folder as a stream; each file is seen once. Batches bound the work of one step, not the result.

    A folder that has a manifest is listed by tasks, and a batch counts its files of all kinds.
    """
    if read_manifest(spark, folder) is not None:
        return as_raw_pages(as_binary_files(stream_files(spark, folder, files_per_batch), folder), league)
    files = (
        spark.readStream.format("binaryFile").schema(struct(FILE))
        .option("pathGlobFilter", file_glob(league))
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return as_raw_pages(files, league)


def _state(spark: SparkSession, root: str) -> dict:
    return read_manifest(spark, root) or {"version": -1, "last_batch": -1, "compacted": -1, "folders": [], "maps": {}}


def _commit(spark: SparkSession, root: str, state: dict, **changes) -> None:
    write_manifest(spark, root, {**state, **changes, "version": state["version"] + 1})


def drain(pages: DataFrame, root: str, layout: str = "id", partitions: int | None = None) -> None:
    """Take in all pages there are, write fact, errors and maps, and end.

    ``partitions`` deals the pages of a batch out to so many tasks before they are parsed, for streams whose files each
    hold many pages. A drain that died before its maps were written is made up for by the next one.
    """
    spark = pages.sparkSession

    def take_in(batch: DataFrame, number: int) -> None:
        state = _state(batch.sparkSession, root)
        if number <= state["compacted"]:
            return
        dealt = batch.repartition(partitions) if partitions else batch
        rows = extract_box_scores(dealt, layout, "quarantine").withColumn("batch", F.lit(number).cast("long"))
        folder = f"part=batch-{number}-{uuid.uuid4().hex}"
        _write(rows.withColumn("season", season_of_file(F.col("league"), F.col("file_name"))), f"{root}/rows/{folder}")
        others = [f for f in state["folders"] if f["last_batch"] != number]
        _commit(batch.sparkSession, root, state, last_batch=max(number, state["last_batch"]), folders=[*others, {"path": folder, "last_batch": number}])

    more = True
    while more:
        run = pages.writeStream.foreachBatch(take_in).option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start()
        run.awaitTermination()
        more = run.lastProgress is not None and files_left(run.lastProgress.json)
    append_maps(spark, root)


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy("league", "season").parquet(path)


def append_maps(spark: SparkSession, root: str) -> None:
    """A new version of each map, if batches were taken in since its last one."""
    state = _state(spark, root)
    last, maps = state["last_batch"], dict(state["maps"])
    for name, build in _MAPS.items():
        done = maps.get(name)
        if last >= 0 and (done is None or done < last):
            new = ingested_fact(spark, root, after=done)
            write_version(build(new, read_version(spark, f"{root}/{name}", done)), f"{root}/{name}", last)
            maps[name] = last
    if maps != state["maps"]:
        _commit(spark, root, state, maps=maps)


def compact(spark: SparkSession, root: str, bytes_per_file: int = 128 * 1024 * 1024) -> None:
    """Write the rows of all live folders anew, in as many files a league and season as their size asks for.

    Rows are dealt out by page, so a season that holds most rows is written by many tasks, and are in page order within
    a file. Old folders stay for readers that still use them, until ``drop_old_rows``.
    """
    state = _state(spark, root)
    if len(state["folders"]) < 2:
        return
    rows = ingested(spark, root)
    files = rows.select("league", "season", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    sizes = files.groupBy("league", "season").agg(F.greatest(F.ceil(F.sum("size") / bytes_per_file), F.lit(1)).alias("_files"))
    before = Window.orderBy("league", "season").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_first", F.coalesce(F.sum("_files").over(before), F.lit(0)))
    total = sizes.agg(F.sum("_files")).first()[0] or 1
    # a row per league and season
    slots = F.broadcast(sizes.withColumnsRenamed({"league": "_league", "season": "_season"}))
    placed = rows.join(slots, F.col("league").eqNullSafe(F.col("_league")) & F.col("season").eqNullSafe(F.col("_season")))
    placed = placed.withColumn("_slot", (F.col("_first") + F.pmod(F.xxhash64("file_name"), F.col("_files"))).cast("int"))
    folder = f"part=compacted-{state['last_batch']}-{uuid.uuid4().hex}"
    dealt = placed.repartitionById(total, "_slot").sortWithinPartitions("league", "season", *PAGE_ORDER)
    _write(dealt.select(*columns(_INGESTED)), f"{root}/rows/{folder}")
    _commit(spark, root, state, compacted=state["last_batch"], folders=[{"path": folder, "last_batch": state["last_batch"]}])


def drop_old_rows(spark: SparkSession, root: str) -> int:
    """Remove folders of rows that count no more, once nobody reads them; no drain or compaction may be at work."""
    return drop_folders_but(f"{root}/rows", {f["path"] for f in _state(spark, root)["folders"]})


def ingested(spark: SparkSession, root: str, after: int | None = None) -> DataFrame:
    """All rows taken in so far, or by batches after one; unreadable pages as rows with an ``error``.

    Only live folders are listed, and a filter on league or season leaves the other folders' files unopened.
    """
    live = [f for f in _state(spark, root)["folders"] if after is None or f["last_batch"] > after]
    if not live:
        return spark.createDataFrame([], _INGESTED)
    rows = spark.read.schema(struct(_INGESTED)).option("basePath", f"{root}/rows").parquet(*[f"{root}/rows/{f['path']}" for f in live]).drop("part")
    return rows if after is None else rows.where(F.col("batch") > after)


def ingested_fact(spark: SparkSession, root: str, after: int | None = None) -> DataFrame:
    """Rows of the fact, of all batches or of those after one."""
    return ingested(spark, root, after).where("error IS NULL").select(*struct(BOX_SCORE).names)


def ingested_errors(spark: SparkSession, root: str) -> DataFrame:
    return ingested(spark, root).where("error IS NOT NULL").select("league", "file_name", "error")


def latest_map(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Newest version of a map."""
    return read_version(spark, f"{root}/{name}", _state(spark, root)["maps"].get(name))
