"""Changing a table by new versions of its partitions; see `sources.snapshots` for the layout.

A change that stops before its pointer is written has changed nothing; what it left is removed by the next one.
Folders that no longer count stay until the change after, for readers that have begun. One job at a time changes
a table; a second one fails at its pointer.
"""

import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions.values import curve_cell
from gridseries.schema import OBS_SCHEMA
from gridseries.sinks import files
from gridseries.sources.snapshots import STORED_OBS, Snapshot, newest, partition, pointed, pointers, read_folders, read_rows
from gridseries.sources.tables import series_folder, series_of

PARTITIONS = ["source", "tier", "var", "year"]
# a partition that has come to more versions than this is written anew as one
MOST_VERSIONS = 16


def laid_out(obs: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Range-partition so that each task writes few directories and neighbouring places lie together.

    Rows are ordered along the curve where `cells` (source, loc_id, cell) knows their place, then by location.
    `time` is part of the range key: a series that holds a large share of all rows is split
    over several files instead of ending up in one task.
    """
    df = obs.select(OBS_SCHEMA.names).withColumn("year", F.year("time"))
    df = df.withColumn("cell", F.lit(None).cast("int")) if cells is None else df.join(cells, ["source", "loc_id"], "left")
    order = [*PARTITIONS, "cell", "loc_id", "time"]
    return df.select(STORED_OBS.names).repartitionByRange(*order).sortWithinPartitions(*order)


def store(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*PARTITIONS).parquet(path)


def work_folder(path: str) -> str:
    """A new folder for what one change needs to write aside; the next change removes what is left of it."""
    return f"{path.rstrip('/')}/_work/{uuid.uuid4().hex}"


def counted(spark: SparkSession, path: str) -> Snapshot:
    """What counts now, nothing for a new table. Raises for rows that were written elsewhere, as a change would hide them."""
    snapshot = newest(spark, path)
    if snapshot is None and any(f.startswith("source=") for f in files.folders(spark, path.rstrip("/"))):
        raise ValueError(f"{path} was written elsewhere; write it anew as a whole first")
    return snapshot or Snapshot()


def write_cells(catalogue: DataFrame, path: str) -> str:
    """Keep the cell of each location beside the table; returns the folder's name."""
    name = f"_cells/{uuid.uuid4().hex}"
    cells = catalogue.groupBy("source", "loc_id").agg(F.min(curve_cell(F.col("latitude"), F.col("longitude"))).alias("cell"))
    cells.write.option("compression", "zstd").parquet(f"{path.rstrip('/')}/{name}")
    return name


def read_cells(spark: SparkSession, path: str, snapshot: Snapshot) -> DataFrame | None:
    return spark.read.parquet(f"{path.rstrip('/')}/{snapshot.cells}") if snapshot.cells else None


def write_version(rows: DataFrame, path: str, snapshot: Snapshot, delta: bool = False) -> tuple[str, ...]:
    """Write rows and the list of their series as a version that does not count yet; returns its partition folders."""
    spark, top = rows.sparkSession, path.rstrip("/")
    version = f"version={snapshot.number + 1:012d}-{uuid.uuid4().hex[:8]}{'-delta' if delta else ''}"
    store(laid_out(rows, read_cells(spark, path, snapshot)), f"{top}/{version}")
    found = tuple(f"{version}/{f}" for f in files.folders_below(spark, f"{top}/{version}", len(PARTITIONS)))
    if found:
        store(series_of(read_folders(spark, path, list(found), STORED_OBS)), f"{series_folder(path)}/{version}")
    return found


def commit(spark: SparkSession, path: str, snapshot: Snapshot) -> None:
    """Let the snapshot's folders count from now on."""
    number = snapshot.number + 1
    content = {"number": number, "folders": sorted(snapshot.folders), "cells": snapshot.cells, "streams": snapshot.streams}
    files.write_text(spark, f"{pointers(path)}/{number:012d}", json.dumps(content))


def drop_unused(spark: SparkSession, path: str) -> int:
    """Remove what neither the newest pointer nor the one before names; returns the number of versions and partitions."""
    top, names = path.rstrip("/"), files.names(spark, pointers(path))
    if not names:
        return 0
    kept = [pointed(spark, path, n) for n in names[-2:]]
    folders = {f for s in kept for f in s.folders}
    versions = {f.split("/")[0] for f in folders}
    once = {f for n in names[:-2] for f in pointed(spark, path, n).folders}
    gone = {f for f in once - folders if f.split("/")[0] in versions}
    gone |= {v for v in files.folders(spark, top) if v.startswith(("version=", "source=")) and v not in versions}
    for folder in sorted(gone):
        files.remove(spark, f"{top}/{folder}")
        files.remove(spark, f"{series_folder(path)}/{folder}")
    for name in set(files.folders(spark, f"{top}/_cells")) - {s.cells.split("/")[1] for s in kept if s.cells}:
        files.remove(spark, f"{top}/_cells/{name}")
    files.remove(spark, f"{top}/_work")
    for name in names[:-2]:
        files.remove(spark, f"{pointers(path)}/{name}")
    return len(gone)


def _crowded(folders: tuple[str, ...]) -> set[tuple]:
    counts: dict[tuple, int] = {}
    for f in folders:
        counts[partition(f).key] = counts.get(partition(f).key, 0) + 1
    return {key for key, n in counts.items() if n > MOST_VERSIONS}


def compact(spark: SparkSession, path: str, keys: set[tuple] | None = None) -> None:
    """Write partitions that consist of several versions, or those named, anew as one, rows and lists of series."""
    snapshot = newest(spark, path)
    if keys is None:
        found = [partition(f).key for f in snapshot.folders]
        keys = {k for k in found if found.count(k) > 1}
    if keys:
        rows = read_rows(spark, path, lambda p: p.key in keys).select(OBS_SCHEMA.names)
        new = write_version(rows, path, snapshot)
        commit(spark, path, replace(snapshot, folders=tuple(f for f in snapshot.folders if partition(f).key not in keys) + new))
    drop_unused(spark, path)


def append_rows(rows: DataFrame, path: str, delta: bool = False, stream: tuple[str, int] | None = None) -> None:
    """Add rows without reading the table. With `delta` they replace rows with their keys, whatever older version has those.

    `stream` names a stream and its batch; a batch that is in already changes nothing.
    """
    spark = rows.sparkSession
    snapshot = counted(spark, path)
    if stream and snapshot.streams.get(stream[0], -1) >= stream[1]:
        return
    folders = snapshot.folders + write_version(rows, path, snapshot, delta)
    commit(spark, path, replace(snapshot, folders=folders, streams={**snapshot.streams, **dict([stream] if stream else [])}))
    drop_unused(spark, path)
    if crowded := _crowded(folders):
        compact(spark, path, crowded)


def replace_rows(rows: DataFrame, path: str, whole_tiers: set[tuple[str, str]] = frozenset()) -> None:
    """Replace the partitions that the rows fall in, and all of `whole_tiers` (source, tier), by the rows.

    The rows may be read from the table.
    """
    spark = rows.sparkSession
    snapshot = counted(spark, path)
    new = write_version(rows, path, snapshot)
    keys = {partition(f).key for f in new}
    kept = tuple(f for f in snapshot.folders if partition(f).key not in keys and partition(f).key[:2] not in whole_tiers)
    commit(spark, path, replace(snapshot, folders=kept + new))
    drop_unused(spark, path)


def replace_table(rows: DataFrame, path: str, catalogue: DataFrame | None = None) -> None:
    """Replace all rows; with a catalogue, this and later versions are ordered by place."""
    spark = rows.sparkSession
    snapshot = newest(spark, path) or Snapshot()
    snapshot = replace(snapshot, cells=write_cells(catalogue, path) if catalogue is not None else None)
    commit(spark, path, replace(snapshot, folders=write_version(rows, path, snapshot)))
    drop_unused(spark, path)
