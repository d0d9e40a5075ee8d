"""Which folders of a table count: versions of partitions, and the pointer to those of now.

A table is `version=<number>-<id>/source=/tier=/var=/year=` below its path. A change writes a new version and,
as its last step, one small file below `_snapshots` that names the partition folders that count from then on.
Readers take the folders of the newest such file, so they see a table before or after a change, never between.
A version whose name ends in `-delta` holds rows that replace older ones with the same key; where a partition
has one, its versions are merged when they are read. A folder without `_snapshots` is read as it is.
"""

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.schema import OBS_KEY, OBS_SCHEMA
from gridseries.sinks import files

NO_YEAR = "__HIVE_DEFAULT_PARTITION__"
# `cell` orders the rows of a partition along a curve over the map; null where the place is not known
STORED_OBS = T.StructType(OBS_SCHEMA.fields + [T.StructField("cell", T.IntegerType()), T.StructField("year", T.IntegerType())])


@dataclass(frozen=True)
class Partition:
    version: str
    source: str
    tier: str
    var: str
    year: int | None

    @property
    def key(self) -> tuple:
        return self.source, self.tier, self.var, self.year


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    folders: tuple[str, ...] = ()
    # folder of the cells of the table's locations
    cells: str | None = None
    # the last batch of each stream whose rows are in
    streams: dict = field(default_factory=dict)


def partition(folder: str) -> Partition:
    parts = dict(part.split("=", 1) for part in folder.split("/"))
    year = None if parts["year"] == NO_YEAR else int(parts["year"])
    return Partition(parts["version"], *(unquote(parts[k]) for k in ("source", "tier", "var")), year)


def pointers(path: str) -> str:
    return f"{path.rstrip('/')}/_snapshots"


def pointed(spark: SparkSession, path: str, name: str) -> Snapshot:
    found = json.loads(files.read_text(spark, f"{pointers(path)}/{name}"))
    return Snapshot(found["number"], tuple(found["folders"]), found["cells"], found["streams"])


def newest(spark: SparkSession, path: str) -> Snapshot | None:
    """What counts now; None if the table has no pointer."""
    names = files.names(spark, pointers(path))
    return pointed(spark, path, names[-1]) if names else None


def layered(folders: tuple[str, ...] | list[str]) -> set[tuple]:
    """Keys of the partitions whose versions have to be merged."""
    return {p.key for p in map(partition, folders) if p.version.endswith("-delta")}


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """Rows of some partition folders with their version."""
    schema = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    if not folders:
        return spark.createDataFrame([], schema)
    top = path.rstrip("/")
    return spark.read.schema(schema).option("basePath", top).parquet(*[f"{top}/{f}" for f in folders])


def read_rows(spark: SparkSession, path: str, keep: Callable[[Partition], bool] = lambda p: True, near: Column | None = None) -> DataFrame:
    """The stored rows of the partitions that `keep` chooses. `near` is a condition on cells."""
    snapshot = newest(spark, path)
    if snapshot is None:
        # partition columns of a foreign table prune by themselves
        return spark.read.schema(STORED_OBS).parquet(path)
    chosen = [f for f in snapshot.folders if keep(partition(f))]
    merging = layered(chosen)
    plain = read_folders(spark, path, [f for f in chosen if partition(f).key not in merging], STORED_OBS)
    plain = plain.filter(near) if near is not None else plain
    if not merging:
        return plain.select(STORED_OBS.names)
    several = read_folders(spark, path, [f for f in chosen if partition(f).key in merging], STORED_OBS)
    several = several.filter(near) if near is not None else several
    merged = several.groupBy(*OBS_KEY, "year").agg(F.max_by("value", "version").alias("value"), F.max("cell").alias("cell"))
    return plain.select(STORED_OBS.names).unionByName(merged.select(STORED_OBS.names))
