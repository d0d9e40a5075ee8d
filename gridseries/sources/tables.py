"""Catalogues and observation tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.functions.times import as_time
from gridseries.schema import CATALOGUE_SCHEMA, OBS_SCHEMA
from gridseries.sources.snapshots import STORED_OBS, Partition, newest, partition, read_folders, read_rows

STORED_SERIES = T.StructType([f for f in STORED_OBS.fields if f.name not in ("time", "value", "cell")] + [
    T.StructField("first", T.TimestampNTZType()), T.StructField("last", T.TimestampNTZType()), T.StructField("n", T.LongType())])


def read_catalogue(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Location CSV. Column order differs between files, so columns are taken by name."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(
        F.lit(source).alias("source"),
        F.col("loc_id").cast("int"),
        F.col("latitude").cast("double"),
        F.col("longitude").cast("double"),
    ).to(CATALOGUE_SCHEMA)


def drop_index_artifacts(df: DataFrame) -> DataFrame:
    """Drop serialised frame indexes that foreign writers leave in Parquet files."""
    return df.select(df.colRegex("`^(?!__index_level_).*$`"))


def in_years(years: Column, start: str | None, end: str | None) -> Column:
    test = F.lit(True)
    if start is not None:
        test = test & (years >= F.year(as_time(start)))
    if end is not None:
        test = test & (years <= F.year(as_time(end)))
    return test


def scan_obs(spark: SparkSession, path: str, source=None, tiers=None, variables=None, locs=None,
             start=None, end=None, cells: list[tuple[int, int]] | None = None) -> DataFrame:
    """Observation rows of a written table.

    Source, tier, variable and year choose folders; location and time reach the Parquet row groups, which
    are sorted by them. `cells` are ranges of cells on the curve that the rows are ordered by, as
    `space.cells_around` finds them: rows elsewhere are left out, but for rows whose place the table does not know.
    """
    sources = None if source is None else {source} if isinstance(source, str) else set(source)
    years = [None if at is None else int(str(at)[:4]) for at in (start, end)]

    def keep(p: Partition) -> bool:
        return ((sources is None or p.source in sources) and (tiers is None or p.tier in tiers) and (variables is None or p.var in variables)
                and (years == [None, None] or p.year is not None and (years[0] or p.year) <= p.year <= (years[1] or p.year)))

    df = read_rows(spark, path, keep, None if cells is None else in_cells(F.col("cell"), cells))
    if sources is not None:
        df = df.filter(F.col("source").isin(sorted(sources)))
    if tiers is not None:
        df = df.filter(F.col("tier").isin(list(tiers)))
    if variables is not None:
        df = df.filter(F.col("var").isin(list(variables)))
    if locs is not None:
        df = df.filter(F.col("loc_id").isin(list(locs)))
    if start is not None or end is not None:
        df = df.filter(in_years(F.col("year"), start, end))
    if start is not None:
        df = df.filter(F.col("time") >= as_time(start))
    if end is not None:
        df = df.filter(F.col("time") <= as_time(end))
    return df.select(OBS_SCHEMA.names)


def in_cells(cell: Column, ranges: list[tuple[int, int]]) -> Column:
    """In one of the ranges, both ends included, or unknown."""
    test = cell.isNull()
    for low, high in ranges:
        test = test | cell.between(low, high)
    return test


def series_folder(path: str) -> str:
    """Where a table keeps the list of its series; the name hides it from readers of the rows."""
    return f"{path.rstrip('/')}/_series"


def series_of(obs: DataFrame) -> DataFrame:
    """One row per series, tier and year: first and last time, and how many rows."""
    return obs.groupBy("source", "tier", "var", "loc_id", F.year("time").alias("year")).agg(
        F.min("time").alias("first"), F.max("time").alias("last"), F.count("*").alias("n"))


def scan_series(spark: SparkSession, path: str) -> DataFrame:
    """The list of a table's series with `time`, the last one of each year; no rows are read.

    Every version of a partition has a list of its own; lists of the same partition are merged. In a partition with
    rows that a stream replaced, `n` counts those too. Tables from elsewhere are scanned.
    """
    snapshot = newest(spark, path)
    if snapshot is None:
        return series_of(spark.read.schema(STORED_OBS).parquet(path)).withColumn("time", F.col("last"))
    keys = [partition(f).key for f in snapshot.folders]
    listed = read_folders(spark, series_folder(path), list(snapshot.folders), STORED_SERIES).drop("version")
    if len(set(keys)) < len(keys):
        listed = listed.groupBy("source", "tier", "var", "loc_id", "year").agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
    return listed.withColumn("time", F.col("last"))


def empty_result(spark: SparkSession, variables: list[str]) -> DataFrame:
    fields = [T.StructField("time", T.TimestampNTZType())]
    fields += [T.StructField(v, T.DoubleType()) for v in variables]
    return spark.createDataFrame([], T.StructType(fields))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder? Asked through the listing source, which reads no content."""
    try:
        spark.read.format("binaryFile").load(path).select("path").schema
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
