"""Raw landings: point payloads, flattened grid extracts, station files."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions import names, times
from gridseries.operators.quality import drop_null_rows
from gridseries.operators.shape import value_column
from gridseries.schema import REQUEST_NAMES
from gridseries.sources.layouts import by_layout, describe_files

PAYLOAD_SCHEMA = "struct<properties: struct<parameter: map<string, map<string, double>>>>"
STATION_AXES = ["time", "lat", "lon"]
STATION_EXTRAS = ["geometry", "height", "externalId", "name", "station_id", "ref"]


def parse_point_payload(df: DataFrame, json_col: str, keep: list[str]) -> DataFrame:
    """One row per (payload, parameter, hour).

    Parameters of one payload are aligned on the union of their hours: an hour that one of
    them lacks becomes a row with a null value. Each payload is one location and year, so the
    hour lists are bounded and the alignment needs no shuffle. Rows whose hour key is no time are
    left out; `payload_rejects` reports them and payloads that cannot be read.
    """
    parsed = df.select(
        *keep, F.from_json(json_col, PAYLOAD_SCHEMA).getField("properties").getField("parameter").alias("params"))
    hours = F.array_distinct(F.flatten(F.transform(F.map_values("params"), lambda m: F.map_keys(m))))
    by_param = parsed.select(*keep, hours.alias("hours"), F.explode("params").alias("raw_name", "by_hour"))
    missing = F.transform(
        F.array_except("hours", F.map_keys("by_hour")),
        lambda h: F.struct(h.alias("key"), F.lit(None).cast("double").alias("value")))
    rows = by_param.select(
        *keep, "raw_name", F.explode(F.concat(F.map_entries("by_hour"), missing)).alias("entry"))
    rows = rows.select(
        *keep, "raw_name", times.parse_hour_key(F.col("entry.key")).alias("time"),
        F.col("entry.value").alias("value"))
    return rows.filter(F.col("time").isNotNull())


def payload_rejects(df: DataFrame, json_col: str, keep: list[str]) -> DataFrame:
    """(keep, reason) of payloads without readable parameters, and of each bad hour key."""
    params = F.from_json(json_col, PAYLOAD_SCHEMA).getField("properties").getField("parameter")
    hours = F.array_distinct(F.flatten(F.transform(F.map_values("params"), lambda m: F.map_keys(m))))
    bad = F.filter(hours, lambda h: times.parse_hour_key(h).isNull())
    parsed = df.select(*keep, params.alias("params")).withColumn(
        "reasons", F.when(F.coalesce(F.size("params") < 1, F.lit(True)), F.array(F.lit("no readable parameters")))
        .otherwise(F.transform(bad, lambda h: F.concat(F.lit("bad hour key: "), h))))
    return parsed.select(*keep, F.explode("reasons").alias("reason"))


def normalise_time(df: DataFrame) -> DataFrame:
    """Grid extracts call their time axis `time` or `valid_time`."""
    if "time" in df.columns:
        return df
    if "valid_time" in df.columns:
        return df.withColumnRenamed("valid_time", "time")
    raise ValueError(f"no time column among {df.columns}")


def grid_rows(extract: DataFrame, source: str) -> DataFrame:
    """raw_name, longitude, latitude, time, value of the unmasked cells of one extract.

    Rows with a null in any column go, so auxiliary columns count.
    """
    whole = drop_null_rows(normalise_time(extract))
    raw_name = value_column(whole, source)
    return whole.select(
        F.lit(raw_name).alias("raw_name"), F.col("longitude").cast("double").alias("longitude"),
        F.col("latitude").cast("double").alias("latitude"), F.col("time").cast("timestamp_ntz").alias("time"),
        F.col(f"`{raw_name}`").cast("double").alias("value"))


def read_grid_raw(spark: SparkSession, paths: list[str], source: str, fmt: str = "parquet", described: DataFrame | None = None) -> DataFrame:
    """`grid_rows` of all files, which may differ in variable, columns, their order and the time's name.

    Files with the same columns are read by one scan. Each such group is reduced to common columns
    before the union: an auxiliary column of some files says nothing about the rows of the others.
    `described` is what `describe_files` found of the paths, if that is known already.
    """
    if not paths:
        raise ValueError("no grid files")
    described = describe_files(spark, paths, fmt) if described is None else described
    return reduce(DataFrame.unionByName, (grid_rows(part, source) for part in by_layout(spark, described, fmt)))


def station_rows(df: DataFrame, file_name: Column) -> DataFrame:
    """Name the value column (always the last one) after the file's variable, in long form."""
    rest = [c for c in df.columns if c not in STATION_EXTRAS]
    if not rest or rest[-1] in STATION_AXES or not set(STATION_AXES) <= set(rest):
        raise ValueError(f"no time, place and value, in that order, among {df.columns}")
    return df.select(
        names.station_var(file_name).alias("var"), names.station_ref(file_name).alias("ref"), F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"), "time", F.col(f"`{rest[-1]}`").cast("double").alias("value"))


def read_station_raw(spark: SparkSession, path: str, fmt: str = "parquet", glob: str = "*_!_*") -> DataFrame:
    """Station files; variable and station come from each file's name, the value from its own last column."""
    described = describe_files(spark, path, fmt, glob)
    parts = [station_rows(part, F.col("_metadata.file_name")) for part in by_layout(spark, described, fmt)]
    if not parts:
        raise ValueError(f"no station files in {path}")
    return reduce(DataFrame.unionByName, parts)


def match_files(manifest: DataFrame, column: str = "file_name", **how) -> DataFrame:
    return manifest.filter(names.matches_file(F.col(column), **how))


def grid_files_of(manifest: DataFrame, var: str | list[str], column: str = "file_name", extensions: list[str] | None = None) -> DataFrame:
    """Monthly files of one or several conformed variables."""
    wanted = [REQUEST_NAMES.get(v, v) for v in ([var] if isinstance(var, str) else var)]
    named = names.grid_file_variable(F.col(column)).isin(wanted)
    return match_files(manifest, column, extension=extensions or ["netcdf.zip", "nc"]).filter(named)
