"""Observation tables, raw landings, JSON records and catalogues."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.sinks.versions import append_rows, replace_rows, replace_table

RECORD_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "ignoreNullFields": "false"}


def write_obs(obs: DataFrame, path: str, mode: str = "overwrite", partition_mode: str = "static", catalogue: DataFrame | None = None) -> None:
    """Write rows of a table: all of it, with dynamic partitions those that the rows fall in, or in addition.

    With a catalogue, a new table is ordered by place, so a batch of requests reads the row groups of its
    neighbourhoods. Readers see the table as it was until all rows are written.
    """
    if mode == "append":
        append_rows(obs, path)
    elif partition_mode == "dynamic":
        replace_rows(obs, path)
    else:
        replace_table(obs, path, catalogue)


def write_raw(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def to_records(df: DataFrame, *keep: str) -> DataFrame:
    """One JSON text per row; nulls stay visible."""
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in keep])
    return df.select(*keep, F.to_json(record, RECORD_OPTIONS).alias("record"))


def response_message(source: Column, lat: Column, lon: Column, variables: Column, start: Column,
                     end: Column, mode: Column) -> Column:
    stamp = "yyyy-MM-dd HH:mm:ss"
    return F.format_string(
        "%s series at %s,%s for %s from %s to %s, mode %s",
        source, lat.cast("string"), lon.cast("string"), F.array_join(variables, ", "),
        F.date_format(start, stamp), F.date_format(end, stamp), mode)


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**RECORD_OPTIONS).json(path)


def write_catalogue(catalogue: DataFrame, path: str, mode: str = "overwrite") -> None:
    (catalogue.select("longitude", "latitude", "loc_id")
     .write.mode(mode).option("header", True).csv(path))
