"""The station network, from landed files to the stored table."""

from pyspark.sql import DataFrame, SparkSession

from gridseries.plans.ingest import ingest_stations
from gridseries.plans.promote import refresh_current
from gridseries.sinks.writers import write_catalogue, write_raw
from gridseries.sources.raw import read_station_raw
from gridseries.sources.tables import read_catalogue


def land_stations(spark: SparkSession, folder: str, old_catalogue: DataFrame, path: str, catalogue_path: str, rejects: str,
                  fmt: str = "parquet") -> DataFrame:
    """Read all station files, extend the catalogue, and let their rows into the current tier of the table.

    The extended catalogue is written to `catalogue_path` first and returned as read from there, so an id never
    reaches the table before it can be looked up; `catalogue_path` must not be where the old one is read from.
    Rows of unknown variables are written to `rejects`.
    """
    raw = read_station_raw(spark, folder, fmt)
    obs, catalogue, unknown = ingest_stations(raw, old_catalogue)
    write_catalogue(catalogue, catalogue_path)
    write_raw(unknown, rejects)
    refresh_current(spark, obs, path)
    return read_catalogue(spark, catalogue_path, "stations")
