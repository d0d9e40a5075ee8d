"""What to fetch next, as rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.operators.lifecycle import (
    active_stations, backfill_months, backfill_years, grid_requests, not_landed, resume_or_default,
    resume_times)
from gridseries.functions import names
from gridseries.schema import COLLECTED, DEFAULT_START, REQUEST_NAMES


def collected_variables(spark, source: str) -> DataFrame:
    """Variables of a grid source that are fetched by default, under their conformed names."""
    conformed = {asked: var for var, asked in REQUEST_NAMES.items()}
    rows = [(source, conformed.get(v, v)) for v in COLLECTED[source]]
    return spark.createDataFrame(rows, "source string, var string")


def plan_point(obs: DataFrame, catalogue: DataFrame, now, default: str = DEFAULT_START) -> DataFrame:
    """Location-years of the point product."""
    keys = catalogue.select("source", "loc_id", "latitude", "longitude")
    resumed = resume_or_default(keys, resume_times(obs, "loc_id", now), "loc_id", default)
    return backfill_years(resumed, now)


def plan_grid(obs: DataFrame, keys: DataFrame, now, default: str = DEFAULT_START) -> DataFrame:
    """Variable-months of a grid product. `keys` has (source, var)."""
    resumed = resume_or_default(keys, resume_times(obs, "var", now), "var", default)
    return grid_requests(backfill_months(resumed, now))


def select_stations(meta: DataFrame, landed: DataFrame, owner: str, since: str) -> tuple[DataFrame, DataFrame]:
    """(station files to fetch, stations whose variable is unknown).

    `landed` has (file_name) of what is there already.
    """
    active = active_stations(meta, owner, since)
    named = active.withColumn("var", names.station_variable(F.col("feature"), F.col("parameter")))
    wanted = named.filter(F.col("var").isNotNull())
    wanted = wanted.withColumn("file_name", names.station_file(F.col("var"), F.col("ref")))
    return not_landed(wanted, landed, "file_name"), named.filter(F.col("var").isNull())
