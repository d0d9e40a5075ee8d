"""The periodic job: ingest what has landed for all sources into the current tier."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators.quality import coverage
from gridseries.plans.ingest import ingest_grid, ingest_point
from gridseries.plans.promote import refresh_current
from gridseries.plans.backfill import collected_variables, plan_grid, plan_point
from gridseries.schema import GRID_SOURCES, SERVED_SOURCES, VARIABLES
from gridseries.sources.tables import scan_obs, scan_series


def ingest_landed(landed: dict[str, DataFrame | list[DataFrame]], catalogues: DataFrame) -> DataFrame:
    """One frame of current rows from the landings of all sources.

    `landed` maps the point source to its payloads and a grid source to one frame per variable.
    """
    whole = None
    for source in SERVED_SOURCES:
        if source not in landed:
            continue
        frames = landed[source] if isinstance(landed[source], list) else [landed[source]]
        for frame in frames:
            rows = (ingest_point(frame) if source == "nasapower"
                    else ingest_grid(frame, catalogues, source))
            whole = rows if whole is None else whole.unionByName(rows)
    if whole is None:
        raise ValueError(f"nothing landed for any of {SERVED_SOURCES}")
    return whole


def plan_update(spark: SparkSession, path: str, catalogues: DataFrame, now) -> DataFrame:
    """What to fetch for all sources of the catalogue, from the table's state.

    Location-years of the point product and variable-months of the grids, as one table.
    """
    obs = scan_series(spark, path)
    points = plan_point(obs, catalogues.filter(F.col("source") == "nasapower"), now)
    plan = points.select("source", "loc_id", F.lit(None).cast("string").alias("var"), "year", F.lit(None).cast("int").alias("month"),
                         "start_date", "end_date", F.lit(None).cast("string").alias("file_name"))
    wanted = catalogues.select("source").distinct()
    for source in GRID_SOURCES:
        keys = collected_variables(spark, source).join(wanted, "source", "left_semi")
        months = plan_grid(obs, keys, now)
        plan = plan.unionByName(months.select(
            "source", F.lit(None).cast("int").alias("loc_id"), "var", "year", "month", F.lit(None).cast("int").alias("start_date"),
            F.lit(None).cast("int").alias("end_date"), "file_name"))
    return plan


def update_all(spark: SparkSession, landed: dict, catalogues: DataFrame, path: str) -> None:
    refresh_current(spark, ingest_landed(landed, catalogues), path)


def source_coverage(spark: SparkSession, path: str, catalogues: DataFrame, source: str) -> DataFrame:
    """Stored rows per variable and location of one source; 0 where nothing was delivered."""
    wanted = sorted(set(VARIABLES[source].values()))
    return coverage(scan_obs(spark, path, source=source), catalogues.filter(catalogues.source == source), wanted)
