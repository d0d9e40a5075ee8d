"""Raw landings to observation rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators.quality import drop_sentinel, fill_by_hour
from gridseries.operators.shape import conform_names, correct_coords
from gridseries.operators.space import (
    check_dense_ids, distinct_coordinates, extend_catalogue, locate_cells, locate_stations)
from gridseries.schema import CURRENT, GRID_SOURCES, HISTORIC, OBS_SCHEMA, VARIABLES, coordinate_fixes
from gridseries.schema import variables as variable_table
from gridseries.sinks.writers import write_obs
from gridseries.sources.raw import grid_files_of, grid_rows, parse_point_payload, payload_rejects, read_grid_raw
from gridseries.sources.tables import path_exists


def clean_point(obs: DataFrame) -> DataFrame:
    """Trim trailing sentinels, fill the others by hour of day, drop what is left of them."""
    return drop_sentinel(fill_by_hour(obs, trim=True))


def ingest_point(payloads: DataFrame, tier: str = CURRENT, source: str = "nasapower") -> DataFrame:
    """`payloads` has (loc_id, payload), one JSON answer per location and year."""
    rows = parse_point_payload(payloads, "payload", ["loc_id"])
    rows = rows.withColumns({"source": F.lit(source), "tier": F.lit(tier)})
    named = conform_names(rows, variable_table(payloads.sparkSession))
    return clean_point(named.select(OBS_SCHEMA.names)).to(OBS_SCHEMA)


def point_rejects(payloads: DataFrame) -> DataFrame:
    """What `ingest_point` had to leave out: (loc_id, reason)."""
    return payload_rejects(payloads, "payload", ["loc_id"])


def _located(rows: DataFrame, catalogue: DataFrame, source: str, tier: str) -> DataFrame:
    """`grid_rows` named, converted and located."""
    tagged = rows.withColumns({"source": F.lit(source), "tier": F.lit(tier)})
    named = conform_names(tagged, variable_table(rows.sparkSession), convert=True)
    return locate_cells(named, catalogue).select(OBS_SCHEMA.names).to(OBS_SCHEMA)


def ingest_grid(grid_raw: DataFrame, catalogue: DataFrame, source: str, tier: str = CURRENT) -> DataFrame:
    """One flattened extract: masked cells dropped, named, converted, located."""
    return _located(grid_rows(grid_raw, source), catalogue, source, tier)


def ingest_grid_files(spark: SparkSession, manifest: DataFrame, folder: str, var: str | list[str], catalogue: DataFrame, source: str,
                      tier: str = CURRENT, fmt: str = "parquet", extensions: list[str] | None = None) -> DataFrame:
    """All landed files of one or several variables. `manifest` has (file_name) of what lies in the folder.

    A variable is named in its rows, so the plan has a branch for each layout of files, not for each variable. A
    manifest that also has `layout`, as `describe_files` gives it, spares looking into the files. File names go
    through the driver.
    """
    chosen = grid_files_of(manifest, var, extensions=extensions)
    known = "layout" in manifest.columns
    chosen = chosen.select("file_name", *["layout"] * known).distinct().orderBy("file_name").collect()
    paths = [f"{folder.rstrip('/')}/{r['file_name']}" for r in chosen]
    if not paths:
        return spark.createDataFrame([], OBS_SCHEMA)
    described = spark.createDataFrame([(p, r["layout"]) for p, r in zip(paths, chosen)], "path string, layout string") if known else None
    return _located(read_grid_raw(spark, paths, source, fmt, described), catalogue, source, tier)


def ingest_stations(raw: DataFrame, old_catalogue: DataFrame, tier: str = CURRENT,
                    source: str = "stations") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(observations, extended catalogue, rows of unknown variables).

    `raw` has (var, ref, latitude, longitude, time, value). Raises if the extended catalogue's
    ids are not dense.
    """
    known = F.col("var").isin(list(VARIABLES[source].values()))
    rejects = raw.filter(~F.coalesce(known, F.lit(False)))
    fixed = correct_coords(raw.filter(known), coordinate_fixes(raw.sparkSession))
    catalogue = extend_catalogue(old_catalogue, distinct_coordinates(fixed))
    if not check_dense_ids(catalogue).isEmpty():
        raise ValueError("location ids do not match their positions; check the old catalogue")
    rows = locate_stations(fixed, catalogue).withColumns({"source": F.lit(source), "tier": F.lit(tier)})
    return rows.select(OBS_SCHEMA.names).to(OBS_SCHEMA), catalogue, rejects


def rebuild_from_raw(spark: SparkSession, landing: str, manifest: DataFrame, catalogues: DataFrame, path: str, fmt: str = "parquet",
                     extensions: list[str] | None = None, variables: dict[str, list[str]] | None = None) -> None:
    """Rebuild history from the raw backup.

    `landing` holds a folder `nasapower` of payload tables and a folder of files for each grid source;
    `manifest` has (source, file_name) of the grid files. `variables` names those to rebuild of a source,
    else all of its dictionary.
    """
    parts = []
    if path_exists(spark, f"{landing}/nasapower"):
        parts.append(ingest_point(spark.read.format(fmt).load(f"{landing}/nasapower"), HISTORIC))
    for source in GRID_SOURCES:
        own = manifest.filter(F.col("source") == source)
        wanted = (variables or {}).get(source, sorted(set(VARIABLES[source].values())))
        parts.append(ingest_grid_files(spark, own, f"{landing}/{source}", wanted, catalogues, source, HISTORIC, fmt, extensions))
    rebuild(parts, path)


def rebuild(parts: list[DataFrame], path: str) -> None:
    """Write ingested parts as a whole new table, in one job."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    write_obs(whole, path)
