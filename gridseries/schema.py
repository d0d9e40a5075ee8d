"""Table schemas and the fixed dimensions of the data model."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

OBS_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("tier", T.StringType()),
    T.StructField("var", T.StringType()),
    T.StructField("loc_id", T.IntegerType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
])
CATALOGUE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("loc_id", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
VARIABLES_SCHEMA = "source string, raw_name string, request_name string, var string, kelvin boolean"
FIXES_SCHEMA = "var string, ref string, fix_lat double, fix_lon double"

SERIES = ["source", "var", "loc_id"]
OBS_KEY = ["source", "tier", "var", "loc_id", "time"]
HISTORIC, CURRENT = "historic", "current"

# ---- fixed values of the data products -------------------------------------------------
SENTINEL = -999.0
KELVIN_OFFSET = 273.15
NEIGHBOURS = 4
RADIUS_DEGREES = 1.0
DEFAULT_START = "2001-01-01"
# months of the current tier that stay provisional
KEEP_MONTHS = {"nasapower": 1, "era5": 5, "era5_land": 5}
# north, west, south, east of the area that grids are requested for
AREA = (-33.3, 164.64, -47.24, 179.53)

VARIABLES = {
    "nasapower": {
        "T2M": "temperature_2m",
        "RH2M": "relative_humidity_2m",
        "T2MDEW": "dewpoint_temperature_2m",
        "PRECTOTCORR": "precipitation",
        "PRECSNOLAND": "snowfall",
        "SNODP": "snow_depth",
        "PS": "surface_pressure",
        "CLOUD_AMT": "cloud_cover",
        "WS10M": "wind_speed_10m",
        "WD10M": "wind_direction_10m",
        "WS50M": "wind_speed_50m",
        "WD50M": "wind_direction_50m",
    },
    "era5": {
        "u10": "10m_u_component_of_wind",
        "v10": "10m_v_component_of_wind",
        "d2m": "dewpoint_temperature_2m",
        "t2m": "temperature_2m",
        "stl1": "soil_temperature_level_1",
        "stl2": "soil_temperature_level_2",
        "stl3": "soil_temperature_level_3",
        "ro": "runoff",
        "ssro": "sub_surface_runoff",
        "sro": "surface_runoff",
        "sp": "surface_pressure",
        "tp": "total_precipitation",
        "swvl1": "volumetric_soil_water_layer_1",
        "swvl2": "volumetric_soil_water_layer_2",
        "swvl3": "volumetric_soil_water_layer_3",
        "cbh": "cloud_base_height",
        "e": "evaporation",
        "hcc": "high_cloud_cover",
        "mcc": "medium_cloud_cover",
        "lcc": "low_cloud_cover",
        "pev": "potential_evaporation",
        "sd": "snow_depth",
        "sf": "snowfall",
        "slt": "soil_type",
        "tcc": "total_cloud_cover",
    },
    "era5_land": {
        "evabs": "evaporation_from_bare_soil",
        "evaow": "evaporation_from_open_water_surfaces_excluding_oceans",
        "evatc": "evaporation_from_the_top_of_canopy",
        "evavt": "evaporation_from_vegetation_transpiration",
        "pev": "potential_evaporation",
        "ro": "runoff",
        "stl1": "soil_temperature_level_1",
        "stl2": "soil_temperature_level_2",
        "stl3": "soil_temperature_level_3",
        "ssro": "sub_surface_runoff",
        "sro": "surface_runoff",
        "e": "total_evaporation",
        "swvl1": "volumetric_soil_water_layer_1",
        "swvl2": "volumetric_soil_water_layer_2",
        "swvl3": "volumetric_soil_water_layer_3",
        "u10": "10m_u_component_of_wind",
        "v10": "10m_v_component_of_wind",
        "d2m": "dewpoint_temperature_2m",
        "t2m": "temperature_2m",
        "sde": "snow_depth",
        "sf": "snowfall",
        "sp": "surface_pressure",
        "tp": "precipitation",
    },
    "stations": {
        "atmosphere_wind_direction": "wind_direction_2m",
        "atmosphere_temperature": "temperature_2m",
        "atmosphere_precipitation": "precipitation",
        "atmosphere_wind_speed": "wind_speed_2m",
        "atmosphere_relative_humidity": "relative_humidity_2m",
        "pedosphere_temperature": "soil_temperature_level_2",
        "pedosphere_volumetric_water_content": "volumetric_soil_water_layer_2",
    },
}
# sources a request may name; station series are ingested but not served
SERVED_SOURCES = ["nasapower", "era5", "era5_land"]
GRID_SOURCES = ["era5", "era5_land"]
# grid variables delivered in kelvin
KELVIN_VARIABLES = [
    "soil_temperature_level_1",
    "soil_temperature_level_2",
    "soil_temperature_level_3",
    "dewpoint_temperature_2m",
    "temperature_2m",
]
# names the grid provider uses where they differ from ours
REQUEST_NAMES = {
    "dewpoint_temperature_2m": "2m_dewpoint_temperature",
    "temperature_2m": "2m_temperature",
    "precipitation": "total_precipitation",
}
# variables fetched by default
COLLECTED = {
    "nasapower": ["T2M"],
    "era5": ["2m_temperature", "soil_temperature_level_1"],
    "era5_land": ["2m_temperature", "soil_temperature_level_1"],
}
# station files whose coordinates are known to be wrong
COORDINATE_FIXES = [
    ("relative_humidity_2m", "timaru_coastal_hv", -44.30493, 171.22158),
    ("wind_speed_2m", "timaru_coastal_hv", -44.30493, 171.22158),
    ("wind_direction_2m", "timaru_coastal_hv", -44.30493, 171.22158),
]
# ----------------------------------------------------------------------------------------


def served_variables(source: str) -> list[str]:
    return list(VARIABLES[source].values())


def variables(spark: SparkSession) -> DataFrame:
    """The variable dictionary as a dimension table."""
    rows = [
        (source, raw, REQUEST_NAMES.get(var, var), var,
         source in GRID_SOURCES and var in KELVIN_VARIABLES)
        for source, names in VARIABLES.items()
        for raw, var in names.items()
    ]
    return spark.createDataFrame(rows, VARIABLES_SCHEMA)


def coordinate_fixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COORDINATE_FIXES, FIXES_SCHEMA)
