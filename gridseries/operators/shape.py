"""Names, columns, wide and long form."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.functions import values
from gridseries.schema import VARIABLES

COORDINATES = ["longitude", "latitude", "time", "valid_time"]


def conform_columns(df: DataFrame, source: str) -> DataFrame:
    """Rename raw columns of a wide table; unknown names pass through."""
    return df.withColumnsRenamed(VARIABLES[source])


def conform_names(df: DataFrame, variables: DataFrame, convert: bool = False) -> DataFrame:
    """Long form: `raw_name` becomes `var`, kelvin values become Celsius when asked.

    The dictionary has 67 rows, so Spark broadcasts it by itself.
    """
    names = variables.select("source", "raw_name", "var", "kelvin")
    out = df.join(names, ["source", "raw_name"], "left")
    out = out.withColumn("var", F.coalesce("var", "raw_name"))
    if convert:
        kelvin = F.coalesce("kelvin", F.lit(False))
        out = out.withColumn("value", values.celsius(F.col("value"), kelvin))
    return out.drop("raw_name", "kelvin")


def name_value_column(df: DataFrame, var: str) -> DataFrame:
    return df.toDF(*df.columns[:-1], var)


def all_but(df: DataFrame, *names: str) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in df.columns if c not in names])


def value_column(df: DataFrame, source: str) -> str:
    """The one measured column of a grid extract; looks at the schema only."""
    found = [c for c in df.columns if c not in COORDINATES]
    if len(found) > 1:
        found = [c for c in found if c in VARIABLES[source]]
    if len(found) != 1:
        raise ValueError(f"cannot tell the value column of {df.columns}")
    return found[0]


def wide_to_long(df: DataFrame, ids: list[str], variables: list[str] | None = None) -> DataFrame:
    names = variables or [c for c in df.columns if c not in ids]
    doubles = [F.col(f"`{c}`").cast("double").alias(c) for c in names]
    return df.select(*ids, *doubles).unpivot(ids, [F.col(f"`{c}`") for c in names], "var", "value")


def series_to_wide(df: DataFrame, keys: list[str], variables: list[str], complete: bool = True) -> DataFrame:
    """One column per variable; with `complete`, only keys that have a row for every variable.

    A row with a null value counts as present.
    """
    picks = [F.max(F.when(F.col("var") == v, F.col("value"))).alias(v) for v in variables]
    flags = [F.max((F.col("var") == v).cast("int")) for v in variables]
    present = flags[0]
    for flag in flags[1:]:
        present = present + flag
    wide = (df.filter(F.col("var").isin(variables)).groupBy(*keys)
            .agg(*picks, present.alias("_present")))
    if complete:
        wide = wide.filter(F.col("_present") == len(variables))
    return wide.drop("_present")


def correct_coords(df: DataFrame, fixes: DataFrame) -> DataFrame:
    """Override coordinates by (var, ref); `fixes` has one row for each."""
    return (df.join(fixes, ["var", "ref"], "left")
            .withColumn("latitude", F.coalesce("fix_lat", "latitude"))
            .withColumn("longitude", F.coalesce("fix_lon", "longitude"))
            .drop("fix_lat", "fix_lon"))
